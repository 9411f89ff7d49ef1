"""Quality classification: hashed word n-gram logistic regression, trained follow-the-regularised-leader."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.hashing import ngram_hashes, random_values, word_hashes
from sievework.llm.tables import held_out

KEEP_AT = 0.3
SEED = 3
_TEXTS_AT_ONCE = 256


@dataclass(frozen=True)
class Settings:
    """rows: about how many labelled documents are learned from. rate, smooth, l1, l2: the four constants of the updates."""

    bits: int = 18
    orders: tuple[int, ...] = (1, 2)
    rows: int = 8_000
    passes: int = 2
    rate: float = 2.0
    smooth: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    seed: int = SEED


def features(texts: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows as (bounds, places, values): a place per distinct hashed n-gram, 1 + log count as value, each row of length 1.

    A word repeated at once counts as one n-gram of its own kind, whatever the word, so that stuttering texts are alike.
    Place 0 is left for the constant.
    """
    words, bounds = word_hashes(texts)
    again = random_values(1, settings.seed)[0]
    of, grams = [], []
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    for n in settings.orders:
        runs = ngram_hashes(words, n) + np.uint64(n)
        if n > 1 and len(runs):
            same = words[: len(runs)] == words[1 : len(runs) + 1]
            runs = np.where(same, again, runs)
        inside = doc[: len(runs)] == doc[n - 1 :] if len(runs) else np.empty(0, bool)
        grams.append(runs[inside])
        of.append(doc[: len(runs)][inside])
    size = np.uint64((1 << settings.bits) - 1)
    keys = np.concatenate(of).astype(np.uint64) * np.uint64(1 << settings.bits) + np.concatenate(grams) % size + np.uint64(1)
    keys.sort()
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(first)
    counts = np.diff(np.append(starts, len(keys)))
    keys = keys[starts]
    rows = (keys >> np.uint64(settings.bits)).astype(np.int64)
    places = (keys & np.uint64((1 << settings.bits) - 1)).astype(np.int32)
    values = 1 + np.log(counts)
    lengths = np.sqrt(np.bincount(rows, values * values, minlength=len(texts)))
    values = (values / lengths[rows]).astype(np.float32)
    return np.searchsorted(rows, np.arange(len(texts) + 1)), places, values


def trained(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> np.ndarray:
    """Weights by place, from (places, values, label) rows taken one after the other.

    Each place has the sum z of its shifted gradients and the sum n of their squares; its weight is what minimises the
    regularised past loss, 0 while z stays within l1.
    """
    s = settings
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)

    def weights(at):
        zs = z[at]
        return np.where(np.abs(zs) <= s.l1, 0.0, (np.sign(zs) * s.l1 - zs) / ((s.smooth + np.sqrt(n[at])) / s.rate + s.l2))

    order = np.random.default_rng(s.seed)
    for _ in range(s.passes):
        for i in order.permutation(len(rows)):
            at, values, label = rows[i]
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30)))
            g = (p - label) * values
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.rate * w
            n[at] += g * g
    return weights(slice(None)).astype(np.float32)


def learned(docs: DataFrame, labels: DataFrame, settings: Settings) -> np.ndarray:
    """Weights learned from a sample of about ``settings.rows`` labelled documents, never of the held-out fold.

    Labels of one document are averaged, a half counts as 1; null labels say nothing. The sample is drawn by a hash of
    the id. Its texts become sparse rows where they are read; these, bounded by the sample, meet in one task.
    """
    known = labels.filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality_label"))
    rate = settings.rows / max(1, known.count())
    place = F.pmod(F.xxhash64(F.lit(settings.seed), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    known = known.filter(place < rate)
    drawn = docs.select("doc_id", "text").join(known, "doc_id")

    def sparse(batches):
        for batch in (whole.slice(low, _TEXTS_AT_ONCE) for whole in batches for low in range(0, whole.num_rows, _TEXTS_AT_ONCE)):
            bounds, places, values = features(batch["text"], settings)
            cut = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["quality_label"], pa.array([places[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([values[a:b].tobytes() for a, b in cut], pa.binary())],
                ["doc_id", "quality_label", "places", "values"],
            )

    def fit(batches):
        rows = []
        for batch in batches:
            for doc_id, label, places, values in zip(*[batch[c].to_pylist() for c in ("doc_id", "quality_label", "places", "values")], strict=True):
                at = np.append(np.frombuffer(places, np.int32), np.int32(0))
                rows.append((doc_id, at, np.append(np.frombuffer(values, np.float32), np.float32(1)), label))
        rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([trained([r[1:] for r in rows], settings).tobytes()], pa.binary())], ["weights"])

    rows = drawn.select("doc_id", "quality_label", F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(sparse, "doc_id long, quality_label int, places binary, values binary")
    found = rows.repartition(1).mapInArrow(fit, "weights binary").collect()
    return np.frombuffer(found[0]["weights"], np.float32) if found else np.zeros(1 << settings.bits, np.float32)


def score_quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), keep_at: float = KEEP_AT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score (0 to 1, higher is better) and predicted (1 from ``keep_at`` on).

    The score is the logistic function of the sparse dot product of the whole text's features with the weights learned
    from ``labels`` (doc_id, quality). Null and empty texts have the constant feature only, as has everything at first;
    without labels every score is a half. Rows are scored one by one, repeated or not; other columns are ignored; an
    empty table gives an empty result.
    """
    weights = learned(docs, labels, settings)

    def scored(batches):
        for batch in batches:
            p = probabilities(batch["text"], weights, settings)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(p), pa.array((p >= keep_at).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def probabilities(texts: pa.Array, weights: np.ndarray, settings: Settings) -> np.ndarray:
    """Of a text being good: the logistic function of the dot product of its features and the weights."""
    out = np.empty(len(texts))
    for low in range(0, len(texts), _TEXTS_AT_ONCE):
        bounds, places, values = features(texts.slice(low, _TEXTS_AT_ONCE), settings)
        sums = np.append(0.0, np.cumsum(weights[places].astype(float) * values))
        out[low : low + _TEXTS_AT_ONCE] = 1 / (1 + np.exp(-(weights[0] + sums[bounds[1:]] - sums[bounds[:-1]])))
    return out


def good_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that ``score_quality`` predicts as 1, with all their columns; nothing is shuffled for it."""
    weights = learned(docs, labels, settings)

    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array(probabilities(batch["text"], weights, settings) >= keep_at))

    return docs.mapInArrow(kept, docs.schema)
