"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.hashing import mixed, random_values
from sievework.llm.tables import held_out
from sievework.llm.workers import per_worker, text_slices

DIMENSIONS = 1024
ORDER = 3
ROWS_PER_LANGUAGE = 4_000
LEAST = 0.12  # a filter rejects what is less like any language
SURE = 100  # and has so many different n-grams: fewer can miss every profile by chance
UNKNOWN = "und"
SEED = 7
_TEXTS_AT_ONCE = 128
_BYTES_AT_ONCE = 1 << 19
_GRAMS_AT_ONCE = 4096


def letter_vectors(letters: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """A random vector of +1 and -1 for each code point, the same wherever it is made."""
    words = random_values(dimensions // 64, seed)
    bits = mixed(mixed(letters.astype(np.uint64) + np.uint64(1))[:, None] ^ words[None, :])
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """Letters' vectors, permuted by their place from the end (rotated), and bound (multiplied). grams: code points, a row each."""
    letters, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    vectors = letter_vectors(letters, dimensions, seed)
    bound = None
    for k in range(grams.shape[1]):
        own = np.roll(vectors, grams.shape[1] - 1 - k, axis=1)[at[:, k]]
        bound = own if bound is None else bound * own
    return bound


def _folded() -> np.ndarray:
    """Per code point the letter it counts as: its lower case if that is one letter, a space if it is no letter; -1: not yet asked."""
    return np.full(0x110000, -1, np.int32)


def _letters(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    new = points[table[points] < 0]
    for p in np.unique(new).tolist():
        small = chr(p).lower()
        table[p] = ord(small) if len(small) == 1 and small.isalpha() else (p if chr(p).isalpha() else 0x20)
    return table[points]


def bundles(texts: list[str | None], order: int, dimensions: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the vectors of all letter n-grams of each text, and whether it has a letter.

    Texts are lower-cased; other signs than letters count as one space, and there is one at either end.
    """
    table = per_worker("folded", _folded)
    body = np.frombuffer("".join(f" {t or ''} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    own = np.repeat(np.arange(len(texts)), [len(t or "") + 2 for t in texts])
    body = _letters(body, table)
    keep = np.ones(len(body), bool)
    keep[1:] = (body[1:] != 0x20) | (body[:-1] != 0x20) | (own[1:] != own[:-1])
    body, own = body[keep], own[keep]
    has_letter = np.bincount(own[body != 0x20], minlength=len(texts)) > 0
    n = len(body) - order + 1
    out = np.zeros((len(texts), dimensions), np.float32)
    if n <= 0:
        return out, has_letter
    whole = own[:n] == own[order - 1 :]
    grams = np.stack([body[k : k + n] for k in range(order)], axis=1)[whole]
    of = own[:n][whole]
    letters, small = np.unique(grams, return_inverse=True)
    small = small.reshape(grams.shape)
    code = np.zeros(len(grams), np.int64)
    for k in range(order):
        code = code * len(letters) + small[:, k]
    kinds, at = np.unique(code, return_inverse=True)
    for low in range(0, len(kinds), _GRAMS_AT_ONCE):
        part = kinds[low : low + _GRAMS_AT_ONCE]
        digits = np.stack([part // len(letters) ** (order - 1 - k) % len(letters) for k in range(order)], axis=1)
        vectors = gram_vectors(letters[digits], dimensions, seed).astype(np.float32)
        mine = (at >= low) & (at < low + len(part))
        counts = np.bincount(of[mine] * len(part) + at[mine] - low, minlength=len(texts) * len(part))
        out += counts.reshape(len(texts), len(part)).astype(np.float32) @ vectors
    return out, has_letter


def learned(docs: DataFrame, order: int, dimensions: int, rows_per_language: int, seed: int) -> tuple[list[str], np.ndarray]:
    """One prototype per language: the bundle of the bundles of its texts, each of length 1.

    Learns from about ``rows_per_language`` documents of each language (all, if it has fewer) outside the held-out fold,
    drawn by a hash of the id: only those rows' sums leave the tasks, one vector per task and language.
    """
    rows = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["rows"] for r in rows.groupBy("lang").agg(F.count("*").alias("rows")).collect()}  # a row per language
    if not sizes:
        return [], np.empty((0, dimensions), np.float32)
    size = F.create_map(*[F.lit(x) for pair in sorted(sizes.items()) for x in pair])[F.col("lang")]
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    drawn = rows.filter(place * size < rows_per_language).select("lang", "text")

    def summed(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in text_slices(batches, "text", _TEXTS_AT_ONCE, _BYTES_AT_ONCE):
            found, known = bundles(batch["text"].to_pylist(), order, dimensions, seed)
            for vector, lang, ok in zip(found, batch["lang"].to_pylist(), known, strict=True):
                if ok:
                    sums[lang] = sums.get(lang, 0) + vector / np.linalg.norm(vector)
        names = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([[float(x) for x in sums[k]] for k in names], pa.list_(pa.float64()))], ["lang", "sums"]
        )

    parts = drawn.mapInArrow(summed, "lang string, sums array<double>")
    total = parts.select("lang", F.posexplode("sums")).groupBy("lang", "pos").agg(F.sum("col").alias("value"))
    vectors = total.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("values"))
    found = sorted(vectors.select("lang", "values.value").collect(), key=lambda r: r["lang"])
    if not found:
        return [], np.empty((0, dimensions), np.float32)
    prototypes = np.array([r["value"] for r in found])
    return [r["lang"] for r in found], (prototypes / np.linalg.norm(prototypes, axis=1, keepdims=True)).astype(np.float32)


def identify(
    docs: DataFrame,
    order: int = ORDER,
    dimensions: int = DIMENSIONS,
    rows_per_language: int = ROWS_PER_LANGUAGE,
    seed: int = SEED,
    train: DataFrame | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score.

    A text is the bundle (sum) of the vectors of its letter n-grams, a language that of its texts; the language of the
    greatest cosine is predicted and the cosine (0 at least) is the score. Ties go to the first name by code point.
    Prototypes are learned from ``train`` (default: ``docs``; doc_id, text, lang), never from the held-out fold. The number
    of languages is what must fit into memory: one vector each.

    Null text or text without letters is ``und`` with score 0, as is everything if no language could be learned. Other
    columns are ignored; repeated rows are predicted each; an empty table gives an empty result. Whole texts are read.
    """
    names, prototypes = learned(docs if train is None else train, order, dimensions, rows_per_language, seed)

    def predicted(batches):
        for batch in batches:
            langs, scores = _predicted(batch["text"], names, prototypes, order, dimensions, seed)
            columns = [batch["doc_id"], batch["held_out"], pa.array(langs, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(predicted, "doc_id long, held_out boolean, lang_pred string, score double")


def _predicted(texts: pa.Array, names: list[str], prototypes: np.ndarray, order: int, dimensions: int, seed: int) -> tuple[list[str], np.ndarray]:
    langs, scores = [], [np.empty(0)]
    for part in text_slices([pa.RecordBatch.from_arrays([texts], ["text"])], "text", _TEXTS_AT_ONCE, _BYTES_AT_ONCE):
        found, known = bundles(part["text"].to_pylist(), order, dimensions, seed)
        lengths = np.linalg.norm(found, axis=1)
        known &= (lengths > 0) & bool(names)
        best, score = np.zeros(len(found), int), np.zeros(len(found))
        if names:
            cosines = found @ prototypes.T / np.maximum(lengths, 1e-9)[:, None]
            best, score = cosines.argmax(1), np.clip(cosines.max(1).astype(float), 0, 1)
        langs += [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), known.tolist(), strict=True)]
        scores.append(np.where(known, score, 0.0))
    return langs, np.concatenate(scores)


def gram_kinds(text: str, order: int) -> int:
    """How many different letter n-grams a text has, by the folding of ``bundles``."""
    body = _letters(np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32), per_worker("folded", _folded))
    body = body[np.append(True, (body[1:] != 0x20) | (body[:-1] != 0x20))]
    return len(np.unique(np.lib.stride_tricks.sliding_window_view(body, order), axis=0)) if len(body) >= order else 0


def known_documents(
    docs: DataFrame,
    least: float = LEAST,
    order: int = ORDER,
    dimensions: int = DIMENSIONS,
    rows_per_language: int = ROWS_PER_LANGUAGE,
    seed: int = SEED,
    sure: int = SURE,
) -> DataFrame:
    """The rows of ``docs`` in a learned language, with all their columns: not ``und``, and with a score of ``least`` or more.

    A text of fewer than ``sure`` different n-grams stays whatever its score: a clean word may share no n-gram with what
    was learned, so its score says nothing against it.
    """
    names, prototypes = learned(docs, order, dimensions, rows_per_language, seed)

    def kept(batches):
        for batch in batches:
            langs, scores = _predicted(batch["text"], names, prototypes, order, dimensions, seed)
            stays = [k != UNKNOWN and x >= least for k, x in zip(langs, scores.tolist(), strict=True)]
            for i in np.flatnonzero((scores < least) & (np.array(langs) != UNKNOWN)).tolist():
                stays[i] = gram_kinds(batch["text"][i].as_py(), order) < sure
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
