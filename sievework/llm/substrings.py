"""Substring dedup: words of passages that occur earlier in the corpus go, found by level-wise doubling of windows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.hashing import mixed, word_hashes
from sievework.llm.membership import filter_of, may_hold, rows_that_may_be_in
from sievework.llm.tables import scratch, stored
from sievework.llm.workers import bounds_of, in_groups, text_slices

_ROWS_AT_ONCE = 1 << 20  # windows a task compares before it sends what it can't decide
_RANGE = 1 << 20  # documents of one range of the order
_BITS = 24  # a place is a document's number times 2**24 plus a word's number; long documents take several numbers
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_ROW = "xxhash64(doc_id, digest1, digest2) as row"


@dataclass(frozen=True)
class Settings:
    """window: words of a repeated passage; first: words of the windows of the first level, doubled up to ``window``."""

    window: int = 20
    first: int = 5

    def lengths(self) -> list[int]:
        """Lengths of the levels before the last."""
        times = self.window // self.first
        if self.first < 1 or self.first * times != self.window or times & (times - 1):
            raise ValueError("window must be first times a power of two")
        return [self.first << k for k in range(times.bit_length() - 1)]


def _joined(left: np.ndarray, right: np.ndarray, factor: int) -> np.ndarray:
    return mixed(left * np.uint64(factor) + right)


def window_hashes(words: np.ndarray, lengths: list[int], factor: int = _FACTORS[0]) -> dict[int, np.ndarray]:
    """The hashes of all runs of each length, each length twice the one before; the first is built word by word."""
    out = words
    for k in range(1, lengths[0]):
        out = _joined(out[: len(out) - 1], words[k:], factor)
    found = {lengths[0]: out}
    for length in lengths[1:]:
        half = length // 2
        out = _joined(out[: max(0, len(out) - half)], out[half:], factor)
        found[length] = out
    return found


def sliding(best: np.ufunc, values: np.ndarray, n: int) -> np.ndarray:
    """The best (minimum or maximum) of each run of n values, by doubling."""
    done = 1
    while done < n:
        step = min(done, n - done)
        values = best(values[: len(values) - step], values[step:])
        done += step
    return values


def least_parts(hashes: np.ndarray, length: int, window: int) -> np.ndarray:
    """Per window the least hash of its parts of ``length`` words. Equal windows have equal least parts, so a window is
    repeated only if its least part is; and neighbouring windows mostly share theirs, so few parts need be counted."""
    return sliding(np.minimum, hashes, window - length + 1)


def _chosen(hashes: np.ndarray, least: np.ndarray, candidate: np.ndarray, length: int, window: int) -> np.ndarray:
    """Where the parts begin that are the least of a candidate window."""
    around = np.zeros(window - length, np.uint64)
    top = np.concatenate([around, np.where(candidate, least, np.uint64(0)), around])
    most = sliding(np.maximum, top, window - length + 1)
    return np.flatnonzero((most == hashes) & (most > 0))


def _held(parts: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _first_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by keys, the first the most important, and where new values of all but the last begin in it."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys[:-1]])
    return order, np.flatnonzero(new)


def _asks(part: np.ndarray, doc: np.ndarray, several: np.ndarray, hits: bool) -> Iterator[pa.RecordBatch]:
    """What a task knows of its parts: those it has seen twice itself (told, and with ``hits`` the documents that have
    them), and of the others the one document that asks. One row a part leaves the task, however often it occurs."""
    order, first = _first_of(part, doc)
    if not len(order):
        return
    part, doc, several = part[order], doc[order], several[order]
    sizes = np.diff(np.append(first, len(part)))
    told = (np.maximum.reduceat(doc, first) != np.minimum.reduceat(doc, first)) | np.logical_or.reduceat(several, first)
    yield from _ask_batch(part[first], doc[first], told, np.zeros(len(first), bool))
    if hits:
        of = np.repeat(told, sizes)
        fresh = np.append(True, (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])) & of
        yield from _ask_batch(part[fresh], doc[fresh], np.ones(fresh.sum(), bool), np.ones(fresh.sum(), bool))


def _ask_batch(part, doc, told, hit) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(part), 1 << 16):
        own = slice(low, low + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(part[own].view(np.int64)), pa.array(doc[own]), pa.array(told[own]), pa.array(hit[own])], ["part", "doc", "told", "hit"])


def _level(docs: DataFrame, s: Settings, k: int, known: list[np.ndarray], hits: bool) -> DataFrame:
    """The least parts of level k of all windows that earlier levels leave: part, doc, told, hit. known: a filter a level."""
    lengths = s.lengths()

    def asked(batches):
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        for batch in text_slices(batches):
            words, bounds = word_hashes(batch["text"], fold=False)
            if len(words) < s.window:
                continue
            own = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            hashes = window_hashes(words, lengths[: k + 1])
            candidate = own[: len(words) - s.window + 1] == own[s.window - 1 :]
            for length, bits in zip(lengths, known, strict=False):
                at = np.flatnonzero(candidate)
                candidate[at[~may_hold(bits, least_parts(hashes[length], length, s.window)[at].view(np.int64))]] = False
            at = _chosen(hashes[lengths[k]], least_parts(hashes[lengths[k]], lengths[k], s.window), candidate, lengths[k], s.window)
            part, of = hashes[lengths[k]][at], own[at]
            order, first = _first_of(of, part, at)
            several = np.repeat(np.diff(np.append(first, len(order))) > 1, np.diff(np.append(first, len(order))))
            held.append((part[order], batch["digest1"].to_numpy()[of[order]], several))
            waiting += len(at)
            if waiting > _ROWS_AT_ONCE:
                yield from _asks(*_held(held), hits)
                held, waiting = [], 0
        if held:
            yield from _asks(*_held(held), hits)

    return docs.select("digest1", "text").mapInArrow(asked, "part long, doc long, told boolean, hit boolean")


def _repeated_parts(asks: DataFrame) -> DataFrame:
    return asks.groupBy("part").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.max("told").alias("told")).filter("told or low < high").select("part")


def _answered(table: pa.Table) -> Iterator[pa.RecordBatch]:
    part, doc, told = (table[c].to_numpy() for c in ("part", "doc", "told"))
    first = bounds_of(table, ["part"])
    sizes, first = np.diff(first), first[:-1]
    known = np.logical_or.reduceat(told, first) | (np.maximum.reduceat(doc, first) != np.minimum.reduceat(doc, first))
    kept = np.repeat(known, sizes) & ~told
    yield pa.RecordBatch.from_arrays([pa.array(part[kept]), pa.array(doc[kept])], ["part", "doc"])


def repeated_parts_of_documents(docs: DataFrame, s: Settings) -> DataFrame:
    """doc (a digest of the text) and part: the parts of half a window's length that may belong to a repeated window.

    Each level looks only at windows whose part of the level before occurs twice, in two texts or in one. All levels but
    the last pass a filter of fixed size on; what it lets through by chance is told apart by the last level, exactly.
    """
    lengths = s.lengths()
    known: list[np.ndarray] = []
    for k in range(len(lengths) - 1):
        known.append(filter_of(_repeated_parts(stored(_level(docs, s, k, known, False), "parts"))))
    asks = stored(_level(docs, s, len(lengths) - 1, known, True), "parts")
    found = in_groups(asks.filter("not hit").select("part", "doc", "told"), ["part"], _answered, "part long, doc long")
    return found.unionByName(asks.filter("hit").select("part", "doc")).distinct()


def _numbered(texts: DataFrame) -> DataFrame:
    """Adds ``number`` to rows of doc_id, digest1, digest2 and span: rising with that order, ``span`` numbers apart.

    Ranges of the order are numbered within tasks; the sizes of ranges, one row a task, are added up here.
    """

    def numbered(batches):
        from pyspark import TaskContext

        total = 0
        for batch in batches:
            spans = batch["span"].to_numpy()
            within = total + np.cumsum(spans) - spans
            total += int(spans.sum())
            for name, values in (("range", np.full(len(spans), TaskContext.get().partitionId())), ("within", within)):
                batch = batch.append_column(name, pa.array(values.astype(np.int64)))
            yield batch

    ranges = max(1, -(-texts.count() // _RANGE))
    by = [F.col("doc_id").asc_nulls_last(), "digest1", "digest2"]
    schema = "doc_id long, digest1 long, digest2 long, span long, range long, within long"
    rows = texts.select("doc_id", "digest1", "digest2", "span").repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    rows = stored(rows.mapInArrow(numbered, schema), "numbered")
    sizes = sorted((r["range"], r["size"]) for r in rows.groupBy("range").agg(F.sum("span").alias("size")).collect())
    starts = np.cumsum([0] + [size for _, size in sizes]).tolist()
    starts = rows.sparkSession.createDataFrame([(at, start) for (at, _), start in zip(sizes, starts, strict=False)], "range long, start long")
    return rows.join(F.broadcast(starts), "range").select("doc_id", "digest1", "digest2", "span", (F.col("start") + F.col("within")).alias("number"))


def _same_text(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["digest1"] == b["digest1"]) & (a["digest2"] == b["digest2"])


def _marks(w1: np.ndarray, w2: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of the windows a task has seen: the earliest place of each, which asks, and all others, which are later ones."""
    order, first = _first_of(w1, w2, at)
    w1, w2, at = w1[order], w2[order], at[order]
    earliest = np.repeat(at[first], np.diff(np.append(first, len(at))))
    later = at != earliest
    asks = np.zeros(len(at), bool)
    asks[first] = True
    for rows, marked in ((np.flatnonzero(asks), False), (np.flatnonzero(later), True)):
        for low in range(0, len(rows), 1 << 16):
            own = rows[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(w1[own].view(np.int64)), pa.array(w2[own]), pa.array(at[own]), pa.array(np.full(len(own), marked))], ["w1", "w2", "at", "later"]
            )


def _later(table: pa.Table) -> Iterator[pa.RecordBatch]:
    at, bounds = table["at"].to_numpy(), bounds_of(table, ["w1", "w2"])
    earliest = np.repeat(np.minimum.reduceat(at, bounds[:-1]), np.diff(bounds))
    yield pa.RecordBatch.from_arrays([pa.array(at[at != earliest])], ["at"])


def _ranges(window: int) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
    """Starts of windows as the ranges of words that they cover."""

    def ranged(table: pa.Table):
        at = np.unique(table["at"].to_numpy())
        new = np.append(True, (at[1:] > at[:-1] + window) | (at[1:] >> _BITS != at[:-1] >> _BITS))
        low = at[new]
        high = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] + window
        base = low >> _BITS << _BITS
        yield pa.RecordBatch.from_arrays([pa.array(low >> _BITS), pa.array(low - base), pa.array(high - base)], ["number", "low", "high"])

    return ranged


def repeated_ranges(docs: DataFrame, s: Settings) -> DataFrame:
    """Per text that loses words: doc_id, digest1, digest2 and ranges, an array of (low, high) in words.

    ``docs`` has doc_id, text, digest1 and digest2. Equal texts are one, at their smallest doc_id.
    """
    texts = docs.groupBy("digest1", "digest2").agg(F.min("doc_id").alias("doc_id"), F.max("span").alias("span"))
    texts = stored(texts, "texts")
    parts = stored(repeated_parts_of_documents(docs, s), "repeated").groupBy("doc").agg(F.collect_list("part").alias("parts"))
    parts = stored(texts.join(parts, F.col("digest1") == F.col("doc")).drop("doc"), "parts-of-texts")
    places = stored(_numbered(parts), "places")
    wanted = parts.join(places.select("digest1", "digest2", "number"), ["digest1", "digest2"]).select("doc_id", "digest1", "digest2", "parts", "number")
    near = rows_that_may_be_in(docs.select("doc_id", "digest1", "digest2", "text"), "digest1", parts.select("digest1"))
    near = near.join(wanted.hint("merge"), _same_text(near, wanted)).select("text", "parts", "number")

    def marked(batches):
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        half = s.lengths()[-1]
        for batch in text_slices(batches):
            words, bounds = word_hashes(batch["text"], fold=False)
            if len(words) < s.window:
                continue
            both = [window_hashes(words, [*s.lengths(), s.window], factor) for factor in _FACTORS]
            least = least_parts(both[0][half], half, s.window)
            starts = []
            for low, high, known in zip(bounds[:-1].tolist(), bounds[1:].tolist(), batch["parts"], strict=True):
                if high - low >= s.window:
                    own = least[low : high - s.window + 1]
                    starts.append(low + np.flatnonzero(np.isin(own, known.values.to_numpy().view(np.uint64))))
            at = np.concatenate(starts) if starts else np.empty(0, np.int64)
            of = np.searchsorted(bounds, at, "right") - 1
            place = (batch["number"].to_numpy()[of] << _BITS) + at - bounds[of]
            held.append((both[0][s.window][at], (both[1][s.window][at] >> np.uint64(32)).astype(np.uint32).view(np.int32), place))
            waiting += len(at)
            if waiting > _ROWS_AT_ONCE:
                yield from _marks(*_held(held))
                held, waiting = [], 0
        if held:
            yield from _marks(*_held(held))

    marks = stored(near.mapInArrow(marked, "w1 long, w2 int, at long, later boolean"), "marks")
    later = in_groups(marks.filter("not later").select("w1", "w2", "at"), ["w1", "w2"], _later, "at long")
    later = later.unionByName(marks.filter("later").select("at")).withColumn("number", F.shiftright("at", _BITS))
    ranges = stored(in_groups(later, ["number"], _ranges(s.window), "number long, low long, high long"), "ranges")
    blocks = places.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("span") - 1)))
    blocks = blocks.select("doc_id", "digest1", "digest2", (F.col("number") + F.col("block")).alias("number"), F.shiftleft("block", _BITS).alias("base"))
    pair = F.struct((F.col("low") + F.col("base")).alias("low"), (F.col("high") + F.col("base")).alias("high"))
    found = ranges.join(blocks, "number").groupBy("doc_id", "digest1", "digest2").agg(F.collect_list(pair).alias("ranges"))
    copies = docs.select("doc_id", "digest1", "digest2").distinct().join(texts.withColumnRenamed("doc_id", "earliest"), ["digest1", "digest2"])
    copies = copies.filter(~F.col("doc_id").eqNullSafe(F.col("earliest")))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("low"), F.lit(1 << 62).alias("high")))
    return found.unionByName(copies.select("doc_id", "digest1", "digest2", whole.alias("ranges")))


def _kept(words: list[bytes], ranges: list[dict], window: int) -> list[bytes]:
    if not ranges or len(words) < window:
        return words
    kept, at = [], 0
    for low, high in sorted((r["low"], r["high"]) for r in ranges):
        kept += words[at:low] if low > at else []
        at = max(at, high)
    return kept + words[at:]


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), keep_text: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256 and kept (null without ``keep_text``).

    A word is a run of other bytes than space and 0x09 to 0x0D. Every word goes that is covered by a window of ``window``
    consecutive words whose sequence also starts earlier: in a document of smaller doc_id, or further left in the same.
    Windows are judged on the input. What is kept is joined by single spaces.

    Null, empty and wordless texts: zeros, and the empty text. Rows without doc_id come after all others; rows of one
    doc_id with different texts are ordered by a hash of the text; equal rows are one document and treated alike. Other
    columns are ignored; an empty table gives an empty result.

    Parts of windows are counted level by level: 5, 10, 20 words by default. Of each level only windows are extended to
    twice the length whose part occurs twice; the search ends with the window's own length, or when none is left. A part is
    hashed with 64 bits, a window with 96. Texts move when their repeated windows are looked for, and when words are
    removed from them; copies of whole texts move once. A task sends a window once, however often it has seen it.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(_without_repeats(docs, settings, keep_text), "kept")


def _without_repeats(docs: DataFrame, s: Settings, keep_text: bool) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    digests = [F.xxhash64(F.lit(k), F.col("text")).alias(f"digest{k}") for k in (1, 2)]
    span = (F.coalesce(F.octet_length("text"), F.lit(0)) / (2 << _BITS)).cast("long") + 1  # a word takes two bytes
    rows = rows.select("doc_id", "text", *digests, span.alias("span")).selectExpr("*", _ROW)
    worded = rows.filter(F.octet_length("text") >= 2 * s.window - 1)
    ranges = stored(repeated_ranges(worded, s), "repeats")
    losing = rows_that_may_be_in(rows, "row", ranges.selectExpr(_ROW))
    losing = losing.join(ranges.hint("merge"), _same_text(losing, ranges), "left").select(losing["doc_id"], "text", "ranges")
    bits = filter_of(ranges.selectExpr(_ROW))

    def told(batch: pa.RecordBatch, ranges: list) -> pa.RecordBatch:
        words = [(t or b"").split() for t in batch["text"].cast(pa.binary()).to_pylist()]  # bytes split at just these signs
        kept = [b" ".join(_kept(w, r, s.window)) for w, r in zip(words, ranges, strict=True)]
        left = [t.count(b" ") + 1 if t else 0 for t in kept]
        columns = [
            batch["doc_id"], pa.array([len(w) for w in words], pa.int64()), pa.array([len(w) - n for w, n in zip(words, left, strict=True)], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
            pa.array(kept if keep_text else [None] * len(kept), pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    def untouched(batches):
        for batch in text_slices(batches):
            own = batch.filter(pa.array(~may_hold(bits, batch["row"].to_numpy())))
            yield told(own, [None] * own.num_rows)

    def touched(batches):
        for batch in text_slices(batches):
            yield told(batch, batch["ranges"].to_pylist())

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    return rows.select("doc_id", "text", "row").mapInArrow(untouched, schema).unionByName(losing.mapInArrow(touched, schema))

