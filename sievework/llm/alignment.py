"""Cross-tokenizer alignment: which tokens of two tokenizers share bytes of a text, and how often each pair does."""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sievework.llm.tables import scratch, stored
from sievework.llm.tokens import byte_letters
from sievework.llm.workers import per_worker, text_slices

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
HELD = 1 << 19  # pairs whose counts travel with the tasks; the counts of others are joined
_BYTES = 128 << 20  # of remembered units a worker keeps, about
_UNIT = 300  # bytes of an entry, besides its strings and links
_TEXT_BYTES = 1 << 20  # of texts worked on at once
_SPACE = "▁"  # how pieces spell a space

_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGNS = r"!-/:-@\[-`{-~"
# Cuts a text at places that no token of either kind spans: before a space or line break between other signs, and
# between a Latin letter and an ASCII sign.
UNITS = re.compile(
    rf"[ \n]?[{_LETTERS}]+(?=[{_SIGNS}]|[ \n]\S|\Z)|[{_SIGNS}]+(?=[ \n]\S|\Z)|(?s:.+?)(?:(?<=\S)(?=[ \n]\S)|\Z)"
)
_LETTER_THEN_SIGN = re.compile(rf"[{_LETTERS}][{_SIGNS}]")


def successors(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Per token (A's, then B's) the A token that its group ends with. Both sequences cover the same bytes.

    Every token points to its farthest-right overlapping token: an A token to the B token that holds its last byte, if
    that goes further, else to itself; a B token to the A token that holds its last byte. Pointers are doubled, all at
    once, until none moves: each then shows its component's last token, after about log2(longest group) rounds.
    """
    n = len(a_ends)
    holds = np.searchsorted(b_ends, a_ends, "left")
    pointer = np.concatenate([np.where(b_ends[holds] > a_ends, n + holds, np.arange(n)), np.searchsorted(a_ends, b_ends, "left")])
    while True:
        further = pointer[pointer]
        if (further == pointer).all():
            return pointer
        pointer = further


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token that share a byte, by A's place."""
    first = np.searchsorted(b_ends, np.append(0, a_ends[:-1]), "right")
    counts = np.searchsorted(b_ends, a_ends, "left") - first + 1
    a = np.repeat(np.arange(len(a_ends)), counts)
    return a, first[a] + np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.values, self.n = np.zeros(1024, kind), 0

    def add(self, new) -> None:
        if self.n + len(new) > len(self.values):
            self.values = np.concatenate([self.values[: self.n], np.zeros(self.n + 2 * len(new), self.values.dtype)])
        self.values[self.n : self.n + len(new)] = new
        self.n += len(new)

    def now(self) -> np.ndarray:
        return self.values[: self.n]


class Aligner:
    """Aligned tokens of a space and each text, with what was aligned before remembered unit by unit.

    Takes a byte-level file of the tokenizers library without normaliser and prefix space, and a sentencepiece model
    with byte fallback whose pieces neither hold a space after another sign nor join a Latin letter to an ASCII sign;
    others are refused, since units could not be encoded apart.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(a_path, encoding="utf-8") as file:
            told = json.load(file)
        split = told["pre_tokenizer"] or {}
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        named = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        plain = [p for i, (p, byte) in enumerate(named) if not (byte or self.b.is_control(i) or self.b.is_unknown(i))]
        if told["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError(f"{a_path} is not of the byte-level kind")
        if any(_SPACE in p.lstrip(_SPACE) or "\n" in p or _LETTER_THEN_SIGN.search(p) for p in plain):
            raise ValueError(f"{b_path} has pieces that span words")
        byte_of = {letter: i for i, letter in enumerate(byte_letters())}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in told["model"]["vocab"].items():
            self.a_bytes[i] = bytes(byte_of[letter] for letter in token) if all(x in byte_of for x in token) else b""
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace(_SPACE, " ").encode() for p, byte in named]
        self.a_lengths = np.array([len(x) for x in self.a_bytes])
        self.b_lengths = np.array([len(x) for x in self.b_bytes])
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.spelled: list[str] = []
        self.bad: set[int] = set()
        self.size = 0
        # Per unit: A tokens, B tokens, groups, links; all units' links one after the other, as a << 32 | b.
        self.counts = [_Grown(np.int64) for _ in range(4)]
        self.links = _Grown(np.int64)
        self.uses = _Grown(np.int64)

    def shrink(self) -> None:
        """Forgets all units but the most used, half of what may be kept; all get new numbers."""
        names, spelled, uses = list(self.known), self.spelled, self.uses.now()
        sizes = np.array([_UNIT + len(u) + len(s) for u, s in zip(names, spelled, strict=True)]) + 8 * self.counts[3].now()
        sizes[list(self.bad)] = _BYTES
        order = np.argsort(-uses, kind="stable")
        keep = np.sort(order[np.cumsum(sizes[order]) <= _BYTES // 2])
        counts, links = [column.now()[keep] for column in self.counts], self.links.now()
        links = links[np.isin(np.repeat(np.arange(len(names)), self.counts[3].now()), keep)]
        uses = uses[keep] // 2
        self.clear()
        at = keep.tolist()
        self.known = {names[i]: k for k, i in enumerate(at)}
        self.spelled = [spelled[i] for i in at]
        self.size = int(sizes[keep].sum())
        for column, values in zip((*self.counts, self.links, self.uses), (*counts, links, uses), strict=True):
            column.add(values)

    def units(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The units of all texts, as numbers, and each text's bounds in them; a text that has no tokens has none."""
        cut = [UNITS.findall(" " + t) if t else [] for t in texts]
        found = [list(map(self.known.get, own)) for own in cut]
        new = {u for own, ids in zip(cut, found, strict=True) if None in ids for u, i in zip(own, ids, strict=True) if i is None}
        if new:
            self._learn(list(new))
            found = [list(map(self.known.__getitem__, own)) if None in ids else ids for own, ids in zip(cut, found, strict=True)]
        if self.bad:
            found = [[] if not self.bad.isdisjoint(ids) else ids for ids in found]
        lengths = [len(ids) for ids in found]
        flat = np.fromiter((i for ids in found for i in ids), np.int64, sum(lengths))
        np.add.at(self.uses.now(), flat, 1)
        return flat, np.append(0, np.cumsum(lengths)).astype(np.int64)

    def _learn(self, units: list[str]) -> None:
        apart = [u for u in units if _SPACE in u or u[-1].isspace() or u[:2].isspace()]
        together = sorted(set(units).difference(apart))
        # A unit that does not start with a space follows a space and an "a", one token of either kind that is cut off.
        shown = [u if u[0] == " " else " a" + u for u in together]
        whole = "".join(shown)
        done = self._add(together, shown, *self._encoded(whole), whole.encode()) if together else True
        for u in apart if done else units:
            text = u if u[0] == " " else " a" + u
            if not self._add([u], [text], *self._encoded(text), text.encode()):
                self.known[u] = len(self.spelled)
                self.bad.add(len(self.spelled))
                self.spelled.append("")
                for column in (*self.counts, self.uses):
                    column.add([0])

    def _encoded(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(a, np.int64), np.array(self.b.encode(text[1:], num_threads=1), np.int64)

    def _add(self, units: list[str], shown: list[str], a: np.ndarray, b: np.ndarray, data: bytes) -> bool:
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != data or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != data:
            return False
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        ends = np.cumsum([len(s.encode()) for s in shown])
        starts = np.append(0, ends[:-1]) + np.array([0 if len(u) == len(s) else 2 for u, s in zip(units, shown, strict=True)])
        last = successors(a_ends, b_ends)
        closing = np.flatnonzero(last[: len(a)] == np.arange(len(a)))  # the A token that closes each group
        a_cuts = np.append(0, closing + 1).tolist()
        b_cuts = np.append(0, np.searchsorted(b_ends, a_ends[closing], "left") + 1).tolist()
        a_names, b_names = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups = [
            f"{','.join(a_names[a0:a1])}|{','.join(b_names[b0:b1])}"
            for a0, a1, b0, b1 in zip(a_cuts[:-1], a_cuts[1:], b_cuts[:-1], b_cuts[1:], strict=True)
        ]
        at, other = overlaps(a_ends, b_ends)
        link_ends = a_ends[at]
        bounds = [[np.searchsorted(x, edge, "right") for edge in (starts, ends)] for x in (a_ends, b_ends, a_ends[closing], link_ends)]
        pairs = a[at] << 32 | b[other]
        inside = np.zeros(len(pairs) + 1, np.int64)
        np.add.at(inside, bounds[3][0], 1)
        np.add.at(inside, bounds[3][1], -1)
        self.links.add(pairs[np.cumsum(inside)[:-1] > 0])
        for column, (low, high) in zip(self.counts, bounds, strict=True):
            column.add(high - low)
        for u, low, high in zip(units, bounds[2][0].tolist(), bounds[2][1].tolist(), strict=True):
            self.known[u] = len(self.spelled)
            self.spelled.append(";".join(groups[low:high]))
        self.uses.add(np.zeros(len(units), np.int64))
        self.size += len(data) + sum(map(len, self.spelled[-len(units) :])) + 8 * len(pairs) + _UNIT * len(units)
        return True


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, at = np.unique(keys, return_inverse=True)
    return known, np.bincount(at, values, len(known)).astype(np.int64)


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """How many links in all texts hold each pair of ids: pair (a << 32 | b), n. Added up by unit within a task first."""

    def counted(batches):
        aligner, times = per_worker(("aligner", a_path, b_path), lambda: Aligner(a_path, b_path)), np.zeros(0, np.int64)

        def told():
            used = np.flatnonzero(times)
            links = aligner.counts[3].now()
            at = np.repeat(np.arange(len(links)), links)
            inside = times[at] > 0 if len(used) else np.zeros(0, bool)
            pairs, sums = _summed(aligner.links.now()[inside], times[at[inside]]) if len(used) else (np.empty(0, np.int64), np.empty(0, np.int64))
            for low in range(0, len(pairs), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[low : low + (1 << 16)]), pa.array(sums[low : low + (1 << 16)])], ["pair", "n"])

        for batch in text_slices(batches, most_bytes=_TEXT_BYTES):
            if aligner.size > _BYTES:
                yield from told()
                aligner.shrink()
                times = np.zeros(0, np.int64)
            ids, _ = aligner.units(batch["text"].to_pylist())
            if len(aligner.spelled) > len(times):
                times = np.append(times, np.zeros(len(aligner.spelled) + 50_000 - len(times), np.int64))
            np.add.at(times, ids, 1)
        times = np.append(times, np.zeros(max(0, len(aligner.spelled) - len(times)), np.int64))[: len(aligner.spelled)]
        yield from told()

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(counted, "pair long, n long")
    return rows.groupBy("pair").agg(F.sum("n").alias("n"))


def frequent(pairs: DataFrame, most: int) -> DataFrame:
    """The pairs from some count on: as many as are no more than ``most``, by counts' powers of two in eighths."""
    step = F.floor(F.log2("n") * 8)
    steps = sorted(((r["step"], r["pairs"]) for r in pairs.groupBy(step.alias("step")).agg(F.count("*").alias("pairs")).collect()), reverse=True)
    least, held = None, 0
    for at, some in steps:  # a row for each eighth of a power of two, some 500 at most
        held += some
        if held > most:
            break
        least = at
    return pairs.filter(F.lit(False)) if least is None else pairs.filter(step >= least)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, held: int = HELD, keep_groups: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups.

    A space and the text are encoded by A (a byte-level file), the text by B (a sentencepiece model, which adds the
    space); special tokens' strings are plain text. Where an A and a B token end at one byte a group ends; ``groups``
    spells them as ``a1,a2|b1;a3|b2,b3`` (null without ``keep_groups``; its SHA-256 is always there). A link is a pair of an A
    and a B token that share bytes; count_sum adds up how often each link's pair of ids is linked in all texts, n_best
    counts the links whose pair is the most frequent of its B id.

    Null and empty texts, and texts that B does not spell byte by byte, have no tokens: zeros and an empty string; they
    count nowhere. Rows are aligned one by one, repeated or not, and each counts; other columns are ignored; an empty
    table gives an empty result. Whole texts are read twice: to count pairs, then to look them up. The counts of at most
    ``held`` frequent pairs travel with the tasks, those of all others are joined to the rows that need them.
    """
    a_path, b_path = a_path or public_tokenizers.path(BYTE_VOCABULARY), b_path or public_tokenizers.path(PIECE_VOCABULARY)
    with scratch(docs.sparkSession) as keep:
        return keep(_aligned(docs, a_path, b_path, held, keep_groups), "aligned")


def _aligned(docs: DataFrame, a_path: str, b_path: str, held: int, keep_groups: bool) -> DataFrame:
    counts = stored(pair_counts(docs, a_path, b_path), "counts")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    counts = counts.withColumn("b", b_id).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    counts = stored(counts, "pairs")
    some = frequent(counts, held).toArrow()
    order = np.argsort(some["pair"].to_numpy())
    pairs, times, best = (some[c].to_numpy()[order] for c in ("pair", "n", "best"))

    def aligned(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        aligner = per_worker(("aligner", a_path, b_path), lambda: Aligner(a_path, b_path))
        sums, done = None, 0
        for batch in text_slices(batches, most_bytes=_TEXT_BYTES):
            if aligner.size > _BYTES:
                aligner.shrink()
                sums = None
            texts = batch["text"].to_pylist()
            ids, bounds = aligner.units(texts)
            if sums is None:  # per unit: links of the best pair, counts, links whose pair isn't held; and those links
                sums, done = [_Grown(np.int64) for _ in range(3)] + [_Grown(np.int64)], [0, 0]
            new_units = aligner.counts[3].now()[done[0] :]
            if len(new_units):
                links = aligner.links.now()[done[1] :]
                of = np.repeat(np.arange(len(new_units)), new_units)
                place = np.minimum(np.searchsorted(pairs, links), max(0, len(pairs) - 1))
                hit = pairs[place] == links if len(pairs) else np.zeros(len(links), bool)
                for column, weights in zip(sums, (best, times), strict=False):
                    column.add(np.bincount(of[hit], weights[place[hit]] if len(pairs) else None, len(new_units)).astype(np.int64))
                sums[2].add(np.bincount(of[~hit], minlength=len(new_units)))
                sums[3].add(links[~hit])
                done = [done[0] + len(new_units), done[1] + len(links)]
            n = len(texts)
            of = np.repeat(np.arange(n), np.diff(bounds))
            total = [np.append(0, np.cumsum(column.now()[ids]))[bounds] for column in (*aligner.counts, *sums[:2])]
            total = [np.diff(x) for x in total]
            # Links whose counts are joined later: each text's pairs and how often it has them.
            rest = sums[2].now()[ids]
            unit_at = np.flatnonzero(rest)
            first = (np.cumsum(sums[2].now()) - sums[2].now())[ids[unit_at]]
            spread = np.repeat(first - (np.cumsum(rest[unit_at]) - rest[unit_at]), rest[unit_at]) + np.arange(rest.sum())
            open_pairs, open_of = sums[3].now()[spread], np.repeat(of[unit_at], rest[unit_at])
            by = np.lexsort((open_pairs, open_of))
            open_pairs, open_of = open_pairs[by], open_of[by]
            fresh = np.flatnonzero(np.append(True, (open_pairs[1:] != open_pairs[:-1]) | (open_of[1:] != open_of[:-1]))) if len(by) else by
            cuts = pa.array(np.append(0, np.cumsum(np.bincount(open_of[fresh], minlength=n))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (open_pairs[fresh], np.diff(np.append(fresh, len(by))))]
            told = ids.tolist()
            spelled = [";".join([aligner.spelled[i] for i in told[a:b]]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelled]
            rows = pa.array(np.arange(row, row + n, dtype=np.int64))
            row += n
            kept = pa.array(spelled, pa.string()) if keep_groups else pa.nulls(n, pa.string())
            yield pa.RecordBatch.from_arrays(
                [rows, batch["doc_id"], *[pa.array(x) for x in total], pa.array(digests, pa.string()), kept, *lists],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups", "pairs", "times"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    numbers = [f"{c} long" for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    rows = stored(rows.mapInArrow(aligned, ", ".join(numbers) + ", groups_sha256 string, groups string, pairs array<long>, times array<long>"), "rows")
    open_ = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("own")).select("row", F.col("own.pairs").alias("pair"), F.col("own.times").alias("times"))
    more = open_.join(counts, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_count"))
    rows = rows.drop("pairs", "times").join(more, "row", "left")
    for column, added in (("n_best", "more_best"), ("count_sum", "more_count")):
        rows = rows.withColumn(column, F.col(column) + F.coalesce(added, F.lit(0)))
    return rows.drop("row", "more_best", "more_count")
