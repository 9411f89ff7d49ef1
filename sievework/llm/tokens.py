"""Token counts by byte-pair merging, and token ids, for tokenizers of the word-end kind."""

from __future__ import annotations

import heapq
import json
import re
from array import array

import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sievework.llm.workers import per_worker

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
REMEMBERED = 400_000  # texts between spaces whose counts a worker keeps
_LONGEST = 64  # longer ones are not kept
_ENTRY = 190  # bytes of an entry besides its text and value


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def merges_of(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges byte-pair encoding makes: the adjacent pair of lowest rank first, the leftmost of equals.

    Symbols are a linked list by position. A heap holds the ranks of adjacent pairs; entries whose pair has changed
    meanwhile are skipped. Each symbol enters a bounded number of entries, so n symbols take n log n steps.
    """
    n = len(symbols)
    if n < 2:
        return 0
    symbols = list(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(rank, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    merged = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        symbols[i], symbols[j] = left + right, ""
        merged += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (rank := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
        h = before[i]
        if h >= 0 and (rank := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
    return merged


class Remembered(dict):
    """Values of texts between spaces, made when first asked for."""

    def __init__(self, make, most: int = REMEMBERED):
        self.make, self.most = make, most

    def __missing__(self, text: str):
        value = self.make(text)
        if len(text) <= _LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[text] = value
        return value


class Counter:
    """Counts the tokens of texts between spaces for one vocabulary file, without identifiers.

    Takes files with a byte alphabet, a word-end suffix, added tokens that are looked for in the text as it stands, and
    white space that is dropped; others are refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, splits = told["model"], told["pre_tokenizer"]["pretokenizers"]
        end = model.get("end_of_word_suffix")
        plain = not (model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("continuing_subword_prefix"))
        kinds = [s["type"] for s in splits]
        if not end or not plain or kinds != ["Split", "ByteLevel"] or any(t["normalized"] for t in told["added_tokens"]):
            raise ValueError(f"{path} is not of the word-end kind")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.end = end
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.normalise = Tokenizer.from_file(path).normalizer.normalize_str
        self.pieces = regex.compile(splits[0]["pattern"]["Regex"])
        self.added = regex.compile("|".join(regex.escape(t["content"]) for t in told["added_tokens"]) or r"(?!)")
        self.byte = byte_letters()
        self.of_piece = Remembered(self._count_piece)
        self.of_text = Remembered(self._count_text)

    def _count_piece(self, piece: str) -> int:
        symbols = [self.byte[b] for b in piece.encode("utf-8")]
        symbols[-1] += self.end
        return len(symbols) - merges_of(symbols, self.ranks)

    def _count_text(self, text: str) -> int:
        total = 0
        parts = [text]
        if "<" in text or not self.added.pattern.isascii():
            total += len(self.added.findall(text))
            parts = self.added.split(text)
        for part in parts:
            small = part.lower() if part.isascii() else self.normalise(part)
            total += sum(map(self.of_piece.__getitem__, self.pieces.findall(small)))
        return total


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is printable Latin-1, else the next letter from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in shown)
    letters = {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


_SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space for str.split, but not for tokenizers


def between_spaces(text: str) -> list[str]:
    return regex.split(r"\s+", text.strip(" \t\n\r\f\v")) if any(c in text for c in _SEPARATORS) else text.split()


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    Counts equal those of the tokenizers library for the whole text, without tokens at its ends: normalised, added
    tokens found inside it, words merged by rank. A count is the number of a word's bytes less the merges made. Tokens
    never span white space, so counts of texts between spaces are remembered by each worker, up to a bound.

    Null text is empty; empty text has no tokens. Rows are counted one by one, repeated or not; other columns are
    ignored; an empty table gives an empty result. One pass, no shuffle.
    """
    path = path or vocabulary_path()

    def counted(batches):
        of_text = per_worker(("counter", path), lambda: Counter(path)).of_text
        for batch in batches:
            texts = batch["text"].fill_null("") if batch["text"].null_count else batch["text"]
            counts = [sum(map(of_text.__getitem__, between_spaces(t))) for t in texts.to_pylist()]
            n_bytes = pa.compute.binary_length(texts).cast(pa.int64())
            over = pa.array([c > limit for c in counts], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], n_bytes, pa.array(counts, pa.int64()), over], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


class Identifiers:
    """Token ids of whole texts, as bytes of 32-bit numbers; the library encodes each text between spaces once.

    Since the vocabulary knows lower case only, Latin texts are lower-cased first, and since letters and the signs after
    them are never one token, they are encoded apart: both make what is new rarer. What is remembered takes about
    ``most`` bytes at most, half of it since the last half was full: what has not been used since then is forgotten.
    """

    def __init__(self, path: str, most: int = 256 << 20):
        self.tokenizer = Tokenizer.from_file(path)
        self.most, self.size = most, 0
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def of(self, texts: list[str]) -> list[bytes]:
        split = [between_spaces(_folded(t)) for t in texts]
        if self.size > self.most // 2:
            self.before, self.known, self.size = self.known, {}, 0
        made = self._encoded(set().union(*split).difference(self.known))
        return [self._joined(words, made) for words in split]

    def _joined(self, words: list[str], made: dict[str, bytes]) -> bytes:
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:  # a word too long to be remembered
            return b"".join([made[w] if (ids := self.known.get(w)) is None else ids for w in words])

    def _encoded(self, texts: set[str]) -> dict[str, bytes]:
        again = {w: ids for w in texts if (ids := self.before.get(w)) is not None}
        self._remember(again)
        cut = {w: (m[1], m[2]) if (m := _WORD_AND_SIGNS.fullmatch(w)) and m[1].isalpha() else (w,) for w in texts if w not in again}
        self._remember({p: ids for ps in cut.values() for p in ps if (ids := self.before.get(p)) is not None})
        parts = [p for p in {p for ps in cut.values() for p in ps} if p not in self.known]
        ids = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        made = {p: array("I", e.ids).tobytes() for p, e in zip(parts, ids, strict=True)}
        self._remember(made)
        out = {w: b"".join([made[p] if p in made else self.known[p] for p in ps]) for w, ps in cut.items()}
        self._remember(out)
        return out | again

    def _remember(self, made: dict[str, bytes]) -> None:
        new = {p: x for p, x in made.items() if len(p) <= _LONGEST and p not in self.known}
        self.known.update(new)
        self.size += sum(_ENTRY + 2 * len(p) + len(x) for p, x in new.items())


_WORD_AND_SIGNS = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)")


def _folded(text: str) -> str:
    """Lower case, where that is letter by letter and leaves no sign that an added token would be found in."""
    if "<|" in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()
