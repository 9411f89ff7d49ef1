"""Language-model scoring by masked pseudo-likelihood: a small window network predicts each word from both sides."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.hashing import mixed, word_hashes
from sievework.llm.tables import scratch, stored
from sievework.llm.workers import in_groups, text_slices

_POSITIONS_AT_ONCE = 1 << 14
_COUNTED_AT_ONCE = 1 << 21
_BLOCK = 1 << 14  # weights travel in blocks of so many
_MERGED_AT_ONCE = 64
_COLUMNS = 1 << 10  # positions whose values stay in a core's own cache
_SAFE = 80.0  # logits nearer to 0 can be exponentiated and summed in single precision as they are
_PREFIX = np.uint64(48)  # shifts a hash to its first 16 bits
_UNITS = float(1 << 32)  # joined logarithms are summed as whole parts, so that sums don't depend on the order


@dataclass(frozen=True)
class Settings:
    """words: frequent words with outputs of their own; buckets: outputs shared by all others, by hash.

    A word of a bucket has the bucket's probability times its share of the bucket's occurrences. held: the counts of words
    that make up more than 1 / held of all are held by every task (fewer than so many words), the others are joined.

    side: words seen on either side. width, hidden: sizes of the network. group: outputs per class of the two-step softmax.
    masked: share of the positions of all documents that are learned from, each in one of the ``rounds``; 1 is every one.
    batch: positions per update. rate: step of the updates.
    """

    words: int = 3072
    buckets: int = 1024
    held: int = 1 << 20
    side: int = 2
    width: int = 16
    hidden: int = 32
    group: int = 64
    rounds: int = 2
    masked: float = 1.0
    batch: int = 8192
    rate: float = 0.2
    seed: int = 1

    @property
    def outputs(self) -> int:
        return self.words + self.buckets


class Network:
    """Neighbours' vectors, joined, through one hidden layer to a class and a word within the class."""

    def __init__(self, s: Settings, flat: np.ndarray | None = None):
        self.s = s
        shapes = [(s.outputs + 1, s.width), (2 * s.side * s.width, s.hidden), (s.hidden,), (s.hidden, s.outputs // s.group), (s.outputs // s.group,)]
        shapes += [(s.outputs, s.hidden), (s.outputs,)]
        sizes = [int(np.prod(x)) for x in shapes]
        if flat is None:
            random = np.random.default_rng(s.seed)
            flat = np.concatenate([(random.standard_normal(n) * (0.3 if k < 2 else 0.0)) for k, n in enumerate(sizes)])
        self.flat = np.array(flat, np.float32)
        self.gradient: Network | None = None
        self.spaces: dict[str, np.ndarray] = {}
        cuts = np.cumsum([0, *sizes])
        views = [self.flat[a:b].reshape(x) for a, b, x in zip(cuts[:-1], cuts[1:], shapes, strict=True)]
        self.embed, self.inner, self.inner_bias, self.klass, self.klass_bias, self.word, self.word_bias = views

    def _space(self, name: str, *shape: int) -> np.ndarray:
        """Room for a batch's values, kept from batch to batch: new pages for each take longer than the arithmetic."""
        size = int(np.prod(shape))
        if name not in self.spaces or self.spaces[name].size < size:
            self.spaces[name] = np.empty(size, np.float32)
        return self.spaces[name][:size].reshape(shape)

    def _stacked(self) -> np.ndarray:
        """For each class a matrix: the weights and, as the last column, the bias of every class, below them those of its own words."""
        s, n = self.s, len(self.klass_bias)
        out = self._space("stacked", n, n + s.group, s.hidden + 1)
        out[:, :n, :-1], out[:, :n, -1] = self.klass.T, self.klass_bias
        out[:, n:, :-1], out[:, n:, -1] = self.word.reshape(n, s.group, -1), self.word_bias.reshape(n, -1)
        return out

    def _near(self) -> bool:
        """Whether no logit can leave the bounds of _SAFE: the hidden layer's values are at most 1."""
        ones = np.ones(self.s.hidden, np.float32)
        most = (ones @ np.abs(self.klass) + np.abs(self.klass_bias)).max(), (np.abs(self.word) @ ones + np.abs(self.word_bias)).max()
        return max(most) < _SAFE

    def _forward(self, context: np.ndarray, classes: list[tuple[int, int, int]], stacked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The neighbours' joined vectors (a row for each position), the hidden layer with a one below it, the logits of all
        classes with those of the words of the target's class below them (a column for each position)."""
        joined = self._space("joined", *context.shape, self.s.width)
        self.embed.take(context, axis=0, out=joined, mode="clip")  # other modes fill a copy first
        joined = joined.reshape(len(context), -1)
        hidden = self._space("hidden", self.s.hidden + 1, len(context))
        hidden[-1] = 1  # times the biases
        own = np.matmul(self.inner.T, joined.T, out=hidden[:-1])
        own += self.inner_bias[:, None]
        np.tanh(own, out=own)
        logits = self._space("logits", stacked.shape[1], len(context))
        for c, low, high in classes:
            np.matmul(stacked[c], hidden[:, low:high], out=logits[:, low:high])
        return joined, hidden, logits

    def log_probability(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target given its neighbours (a row of 2 * side ids each); single precision, so the last digit follows the batch."""
        order, classes = _by_class(target // self.s.group)
        target, places, n = target[order], np.arange(len(target)), len(self.klass_bias)
        _, _, logits = self._forward(context[order], classes, self._stacked())
        found = logits[target // self.s.group, places] + logits[n + target % self.s.group, places]
        for some in (logits[:n], logits[n:]):
            found -= _log_sum(some, self._near())
        out = np.empty_like(found)
        out[order] = found
        return out

    def learn(self, context: np.ndarray, target: np.ndarray, squares: np.ndarray) -> None:
        """One step on the mean loss of a batch; each weight's step falls with the squares of its past gradients."""
        s, n = self.s, len(self.klass_bias)
        if self.gradient is None:
            self.gradient = Network(s, np.zeros_like(self.flat))  # in the same layout, filled anew by each step
        own = self.gradient
        order, classes = _by_class(target // s.group)
        context, target, stacked = context[order], target[order], self._stacked()
        joined, hidden, wrong = self._forward(context, classes, stacked)
        _softmax_error(wrong[:n], target // s.group, self._near())
        _softmax_error(wrong[n:], target % s.group, self._near())
        sums = self._space("sums", *stacked.shape)
        sums[:] = 0
        back = self._space("back", s.hidden, len(target))
        for c, low, high in classes:
            some = wrong[:, low:high]
            np.matmul(some, hidden[:, low:high].T, out=sums[c])
            np.matmul(stacked[c, :, :-1].T, some, out=back[:, low:high])
        of_classes = sums[:, :n].sum(0)
        own.klass[:], own.klass_bias[:] = of_classes[:, :-1].T, of_classes[:, -1]
        own.word[:], own.word_bias[:] = sums[:, n:, :-1].reshape(own.word.shape), sums[:, n:, -1].ravel()
        hidden *= hidden
        back *= np.subtract(1, hidden[:-1], out=hidden[:-1])
        np.matmul(joined.T, back.T, out=own.inner)
        back.sum(1, out=own.inner_bias)
        rows = np.matmul(self.inner, back, out=joined.reshape(-1, len(target))).reshape(-1, s.width, len(target))
        words = context.T.ravel()  # a word may be several positions' neighbour
        for k in range(s.width):
            own.embed[:, k] = np.bincount(words, rows[:, k].ravel(), minlength=len(own.embed))
        own.flat /= len(target)
        step = np.multiply(own.flat, own.flat, out=self._space("step", len(own.flat)))
        squares += step
        np.sqrt(np.add(squares, 1e-8, out=step), out=step)
        np.divide(own.flat, step, out=step)
        step *= s.rate
        self.flat -= step


def _log_sum(logits: np.ndarray, near: bool = False) -> np.ndarray:
    """The logarithm of the sum of exponentials of each column; the logits are lost. near: all are within _SAFE."""
    out = np.empty(logits.shape[1], logits.dtype)
    for low in range(0, len(out), _COLUMNS):
        some = logits[:, low : low + _COLUMNS]
        most = 0.0 if near else some.max(0)
        if not near:
            some -= most
        out[low : low + _COLUMNS] = np.log(np.exp(some, out=some).sum(0)) + most
    return out


def _softmax_error(logits: np.ndarray, target: np.ndarray, near: bool) -> None:
    """Of each column its softmax, less one at its target; in place. near: all logits are within _SAFE."""
    for low in range(0, len(target), _COLUMNS):
        some = logits[:, low : low + _COLUMNS]
        if not near:
            some -= some.max(0)
        np.exp(some, out=some)
        some /= some.sum(0)
    logits.reshape(-1)[target * len(target) + np.arange(len(target))] -= 1


def _by_class(klass: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by class, and each class met with its bounds in that order."""
    order = np.argsort(klass.astype(np.uint16) if klass.max(initial=0) < 1 << 16 else klass, kind="stable")
    counts = np.bincount(klass)
    ends = np.cumsum(counts)
    return order, [(int(c), int(ends[c] - counts[c]), int(ends[c])) for c in np.flatnonzero(counts)]


def word_counts(docs: DataFrame) -> DataFrame:
    """word (its hash) and times of every word of all documents; counts are merged in tasks, then by word."""

    def counted(batches):
        known, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

        def flushed():
            return pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(counts)], ["word", "times"])

        for texts in text_slices(batches, rows=1024):
            new, times = np.unique(word_hashes(texts["text"])[0], return_counts=True)
            joined = np.concatenate([known, new])
            known, at = np.unique(joined, return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, times]), minlength=len(known)).astype(np.int64)
            if len(known) > _COUNTED_AT_ONCE:
                yield flushed()
                known, counts = known[:0], counts[:0]
        yield flushed()

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(counted, "word long, times long")
    return parts.groupBy("word").agg(F.sum("times").alias("times"))


def frequent_words(counts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the most frequent words, ties by hash, and how often they occur."""
    top = counts.orderBy(F.desc("times"), "word").limit(words).collect()
    return np.array([r["word"] for r in top], np.int64).view(np.uint64), np.array([r["times"] for r in top], np.float64)


def bucketed_words(counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """word, times and bucket of all words without an output of their own."""

    def bucketed(batches):
        for batch in batches:
            ids = vocabulary.ids(batch["word"].to_numpy().view(np.uint64))
            others = pa.array(ids >= vocabulary.s.words)
            yield pa.RecordBatch.from_arrays([batch["word"].filter(others), batch["times"].filter(others), pa.array(ids).filter(others)], ["word", "times", "bucket"])

    return stored(counts.mapInArrow(bucketed, "word long, times long, bucket long"), "buckets")


def bucket_shares(words: DataFrame, totals: np.ndarray) -> DataFrame:
    """word, times and share (the logarithm of its share of its bucket's occurrences) of words in buckets."""

    def shared(batches):
        for batch in batches:
            share = np.log(batch["times"].to_numpy() / totals[batch["bucket"].to_numpy()])
            yield pa.RecordBatch.from_arrays([batch["word"], batch["times"], pa.array(share)], ["word", "times", "share"])

    return stored(words.mapInArrow(shared, "word long, times long, share double"), "shares")


class Vocabulary:
    """Ids of words: the frequent ones and buckets of all others."""

    def __init__(self, frequent: np.ndarray, s: Settings):
        self.s, self.order = s, np.argsort(frequent)
        self.sorted = frequent[self.order]
        self.places = np.searchsorted(self.sorted >> _PREFIX, np.arange((1 << 16) + 1, dtype=np.uint64)).astype(np.int32)
        self.deepest = int(np.diff(self.places).max())

    def ids(self, words: np.ndarray) -> np.ndarray:
        """A frequent word's rank, or the bucket of any other; frequent words are found by their first 16 bits, few have the same."""
        out = self.s.words + (words % np.uint64(self.s.buckets)).astype(np.int64)
        at = self.places[words >> _PREFIX]
        for _ in range(self.deepest):
            same = np.flatnonzero(self.sorted.take(at, mode="clip") == words)
            out[same] = self.order.take(at[same], mode="clip")
            at += 1
        return out


def neighbours(ids: np.ndarray, of: np.ndarray, s: Settings, at: np.ndarray) -> np.ndarray:
    """The ids on both sides of the positions ``at``; beyond a text's ends the id after the last."""
    places = np.arange(len(ids)) + s.side * (of + 1)  # with so many strange ids before, between and after the texts
    spaced = np.full((places[-1] + 1 if len(ids) else 0) + s.side, s.outputs, np.int64)
    spaced[places] = ids
    there, out = places[at], np.empty((len(at), 2 * s.side), np.int64)
    for k, step in enumerate([d for d in range(-s.side, s.side + 1) if d]):
        out[:, k] = spaced[there + step]
    return out


def folds(words: np.ndarray, bounds: np.ndarray, of: np.ndarray, s: Settings) -> np.ndarray:
    """The round in which each position is masked, ``rounds`` if in none; drawn by the text's words and the place in it."""
    sums = np.append(np.uint64(0), np.cumsum(words, dtype=np.uint64))
    own = sums[bounds[1:]] - sums[bounds[:-1]]
    drawn = mixed(own[of] + np.arange(len(words), dtype=np.uint64) - bounds[:-1].astype(np.uint64)[of] + np.uint64(s.seed))
    return np.minimum((mixed(drawn) >> np.uint64(11)) * (2.0**-53 * s.rounds / s.masked), s.rounds).astype(np.int64)


def starting_weights(s: Settings, totals: np.ndarray) -> np.ndarray:
    """Random vectors, and biases that give every output its frequency."""
    network, logs = Network(s), np.log(totals + 1)
    network.word_bias[:] = logs - logs.max()
    classes = _log_sum(logs.reshape(-1, s.group).T)
    network.klass_bias[:] = classes - classes.max()
    return network.flat


def one_round(docs: DataFrame, vocabulary: Vocabulary, flat: np.ndarray, s: Settings, number: int) -> np.ndarray:
    """Each task learns from this round's positions of all its documents, starting at ``flat``; the mean by positions is returned.

    Tasks write their weights as blocks; blocks are averaged some tasks at a time until one is left.
    """

    def learned(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        network, squares, seen = Network(s, flat), np.zeros(len(flat), np.float32), 0
        context, target = np.empty((0, 2 * s.side), np.int64), np.empty(0, np.int64)
        for texts in text_slices(batches):
            words, bounds = word_hashes(texts["text"])
            ids, of = vocabulary.ids(words), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            at = np.flatnonzero(folds(words, bounds, of, s) == number)
            np.random.default_rng([s.seed, number, int(words.sum(dtype=np.uint64))]).shuffle(at)
            context, target = np.concatenate([context, neighbours(ids, of, s, at)]), np.concatenate([target, ids[at]])
            full = len(target) - len(target) % s.batch
            for a in range(0, full, s.batch):
                network.learn(context[a : a + s.batch], target[a : a + s.batch], squares)
            context, target, seen = context[full:], target[full:], seen + full
        if len(target):
            network.learn(context, target, squares)
            seen += len(target)
        if seen:
            blocks = range(0, len(flat), _BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a // _BLOCK for a in blocks], pa.int64()),
                    pa.array([task] * len(blocks), pa.int64()),
                    pa.array([float(seen)] * len(blocks)),
                    pa.array([(network.flat[a : a + _BLOCK] * np.float64(seen)).tobytes() for a in blocks], pa.binary()),
                ],
                ["block", "part", "seen", "sums"],
            )

    schema = "block long, part long, seen double, sums binary"
    parts = stored(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(learned, schema), "weights")

    def merged(table: pa.Table):
        keys = np.stack([table[k].to_numpy() for k in ("block", "part")], axis=1)
        seen, sums = table["seen"].to_numpy(), table["sums"].to_pylist()
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
        for low, high in zip(starts, np.append(starts[1:], len(keys)), strict=True):
            total = sum(np.frombuffer(x, np.float64) for x in sums[low:high])
            columns = [[int(keys[low, 0])], [int(keys[low, 1])], [float(seen[low:high].sum())], [total.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.binary()), strict=True)], ["block", "part", "seen", "sums"])

    while (last := parts.agg(F.max("part")).first()[0]) is not None and last > 0:
        fewer = parts.withColumn("part", F.floor(F.col("part") / _MERGED_AT_ONCE))
        parts = stored(in_groups(fewer, ["block", "part"], merged, schema), "weights")
    rows = sorted(parts.collect(), key=lambda r: r["block"])
    if not rows:
        return flat
    return np.concatenate([np.frombuffer(r["sums"], np.float64) / r["seen"] for r in rows]).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """What is learned: ``counts`` of all words, ``words`` in buckets, occurrences per output and the network's weights."""

    s: Settings
    vocabulary: Vocabulary
    counts: DataFrame
    words: DataFrame
    totals: np.ndarray
    flat: np.ndarray


def learned_model(docs: DataFrame, s: Settings) -> Model:
    """Counts the words of all documents, then learns in rounds; every position is masked in one of them."""
    counts = stored(word_counts(docs), "counts")
    frequent, times = frequent_words(counts, s.words)
    vocabulary = Vocabulary(frequent, s)
    words = bucketed_words(counts, vocabulary)
    totals = np.zeros(s.outputs)
    totals[: len(times)] = times
    for row in words.groupBy("bucket").agg(F.sum("times").alias("times")).collect():  # a row per bucket
        totals[row["bucket"]] = row["times"]
    flat = starting_weights(s, totals)
    for number in range(s.rounds):
        with scratch(docs.sparkSession):
            flat = one_round(docs, vocabulary, flat, s, number)
    return Model(s, vocabulary, counts, words, totals, flat)


def score_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, score, log_probability, n_tokens.

    Every word of the whole text is predicted from the words on both sides of it, as if it alone were masked; the
    logarithms of these probabilities are summed, ``score`` is their mean. The vocabulary counts all documents, and every
    position of all documents is learned from once, in one of the ``rounds`` (fewer with a smaller ``masked``). Which one, and the
    order within some texts, follow from the texts; the mean of weights is over tasks, so scores change a little with the
    split of the files, and equal texts that are read apart may differ in the seventh digit. The network knows frequent words and buckets of all others, and starts at their frequencies; within
    its bucket a word's probability is its share of the bucket's occurrences in all documents, so the probabilities of all
    words sum to 1. These counts are a table that grows with the vocabulary and is joined to the words
    that need it. Nothing but the frequent words, the counts of at most ``held`` words, a sum per bucket and the averaged
    weights, all of bounded size, comes to the driver.

    Null, empty and wordless texts: 0 tokens, log_probability 0, score null. Rows are scored one by one, repeated or not;
    other columns are ignored; an empty table gives an empty result. The result is stored in the shared folder.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(_score_documents(docs, settings), "scores")


def _score_documents(docs: DataFrame, s: Settings) -> DataFrame:
    model = learned_model(docs, s)
    counts, vocabulary, flat = model.counts, model.vocabulary, model.flat
    shares = bucket_shares(model.words, model.totals)
    least = (counts.agg(F.sum("times")).first()[0] or 0) / s.held
    held = shares.filter(F.col("times") > least).select("word", "share").toArrow()
    known = held["word"].to_numpy().view(np.uint64)
    order = np.argsort(known)
    known, known_shares = known[order], held["share"].to_numpy()[order]

    def scored(batches):
        from pyspark import TaskContext

        network, row = Network(s, flat), TaskContext.get().partitionId() << 40
        for batch in text_slices(batches):
            texts = batch["text"].fill_null("").dictionary_encode()  # equal texts of a slice are worked on once
            words, bounds = word_hashes(texts.dictionary)
            ids, of = vocabulary.ids(words), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            found = np.zeros(len(ids))
            context = neighbours(ids, of, s, np.arange(len(ids)))
            for a in range(0, len(ids), _POSITIONS_AT_ONCE):
                at = slice(a, a + _POSITIONS_AT_ONCE)
                found[at] = network.log_probability(context[at], ids[at])
            others = np.flatnonzero(ids >= s.words)
            if len(known):
                place = np.minimum(np.searchsorted(known, words[others]), len(known) - 1)
                same = known[place] == words[others]
                found[others[same]] += known_shares[place[same]]
                others = others[~same]
            counts = np.diff(bounds)
            sums = np.bincount(of, found, minlength=len(counts))
            others = others[np.lexsort((words[others], of[others]))]
            first = np.ones(len(others), bool)
            first[1:] = (words[others][1:] != words[others][:-1]) | (of[others][1:] != of[others][:-1])
            first = np.flatnonzero(first)
            times = np.diff(np.append(first, len(others)))
            cuts = pa.array(np.append(0, np.cumsum(np.bincount(of[others[first]], minlength=len(counts)))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (words[others[first]].view(np.int64), times.astype(np.int64))]
            found_of_text = pa.RecordBatch.from_arrays([pa.array(counts, pa.int64()), pa.array(sums), *lists], ["n_tokens", "log_probability", "words", "times"])
            of_rows = found_of_text.take(texts.indices)
            rows = pa.array(np.arange(row, row + batch.num_rows, dtype=np.int64))
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [rows, batch["doc_id"], *of_rows.columns],
                ["row", "doc_id", "n_tokens", "log_probability", "words", "times"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "row long, doc_id long, n_tokens long, log_probability double, words array<long>, times array<long>"
    rows = stored(rows.mapInArrow(scored, schema), "scored")
    pairs = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("own")).select("row", F.col("own.words").alias("word"), F.col("own.times").alias("n"))
    share = F.round(F.col("share") * _UNITS).cast("long")
    more = pairs.join(shares.select("word", share.alias("share")), "word").groupBy("row").agg((F.sum(F.col("n") * F.col("share")) / _UNITS).alias("more"))
    total = F.col("log_probability") + F.coalesce("more", F.lit(0.0))
    rows = rows.select("row", "doc_id", "n_tokens", "log_probability").join(more, "row", "left").withColumn("log_probability", total)
    score = F.when(F.col("n_tokens") > 0, F.col("log_probability") / F.col("n_tokens"))
    return rows.select("doc_id", score.alias("score"), "log_probability", "n_tokens")
