"""Near-duplicate documents: a chosen-path similarity join over sets of word shingles."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.components import components
from sievework.llm.hashing import mixed, random_values, shingle_sets, word_hashes
from sievework.llm.membership import rows_that_may_be_in
from sievework.llm.tables import scratch, stored
from sievework.llm.workers import bounds_of, in_groups, matrix_of, text_slices

_TEXTS_AT_ONCE = 256
_SHINGLES_AT_ONCE = 4096
_PIVOTS = 4


@dataclass(frozen=True)
class Settings:
    """words: words per shingle. percent: least similarity (intersection over union) of linked sets, in hundredths.

    tokens: minwise tokens per document. trees: independent trees. leaf: documents in a node that are compared at once;
    block: documents compared at once when links are confirmed. Neither bounds what is compared, only how it is split.
    """

    words: int = 5
    percent: int = 80
    tokens: int = 96
    trees: int = 8
    leaf: int = 2048
    block: int = 256
    seed: int = 8

    def __post_init__(self):
        # What shares less than 0.4 with a pivot can't be linked with what is nearly equal to the pivot, see
        # candidate_edges; that takes links of at least (1 + 0.4) / 2 and some room for the estimate's spread.
        if self.percent < 75:
            raise ValueError("percent must be at least 75")

    def matches(self, similarity: float) -> int:
        """Tokens that two sets of this similarity share at least, but for five standard deviations."""
        spread = math.sqrt(similarity * (1 - similarity) / self.tokens)
        return max(1, math.floor(self.tokens * (similarity - 5 * spread)))


def sketches(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, digest1 and digest2 (of the text), n (distinct shingles), h1 and h2 (which tell different sets apart) and the
    minwise tokens of each row."""
    factors = (random_values(s.tokens, s.seed) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shifts = (random_values(s.tokens, s.seed + 1) >> np.uint64(32)).astype(np.uint32)

    def sketched(batches):
        for batch in text_slices(batches, "text", _TEXTS_AT_ONCE):
            sets = shingle_sets(*word_hashes(batch["text"]), s.words)
            tokens = []
            for own in sets:
                if not len(own):
                    tokens.append(b"")
                    continue
                short = (own >> np.uint64(32)).astype(np.uint32)
                least = [(short[a : a + _SHINGLES_AT_ONCE, None] * factors + shifts).min(0) for a in range(0, len(own), _SHINGLES_AT_ONCE)]
                tokens.append(np.minimum.reduce(least).astype("<u4").tobytes())
            hashes = set_hashes(sets, s)
            columns = [batch["doc_id"], batch["digest1"], batch["digest2"], pa.array([len(x) for x in sets], pa.int64()), *hashes, pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest1", "digest2", "n", "h1", "h2", "tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("*", *_digests()).mapInArrow(sketched, "doc_id long, digest1 long, digest2 long, n long, h1 long, h2 long, tokens binary")


def _digests() -> list[Column]:
    return [F.xxhash64(F.lit(k), F.col("text").cast("string")).alias(f"digest{k}") for k in (1, 2)]


def set_hashes(sets: list[np.ndarray], s: Settings) -> list[pa.Array]:
    """Two hashes of each set, the same in whatever order it is added up."""
    hashes = [[mixed(own ^ salt).sum(dtype=np.uint64) for own in sets] for salt in random_values(2, s.seed + 2)]
    return [pa.array(mixed(np.array(x, np.uint64)).view(np.int64)) for x in hashes]


def _children(paths: np.ndarray, tokens: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The nodes below: a node selects one token place, now and then two (1 / similarity on average); rows go by its value."""
    state = mixed(paths ^ np.uint64(s.seed))
    rows = np.arange(len(paths))
    chosen = [(rows, (state % np.uint64(s.tokens)).astype(np.int64))]
    state = mixed(state)
    second = rows[(state >> np.uint64(11)).astype(np.float64) / float(1 << 53) < 100 / s.percent - 1]
    chosen.append((second, (state[second] % np.uint64(s.tokens)).astype(np.int64)))
    out = [mixed(mixed(paths[at] + np.uint64(1)) ^ (place.astype(np.uint64) << np.uint64(32) | tokens[at, place].astype(np.uint64))) for at, place in chosen]
    return np.concatenate(out), np.concatenate([at for at, _ in chosen])


def _branched(rows: DataFrame, s: Settings, roots: bool) -> DataFrame:
    """(path, rep) one level down, from (rep, tokens) at the roots of all trees or from (path, rep, tokens)."""
    starts = random_values(s.trees, s.seed + 3)

    def branched(batches):
        for batch in batches:
            tokens, rep = matrix_of(batch["tokens"], s.tokens, "<u4"), batch["rep"].to_numpy()
            origins = [np.full(len(rep), x, np.uint64) for x in starts] if roots else [batch["path"].to_numpy().view(np.uint64)]
            for origin in origins:
                paths, at = _children(origin, tokens, s)
                yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), pa.array(rep[at])], ["path", "rep"])

    return rows.mapInArrow(branched, "path long, rep long")


def _short(column: pa.ChunkedArray | pa.Array, s: Settings) -> np.ndarray:
    """One byte of each token: enough to tell how many are equal."""
    return np.ascontiguousarray(matrix_of(column, s.tokens, "<u4").astype(np.uint8))


def _star_edges(reps: np.ndarray, alike) -> list[tuple[int, int]]:
    """Edges that connect what is connected, as stars. alike(i, others): which of the rows ``others`` are linked with row i.

    A row reached once is compared only with those not yet reached, so a group that is alike takes few comparisons.
    """
    edges, left = [], np.arange(len(reps))
    while len(left):
        root, left, open_ = left[0], left[1:], [left[0]]
        while open_ and len(left):
            hit = alike(open_.pop(), left)
            edges += [(reps[root], r) for r in reps[left[hit]].tolist()]
            open_ += left[hit].tolist()
            left = left[~hit]
    return edges


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(edges, np.int64).reshape(-1, 2)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def candidate_edges(reps: DataFrame, s: Settings) -> DataFrame:
    """Edges (a, b) among ``reps`` (rep, tokens) that connect all pairs which may be linked.

    Nodes of the trees are (path, rep) rows. A node of one row is dropped; one of up to ``leaf`` rows is compared
    exhaustively, token by token; a larger one is branched again. Before that its rows are compared with a few pivots:
    what shares four tenths of the tokens with a pivot is connected with it, and what shares eight tenths leaves the
    node, since by the triangle inequality all it can be linked with is connected with that pivot too. So groups of near
    copies of any size shrink, and others split. No node is cut off: levels follow until no node is large.
    """
    linked = s.matches(s.percent / 100)
    near, same = math.ceil(0.4 * s.tokens), math.ceil(min(0.95, s.percent / 100) * s.tokens)

    def compared(table: pa.Table):
        reps_, tokens = table["rep"].to_numpy(), _short(table["tokens"], s)
        bounds = bounds_of(table, ["path"])
        sizes = np.diff(bounds)
        twos = bounds[:-1][sizes == 2]
        twos = twos[(tokens[twos] == tokens[twos + 1]).sum(1) >= linked]
        edges = list(zip(reps_[twos].tolist(), reps_[twos + 1].tolist(), strict=True))
        for low, high in zip(bounds[:-1][sizes > 2].tolist(), bounds[1:][sizes > 2].tolist(), strict=True):
            own = tokens[low:high]
            edges += _star_edges(reps_[low:high], lambda i, others, own=own: (own[others] == own[i]).sum(1) >= linked)
        yield _edge_batch(edges)

    def against_pivots(batches):
        for batch in batches:
            own = _short(batch["tokens"], s)
            shared = [(own == _short(batch[f"pivot_tokens{k}"], s)).sum(1) for k in range(_PIVOTS)]
            stays = np.max(shared, axis=0) < same
            edges = [batch["rep"].filter(pa.array(stays)), batch["path"].filter(pa.array(stays))]
            none = pa.nulls(len(edges[0]), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, edges[1], edges[0], batch["tokens"].filter(pa.array(stays))], ["a", "b", "path", "rep", "tokens"])
            for k in range(_PIVOTS):
                hit = pa.array(shared[k] >= near)
                pairs = [batch[f"pivot{k}"].filter(hit), batch["rep"].filter(hit)]
                none = pa.nulls(len(pairs[0]), pa.int64())
                yield pa.RecordBatch.from_arrays([*pairs, none, none, pa.nulls(len(none), pa.binary())], ["a", "b", "path", "rep", "tokens"])

    found: list[DataFrame] = []
    rows, roots = reps, True
    while True:
        nodes = _branched(rows, s, roots)
        sizes = nodes.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
        members = stored(nodes.join(sizes, "path").join(reps, "rep"), "members")
        small = members.filter(F.col("size") <= s.leaf)
        found.append(stored(in_groups(small.select("path", "rep", "tokens"), ["path"], compared, "a long, b long").distinct(), "candidates"))
        large = members.filter(F.col("size") > s.leaf)
        if large.isEmpty():
            break
        picks = [F.min(F.struct(F.xxhash64(F.lit(k), "rep").alias("h"), "rep"))["rep"].alias(f"pivot{k}") for k in range(_PIVOTS)]
        pivots = large.groupBy("path").agg(*picks)
        for k in range(_PIVOTS):
            pivots = pivots.join(reps.select(F.col("rep").alias(f"pivot{k}"), F.col("tokens").alias(f"pivot_tokens{k}")), f"pivot{k}")
        schema = "a long, b long, path long, rep long, tokens binary"
        thinned = large.select("path", "rep", "tokens").join(stored(pivots, "pivots"), "path").mapInArrow(against_pivots, schema)
        thinned = stored(thinned, "thinned")
        found.append(thinned.filter("a is not null").select("a", "b").distinct())
        rows, roots = thinned.filter("rep is not null").select("path", "rep", "tokens"), False
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges.filter("a <> b").distinct()


def _set_edges(table: pa.Table, keys: list[str], percent: int) -> pa.RecordBatch:
    """Edges of links confirmed on whole sets, within each group."""
    reps = table["rep"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
    edges = []
    bounds = bounds_of(table, keys)
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = sets[low:high]
        sizes = np.array([len(x) for x in own])
        owner = np.repeat(np.arange(len(own)), sizes)
        known, at = np.unique(np.concatenate(own), return_inverse=True)
        order = np.argsort(at, kind="stable")
        lists = np.searchsorted(at[order], np.arange(len(known) + 1))
        posted, starts = owner[order], np.append(0, np.cumsum(sizes))

        def alike(i, others, at=at, lists=lists, posted=posted, starts=starts, sizes=sizes):
            mine = at[starts[i] : starts[i + 1]]
            first, counts = lists[mine], lists[mine + 1] - lists[mine]
            step = np.repeat(first - np.append(0, np.cumsum(counts)[:-1]), counts)
            shared = np.bincount(posted[step + np.arange(len(step))], minlength=len(sizes))[others]
            return 100 * shared >= percent * (sizes[i] + sizes[others] - shared)

        edges += _star_edges(reps[low:high], alike)
    return _edge_batch(edges)


def confirmed_edges(docs: DataFrame, classes: DataFrame, clusters: DataFrame, s: Settings) -> DataFrame:
    """Edges (a, b) that connect exactly what links connect, from clusters (node, component) that no link leaves.

    ``classes`` tells each node's document (rep) and the hashes of its set, by which its text is known.

    A cluster of up to ``block`` documents is one group. A larger one is dealt into blocks, each compared with itself and
    the first; after that most documents of a cluster belong to one component. All that don't are compared with every
    block. A pair is left out only if it is within that component, where it can't change anything.
    """

    def with_sets(batches):
        for batch in text_slices(batches, "text", _TEXTS_AT_ONCE):
            sets = shingle_sets(*word_hashes(batch["text"]), s.words)
            same = np.logical_and.reduce([h.to_numpy() == batch[f"h{k}"].to_numpy() for k, h in enumerate(set_hashes(sets, s), 1)])
            columns = [batch["cluster"], batch["node"], batch["blocks"], batch["block"], pa.array([x.tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "rep", "blocks", "block", "shingles"]).filter(pa.array(same))

    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / s.block).alias("blocks"))
    block = F.pmod(F.xxhash64(F.lit(s.seed), "rep"), F.col("blocks"))
    members = clusters.join(sizes, "component").select(F.col("component").alias("cluster"), F.col("node").alias("rep"), "blocks")
    members = stored(members.withColumn("block", block), "clusters")
    named = members.join(classes.select(F.col("node").alias("rep"), F.col("rep").alias("doc_id"), "h1", "h2"), "rep").withColumnRenamed("rep", "node")
    named = stored(named, "named")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Stored, since the join may take no shuffle, and a task would need two Python workers.
    texts = stored(rows_that_may_be_in(texts, "doc_id", named.select("doc_id")), "texts")
    rows = texts.join(named, "doc_id").select("cluster", "node", "blocks", "block", "h1", "h2", "text")
    rows = rows.mapInArrow(with_sets, "cluster long, rep long, blocks long, block long, shingles binary")
    rows = stored(rows.filter(F.length("shingles") > 0), "sets")

    def grouped(df: DataFrame, keys: list[str]) -> DataFrame:
        def linked(table: pa.Table):
            yield _set_edges(table, keys, s.percent)

        return stored(in_groups(df.select(*keys, "rep", "shingles"), keys, linked, "a long, b long"), "links")

    everywhere = (F.col("block") == 0) & (F.col("blocks") > 1)
    copies = F.when(everywhere, F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))
    edges = grouped(rows.withColumn("block", F.explode(copies)), ["cluster", "block"])
    wide = members.filter("blocks > 1")
    if wide.isEmpty():
        return edges
    known = wide.join(components(edges), F.col("rep") == F.col("node"), "left")
    known = known.select("cluster", "rep", "blocks", "block", F.coalesce("component", "rep").alias("component"))
    known = stored(known, "known")
    largest = known.groupBy("cluster", "component").agg(F.count("*").alias("size"))
    largest = largest.groupBy("cluster").agg(F.max(F.struct("size", "component"))["component"].alias("largest"))
    outside = known.join(largest, "cluster").filter("component <> largest and block > 0").select("cluster", "rep", "blocks")
    turns = outside.groupBy("cluster").agg(F.ceil(F.count("*") / s.block).alias("turns"))
    outside = stored(outside.join(turns, "cluster").withColumn("turn", F.pmod(F.xxhash64(F.lit(s.seed + 1), "rep"), F.col("turns"))), "outside")
    if outside.isEmpty():
        return edges
    # Each turn of those outside meets each block but the first, which has been compared with all.
    some = rows.join(outside.select("cluster", "rep", "turn"), ["cluster", "rep"])
    some = some.withColumn("block", F.explode(F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)))
    every = rows.filter("block > 0").join(turns, "cluster")
    every = every.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)))
    columns = ["cluster", "block", "turn", "rep", "shingles"]
    return edges.unionByName(grouped(some.select(columns).unionByName(every.select(columns)), ["cluster", "block", "turn"]))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id and kept.

    A text is the set of its distinct runs of ``words`` words (A-Z lower-cased; with fewer words, the whole sequence);
    two are linked if intersection over union is at least ``percent`` hundredths, confirmed on the whole sets.
    component_id is the smallest doc_id that links lead to, the document's own included; kept marks it.

    Texts without words and null texts are linked with nothing. Rows without doc_id take no part: component_id null, kept
    true. Equal sets are one node, so copies cost nothing more; repeated rows are alike in all columns. Rows of one doc_id
    with different texts are documents of their own. Other columns are ignored; an empty table gives an empty result.

    The trees find a pair at the threshold but for a chance of about (1 - similarity) ** trees at the first level; deeper
    ones are reached by common passages and large groups only. Shuffled are tokens, not texts, until clusters of possible
    links are known; then their texts, and their sets once. All but the result is deleted from the shared folder.
    """
    with scratch(docs.sparkSession) as keep:
        known = _near_duplicates(docs, settings)
        kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
        return keep(known.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept), "near-texts")


def _near_duplicates(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, digest1, digest2, n, component (a group's name), component_id, and leads: whether the row's set is its component's first of that doc_id."""
    rows = stored(sketches(docs, s), "sketches")
    same = ["h1", "h2", "n"]
    classes = rows.filter("n > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "classes")
    # A node is named by its doc_id; of several sets of one doc_id all but one are named by their hashes.
    named = classes.groupBy("rep").agg(F.min("h1").alias("first"))
    node = F.when(F.col("h1") == F.col("first"), F.col("rep")).otherwise(F.xxhash64(*same))
    classes = stored(classes.join(named, "rep").select(*same, "rep", node.alias("node")), "nodes")
    reps = rows.join(classes, same).filter("doc_id = rep").select(F.col("node").alias("rep"), "tokens")
    reps = stored(reps, "reps")
    clusters = stored(components(candidate_edges(reps, s)), "clusters")
    linked = components(confirmed_edges(docs, classes, clusters, s))
    classes = stored(classes.join(linked, "node", "left").select(*same, "rep", "node", F.coalesce("component", "node").alias("component")), "linked")
    smallest = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    leading = classes.join(smallest, "component").filter(F.col("rep") == F.col("component_id")).groupBy("component").agg(F.min("node").alias("lead"))
    classes = classes.join(smallest, "component").join(leading, "component").select(*same, "component", "component_id", (F.col("node") == F.col("lead")).alias("leads"))
    found = rows.drop("tokens").join(classes, same, "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component_id")), F.col("doc_id"))
    leads = F.when(F.col("n") > 0, F.col("leads") & (F.col("doc_id") == F.col("component_id"))).otherwise(True)
    return found.select("doc_id", "digest1", "digest2", "n", "component", component.alias("component_id"), F.coalesce(leads, F.lit(True)).alias("leads"))


def without_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` less all but one of each group of near duplicates, with all their columns.

    The one that stays has the group's smallest doc_id; if that has several texts in the group, one set and, of texts of
    equal sets, one text stays. Equal rows of one doc_id are one document. Rows without doc_id and without words stay.
    """
    named = ["doc_id", "digest1", "digest2"]
    row = F.xxhash64(*named).alias("row")
    with scratch(docs.sparkSession) as keep:
        known = _near_duplicates(docs, settings).filter("doc_id is not null")
        known = known.groupBy(*named).agg(F.max("leads").alias("leads"), F.count("*").alias("rows"), F.max("component").alias("component"), F.max("n").alias("n"))
        known = stored(known, "known")
        first = known.filter("leads and n > 0").groupBy("component").agg(F.min(F.xxhash64("digest1", "digest2")).alias("first"))
        known = known.join(first, "component", "left")
        stays = F.col("leads") & ((F.col("n") == 0) | (F.xxhash64("digest1", "digest2") == F.col("first")))
        touched = keep(known.select(*named, "rows", stays.alias("stays")).filter("not stays or rows > 1"), "touched")
    # Most rows are told apart from those that may go by a filter, without a shuffle of their texts.
    given = docs.select(F.struct(*docs.columns).alias("given"), F.col("doc_id").cast("long").alias("doc_id"), *_digests()).select("given", *named, row)
    ids = touched.select(row)
    left = rows_that_may_be_in(given, "row", ids, inside=False).select("given.*")
    near = rows_that_may_be_in(given, "row", ids).join(touched.filter("not stays").select(*named), named, "left_anti")
    once = near.filter("doc_id is not null").dropDuplicates(named).unionByName(near.filter("doc_id is null"))
    return left.unionByName(once.select("given.*"))
