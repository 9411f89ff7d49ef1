"""A prefix trie of conversations: which of them share their first turns, and what sharing saves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.mixing import n_words
from sievework.llm.running import running
from sievework.llm.tables import scratch, stored
from sievework.llm.workers import bounds_of, in_groups

MOST_TURNS = 1 << 10  # turns of a shard
IDS_PER_BLOCK = 4096
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_id", "end_convs"]
_TOP = ["p1", "p2", "up1", "up2", "before", "node_words"]


def turns_of(log: DataFrame) -> DataFrame:
    """conv_id, place, words and two digests of each turn; turns go by number, null first, ties by the digests."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = log.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), n_words(text).alias("words"),
        *[F.xxhash64(F.lit(k), role, text).alias(f"digest{k}") for k in (1, 2)], F.monotonically_increasing_id().alias("row"),
    )
    placed = running(stored(rows, "turns"), "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest1"), F.col("digest2"), F.col("row")])
    return placed.select("conv_id", "place", "words", "digest1", "digest2")


def rebuilt_turns(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations that take over the start of another, and all conversations (conv_id), turnless ones too.

    With h = crc32(decimal conv_id) % ``most``, conversation c has the first h turns of c - c % ``every`` (all if fewer, none if
    absent), then its own turns after its first h.
    """
    turns = stored(turns, "placed")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = stored(sizes.select("conv_id", "n", taken.alias("taken"), (F.col("conv_id") - F.col("conv_id") % every).alias("base")), "conversations")
    found = convs.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    found = stored(found.select("conv_id", "base", "taken", F.least("taken", F.coalesce("base_n", F.lit(0))).alias("had")), "taken")
    starts = turns.filter(F.col("place") < most).withColumnRenamed("conv_id", "base")
    starts = starts.join(found.filter("had > 0"), "base").filter("place <= had").select("conv_id", "place", "words", "digest1", "digest2")
    own = turns.withColumn("taken", taken).filter("place > taken").join(found.filter("had < taken").select("conv_id", "had"), "conv_id", "left")
    place = F.col("place") - F.col("taken") + F.coalesce("had", "taken")
    own = own.select("conv_id", place.alias("place"), "words", "digest1", "digest2")
    return starts.unionByName(own), convs.select("conv_id")


def _shard_nodes(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The nodes of the subtrees that a task holds, one shard (s1, s2) after the other."""
    out: dict[str, list] = {c: [] for c in (*_NODE, *_TOP)}
    bounds = bounds_of(table, ["s1", "s2"])
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        _add_nodes(table.slice(low, high - low), out)
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out.values()], list(out))


def _add_nodes(shard: pa.Table, out: dict[str, list]) -> None:
    """Depth first through one subtree, by vertical bitmaps.

    Conversations are numbered by id; a posting is the set of those with a given turn at a given place, as the bits of one
    number. A node's set and the posting of a next turn give a child's set; sets of bits of the copies' counts add up the
    members, the lowest bit is the smallest of them, and the set of those of a given length tells who ends.
    """
    ids, at = np.unique(shard["rep"].to_numpy(), return_inverse=True)
    order = np.lexsort((shard["place"].to_numpy(), at))
    x1, x2, words = (shard[c].to_numpy()[order].tolist() for c in ("x1", "x2", "words"))
    starts = np.searchsorted(at[order], np.arange(len(ids)))
    weights, lengths = (shard[c].to_numpy()[order][starts].tolist() for c in ("weight", "length"))
    ids, starts = ids.tolist(), starts.tolist()
    first = order[0]
    top = shard["place"][first].as_py()
    postings: dict[tuple[int, int], int] = {}
    for turn, conversation in zip(zip(x1, x2, strict=True), at[order].tolist(), strict=True):
        postings[turn] = postings.get(turn, 0) | 1 << conversation
    ending: dict[int, int] = {}
    for i, length in enumerate(lengths):
        ending[length] = ending.get(length, 0) | 1 << i
    planes = [sum(1 << i for i, w in enumerate(weights) if w >> k & 1) for k in range(max(weights).bit_length())]

    base = len(out["depth"])
    parents, own_words = [], []
    open_ = [((1 << len(ids)) - 1, top, -1)]
    while open_:
        members, depth, parent = open_.pop()
        node = len(parents)
        smallest = (members & -members).bit_length() - 1
        turn = starts[smallest] + depth - top
        n_convs = sum((members & plane).bit_count() << k for k, plane in enumerate(planes))
        ended = members & ending.get(depth, 0)
        rest, children = members ^ ended, 0
        while rest:
            i = starts[(rest & -rest).bit_length() - 1] + depth + 1 - top
            child = members & postings[x1[i], x2[i]]
            open_.append((child, depth + 1, node))
            rest &= ~child
            children += 1
        parents.append(parent)
        own_words.append(words[turn])
        last = ended.bit_length() - 1  # different conversations of one length don't end at one node
        values = (ids[smallest], depth, out["conv_id"][base + parent] if parent >= 0 else None, n_convs, children, int(not children), (n_convs - 1) * words[turn])
        for name, value in zip(_NODE, (*values, ids[last] if ended else None, weights[last] if ended else 0), strict=True):
            out[name].append(value)
        for name in _TOP:
            out[name].append(None)
    for node in range(len(parents) - 1, 0, -1):
        for name in ("n_leaves", "saved_tokens"):
            out[name][base + parents[node]] += out[name][base + node]
    p1, p2, run = (shard[c][first].as_py() for c in ("p1", "p2", "run_words"))
    for name, value in zip(_TOP, (p1, p2, p1 ^ x1[0], p2 ^ x2[0], run - words[0], sum(own_words)), strict=True):
        out[name][base] = value


def _hashed(batches) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation list, from its blocks as they come, sorted."""
    current, digest = None, None
    for batch in batches:
        done: list[tuple[int, str]] = []
        for end_id, ids in zip(batch["end_id"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if end_id != current:
                if current is not None:
                    done.append((current, digest.hexdigest()))
                current, digest = end_id, hashlib.sha256()
                digest.update(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _digests(done)
    if current is not None:
        yield _digests([(current, digest.hexdigest())])


def _digests(rows: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["end_id", "ends_sha256"])


def trie_of(turns: DataFrame, convs: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, place from 1 without gaps, words, digest1, digest2) of ``convs`` (conv_id).

    A first-d-turns prefix is known by its length and two 64-bit hashes, each the exclusive or of hashes of (place, turn).
    Conversations of equal turns are one with a count. Nodes with more than ``most_turns`` turns from their own on down are few: they are
    aggregated over their conversations, however many. Every other subtree is a shard, searched by ``_add_nodes``.
    """
    hashed = [F.xxhash64(F.lit(k), "place", f"digest{k}").alias(f"x{k}") for k in (1, 2)]
    turns = running(turns.select("conv_id", "place", "words", *hashed).withColumnRenamed("place", "at"), "conv_id", [F.col("at")], ["x1", "x2"], ["words"])
    turns = turns.select("conv_id", "place", "words", "x1", "x2", F.col("run_x1").alias("p1"), F.col("run_x2").alias("p2"), "run_words")
    turns = stored(turns, "prefixes")
    whole = turns.groupBy("conv_id").agg(F.count("*").alias("length"), F.bit_xor("x1").alias("e1"), F.bit_xor("x2").alias("e2"), F.sum("words").alias("total"))
    none = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("length", "e1", "e2", "total")]
    whole = stored(convs.join(whole, "conv_id", "left").select("conv_id", *none), "whole")
    same = ["length", "e1", "e2"]
    classes = stored(whole.groupBy(*same).agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight"), F.max("total").alias("total")), "classes")
    paths = stored(turns.withColumnRenamed("conv_id", "rep").join(classes.drop("e1", "e2"), "rep"), "paths")

    node = ["place", "p1", "p2"]
    large = paths.groupBy(*node).agg(F.sum(F.col("length") - F.col("place") + 1).alias("below")).filter(F.col("below") > most_turns).select(*node)
    upper = stored(paths.join(large, node), "upper")
    tops = upper.groupBy("rep").agg(F.max("place").alias("top"))
    lower = stored(paths.join(tops, "rep", "left").withColumn("top", F.coalesce("top", F.lit(0))).filter("place > top"), "lower")
    shards = lower.filter("place = top + 1").select("rep", F.col("p1").alias("s1"), F.col("p2").alias("s2"))
    columns = ["s1", "s2", "rep", "place", "x1", "x2", "p1", "p2", "words", "run_words", "weight", "length"]
    found = in_groups(lower.join(shards, "rep").select(*columns), ["s1", "s2"], _shard_nodes, ", ".join(f"{c} long" for c in (*_NODE, *_TOP)))
    found = stored(found, "nodes")
    inner, roots = found.filter("p1 is null").select(*_NODE), found.filter("p1 is not null")

    high = _upper_nodes(upper, roots)
    parents = high.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.col("conv_id").alias("parent"))
    ends = upper.filter("place = length").select(F.col("place").alias("depth"), "p1", "p2", F.col("rep").alias("end_id"), F.col("weight").alias("end_convs"))
    high = high.join(ends, ["depth", "p1", "p2"], "left").withColumn("end_convs", F.coalesce("end_convs", F.lit(0)))
    some = stored(high.select(*_NODE, "up1", "up2").unionByName(roots.select(*_NODE, "up1", "up2")), "tops")

    ours = classes.agg(F.min("rep").alias("rep"), F.sum("weight").alias("weight"), F.min(F.when(F.col("length") == 0, F.col("rep"))).alias("end"), F.max(F.when(F.col("length") == 0, F.col("weight"))).alias("ends")).first()
    if ours["rep"] is None:
        return inner.select(*_NODE[:-2], F.lit("").alias("ends_sha256"))
    below = some.filter("depth = 1").agg(F.count("*").alias("n"), F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("leaves"), F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved")).first()
    root = (ours["rep"], 0, None, ours["weight"], below["n"], below["leaves"], below["saved"], ours["end"], ours["ends"] or 0)
    root = paths.sparkSession.createDataFrame([root], ", ".join(f"{c} long" for c in _NODE))
    first = some.filter("depth = 1").withColumn("parent_conv_id", F.lit(ours["rep"]).cast("long")).select(*_NODE)
    deeper = some.filter("depth > 1").drop("parent_conv_id").join(parents, ["depth", "up1", "up2"]).withColumnRenamed("parent", "parent_conv_id").select(*_NODE)
    nodes = inner.unionByName(root).unionByName(first).unionByName(deeper)
    return _with_ends(nodes, whole, classes)


def _upper_nodes(upper: DataFrame, roots: DataFrame) -> DataFrame:
    """The nodes above the shards, from their conversations' rows (``upper``) and the shards' ``roots``.

    saved_tokens is the words of all members from the node on less those of the subtree's nodes. A node's words count for
    its smallest member: a shard's for its smallest, with those of the upper nodes that have the same.
    """
    node = ["place", "p1", "p2"]
    before = (F.col("run_words") - F.col("words")).alias("before")
    upward = [F.min(F.col(f"p{k}").bitwiseXOR(F.col(f"x{k}"))).alias(f"up{k}") for k in (1, 2)]
    least = stored(upper.select("*", before).groupBy(*node).agg(F.min("rep").alias("conv_id"), F.min("before").alias("before"), *upward), "upper-nodes")
    firsts = least.groupBy("conv_id").agg(F.min("before").alias("first_before"))
    zero = F.lit(0).cast("long")
    leads = roots.select(F.col("conv_id").alias("rep"), "node_words", F.col("n_leaves").alias("leaves"), "before")
    leads = leads.unionByName(upper.filter("place = length").select("rep", zero.alias("node_words"), zero.alias("leaves"), F.col("total").alias("before")))
    leads = leads.join(firsts.withColumnRenamed("conv_id", "rep"), "rep", "left")
    leads = leads.select("rep", "leaves", (F.col("node_words") + F.col("before") - F.coalesce("first_before", "before")).alias("words_below"))
    sums = [F.sum("weight").alias("n_convs"), F.sum(F.col("weight") * F.col("total")).alias("all_words")]
    sums += [F.sum(F.coalesce("words_below", F.lit(0))).alias("words_below"), F.sum(F.coalesce("leaves", F.lit(0))).alias("n_leaves")]
    total = upper.join(leads, "rep", "left").groupBy(*node).agg(*sums)
    up = [F.col("place").alias("depth"), "up1", "up2"]
    children = least.select(*up).unionByName(roots.select("depth", "up1", "up2"))
    children = children.groupBy((F.col("depth") - 1).alias("place"), F.col("up1").alias("p1"), F.col("up2").alias("p2")).agg(F.count("*").alias("n_children"))
    out = total.join(least, node).join(firsts, "conv_id").join(children, node)
    saved = F.col("all_words") - F.col("n_convs") * F.col("before") - (F.col("words_below") + F.col("first_before") - F.col("before"))
    out = out.withColumn("saved_tokens", saved).withColumn("parent_conv_id", F.lit(None).cast("long"))
    return out.select("conv_id", F.col("place").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "p1", "p2", "up1", "up2")


def _with_ends(nodes: DataFrame, whole: DataFrame, classes: DataFrame) -> DataFrame:
    """Adds ends_sha256. Lists of many ids are written in blocks by many tasks, and hashed as a stream of blocks."""
    copies = whole.join(classes.filter("weight > 1").select("length", "e1", "e2", F.col("rep").alias("end_id")), ["length", "e1", "e2"]).select("end_id", "conv_id")
    placed = running(copies, "end_id", [F.col("conv_id")])
    blocks = placed.groupBy("end_id", F.floor((F.col("place") - 1) / IDS_PER_BLOCK).alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    blocks = blocks.select("end_id", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    lists = blocks.repartition("end_id").sortWithinPartitions("end_id", "block").mapInArrow(_hashed, "end_id long, ends_sha256 string")
    out = _NODE[:-2]

    def hashed(ids: Column) -> Column:
        return F.sha2(ids.cast("binary"), 256).alias("ends_sha256")

    alone = F.when(F.col("end_convs") == 1, F.col("end_id").cast("string")).otherwise(F.lit(""))
    return nodes.filter("end_convs <= 1").select(*out, hashed(alone)).unionByName(nodes.filter("end_convs > 1").join(lists, "end_id").select(*out, "ends_sha256"))


def prefix_trie(log: DataFrame, rebuild: bool = False, most_turns: int = MOST_TURNS) -> DataFrame:
    """The prefix trie of the conversations of ``log`` (conv_id, turn, role, text; other columns are ignored), a row a node:

    conv_id (the smallest member) and depth, which name the node, as the first ``depth`` turns of that conversation;
    parent_conv_id (null at the root), n_convs (members, all conversations that begin so), n_children, n_leaves (childless nodes
    from here on), saved_tokens (for each node from here on, the words of its last turn times one less than its members)
    and ends_sha256 (of the ids of the members that end here, ascending, joined by commas).

    Null role and text are empty. Turns go by number, null first, those of one number by hashes of role and text; equal
    rows are as many turns. Rows without conv_id belong to none. An empty table gives an empty result, not even a
    root. With ``rebuild`` conversations first take over turns of others, see ``rebuilt_turns``; they may end up turnless.

    No task holds more than ``most_turns`` turns of one subtree; of texts only digests are moved.
    """
    with scratch(log.sparkSession) as keep:
        turns = turns_of(log)
        turns, convs = rebuilt_turns(turns) if rebuild else (stored(turns, "placed"), None)
        convs = turns.select("conv_id").distinct() if convs is None else convs
        return keep(trie_of(turns, convs, most_turns), "trie")
