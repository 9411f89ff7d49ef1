"""Near-duplicate vectors: a pivot-permutation index with inverted lists."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.components import components
from sievework.llm.near_texts import _edge_batch, _star_edges
from sievework.llm.tables import scratch, stored
from sievework.llm.vectors import as_binary, drawn, matrix, usable
from sievework.llm.workers import bounds_of, in_groups, matrix_of


@dataclass(frozen=True)
class Settings:
    """similarity: least cosine of linked vectors. nearest: reference points that describe a vector, nearest first.

    shared: how many of them a candidate shares at least. pivots: most reference points; about 1.5 times the square root
    of the table's size are used. block: vectors of a list compared at once.
    """

    similarity: float = 0.95
    nearest: int = 8
    shared: int = 2
    pivots: int = 4096
    block: int = 1024
    batch: int = 2048
    seed: int = 9


def near_vectors(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Two vectors are linked if they are found and their cosine, in double precision, is ``similarity`` or more. A vector is
    described by its nearest reference points in order; each has a list of the vectors it describes. Pairs that share
    enough points are candidates. A pair is looked at in the list of the first point by number that both share, so it
    counts once; lists are split into blocks and pairs of blocks, and only sums per vector and edges that connect what is
    linked leave a task, never all pairs.

    Equal vectors are one node: each of n copies has the n - 1 others as links besides those of the node. component_id is
    the smallest vec_id that links lead to; kept marks it. Vectors that are null, zero, of another length than most, or
    hold null or non-finite components have no links, nor have rows without vec_id (component_id null, kept true).
    Repeated rows are copies of one another. Other columns are ignored; an empty table gives an empty result.
    """
    with scratch(vectors.sparkSession) as keep:
        return keep(_near_vectors(vectors, settings), "near-vectors")


def _near_vectors(vectors: DataFrame, s: Settings) -> DataFrame:
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows, width = usable(given)
    key = ["h1", "h2"]
    rows = rows.select("vec_id", "value", *[F.xxhash64(F.lit(k), "value").alias(f"h{k}") for k in (1, 2)])
    rows = stored(rows, "vectors")
    sizes = rows.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    sizes = stored(sizes, "classes")
    reps = rows.join(sizes, key).filter("vec_id = rep").dropDuplicates(["rep"]).select("rep", "copies", "value")
    reps = stored(reps, "reps")
    total = reps.count()
    linked, groups = None, None
    if total:
        n_pivots = max(s.nearest, min(s.pivots, math.ceil(1.5 * math.sqrt(total))))
        pivots = drawn(reps.withColumnRenamed("rep", "vec_id"), n_pivots, total, width, s.seed)
        pivots = pivots / np.linalg.norm(pivots, axis=1, keepdims=True)
        pairs = stored(_compared(_listed(reps, pivots, width, s), width, len(pivots), s), "pairs")
        linked = pairs.filter("a is null").groupBy("rep").agg(F.sum("links").alias("links"))
        groups = components(pairs.filter("a is not null").select("a", "b"))
        sizes = sizes.join(linked, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left")
        sizes = sizes.select(*key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
        known = rows.select("vec_id", *key).join(sizes, key).groupBy("vec_id").agg(F.max("links").alias("links"), F.min("component").alias("component"))
        found = given.select("vec_id").join(known, "vec_id", "left")
    else:
        found = given.select("vec_id", F.lit(0).alias("links"), F.lit(None).cast("long").alias("component"))
    component = F.coalesce("component", "vec_id")
    found = found.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _listed(reps: DataFrame, pivots: np.ndarray, width: int, s: Settings) -> DataFrame:
    """A row per vector and describing reference point: list, rep, copies, near (all of them, in order), vector (of length 1)."""
    nearest = min(s.nearest, len(pivots))

    def listed(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, s.batch):
                batch = whole.slice(low, s.batch)
                values = matrix(batch["value"], width)
                values = values / np.abs(values).max(1, keepdims=True)
                values = values / np.linalg.norm(values, axis=1, keepdims=True)
                near = np.argsort(-(values @ pivots.T), axis=1, kind="stable")[:, :nearest].astype("<i4")
                at = np.repeat(np.arange(len(values)), nearest)
                names = pa.array([x.tobytes() for x in near], pa.binary())
                columns = [pa.array(near.ravel().astype(np.int64)), *[batch[c].take(pa.array(at)) for c in ("rep", "copies")], names.take(pa.array(at))]
                yield pa.RecordBatch.from_arrays([*columns, as_binary(values[at])], ["list", "rep", "copies", "near", "vector"])

    return reps.mapInArrow(listed, "list long, rep long, copies long, near binary, vector binary")


def _compared(lists: DataFrame, width: int, n_pivots: int, s: Settings) -> DataFrame:
    """(rep, links) rows: linked vectors found in one block pair; and (a, b) rows: edges that connect what is linked."""
    nearest, shared = min(s.nearest, n_pivots), min(s.shared, n_pivots)
    lists = stored(lists, "lists")
    blocks = lists.groupBy("list").agg(F.ceil(F.count("*") / s.block).alias("blocks"))
    own = F.pmod(F.xxhash64(F.lit(s.seed), "rep"), F.col("blocks"))
    rows = lists.join(blocks, "list").withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("list", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "rep", "copies", "near", "vector")

    def compared(table: pa.Table):
        reps, copies, block = (table[c].to_numpy() for c in ("rep", "copies", "own"))
        near, values = matrix_of(table["near"], nearest, "<i4"), matrix(table["vector"], width)
        bounds = bounds_of(table, ["list", "low", "high"])
        edges, names, links = [], [], []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            here = table["list"][a].as_py()
            first = table["low"][a].as_py()
            left = np.flatnonzero(block[a:b] == first) + a
            right = np.flatnonzero(block[a:b] == table["high"][a].as_py()) + a
            if not len(left) or not len(right):
                continue
            points, at = np.unique(near[a:b], return_inverse=True)
            at = at.reshape(-1, nearest)
            marks = np.zeros((b - a, len(points)), np.float32)
            marks[np.arange(b - a)[:, None], at] = 1
            x, y = marks[left - a], marks[right - a]
            ok = (values[left] @ values[right].T >= s.similarity) & (x @ y.T >= shared)
            earlier = points < here
            ok &= x[:, earlier] @ y[:, earlier].T == 0
            same = first == table["high"][a].as_py()
            if same:
                np.fill_diagonal(ok, False)
            if not ok.any():
                continue
            names += [reps[left]] if same else [reps[left], reps[right]]
            links += [ok @ copies[right]] if same else [ok @ copies[right], ok.T @ copies[left]]
            both = ok
            if not same:  # one square table of both sides
                both = np.zeros((len(left) + len(right),) * 2, bool)
                both[: len(left), len(left) :] = ok
                both[len(left) :, : len(left)] = ok.T
            members = reps[left] if same else np.concatenate([reps[left], reps[right]])
            edges += _star_edges(members, lambda i, others, both=both: both[i, others])
        if names:
            name, count = np.concatenate(names), np.concatenate(links)
            some = count > 0
            none = pa.nulls(int(some.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(name[some]), pa.array(count[some])], ["a", "b", "rep", "links"])
            pairs = _edge_batch(edges)
            none = pa.nulls(pairs.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pairs["a"], pairs["b"], none, none], ["a", "b", "rep", "links"])

    return in_groups(rows, ["list", "low", "high"], compared, "a long, b long, rep long, links long")
