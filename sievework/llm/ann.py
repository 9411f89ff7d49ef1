"""Approximate nearest neighbours by balanced posting lists."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.tables import stored
from sievework.llm.vectors import as_binary, drawn, matrix, usable
from sievework.llm.workers import bounds_of, in_groups


@dataclass(frozen=True)
class Settings:
    """list_size: vectors per list aimed at; lists: most lists, all of which are held in memory with their graph.

    sample: about how many vectors the centroids are fitted on. copies: most lists of one vector. near: how much farther
    than the nearest centroid another list of a vector may be. reach: the same for the lists that a query reads; probes:
    most of these. beam: centroids that the graph search keeps in view. These three are where the search starts: they are
    raised until ``recall`` of the neighbours of about ``tried`` queries, known by brute force, is found. block: vectors
    compared with as many queries at once.
    """

    list_size: int = 400
    lists: int = 4096
    sample: int = 20_000
    rounds: int = 6
    balance: float = 0.3
    copies: int = 4
    near: float = 0.1
    reach: float = 0.2
    probes: int = 16
    beam: int = 32
    recall: float = 0.95
    tried: int = 128
    degree: int = 16
    block: int = 2048
    batch: int = 1024
    seed: int = 4


def balanced_centroids(points: np.ndarray, n: int, s: Settings) -> np.ndarray:
    """k-means in which a centroid is the farther away the more points it has already, so that lists come out even."""
    random = np.random.default_rng(s.seed)
    n = min(n, len(points))
    centroids = points[random.choice(len(points), n, replace=False)]
    square = (points * points).sum(1)
    sizes = np.zeros(n)
    for _ in range(s.rounds if n > 1 else 0):
        nearest = np.empty(len(points), int)
        spread = 0.0
        for a in range(0, len(points), 4096):
            part = points[a : a + 4096]
            d = np.maximum(square[a : a + 4096, None] - 2 * part @ centroids.T + (centroids * centroids).sum(1), 0)
            spread = spread or float(d.min(1).mean())
            nearest[a : a + 4096] = (d + s.balance * spread * sizes * n / len(points)).argmin(1)
        sizes = np.bincount(nearest, minlength=n).astype(float)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        used = sizes > 0
        centroids[used] = sums[used] / sizes[used, None]
    return np.unique(centroids, axis=0)


def centroid_graph(centroids: np.ndarray, s: Settings) -> np.ndarray:
    """Per centroid its nearest others and some random ones, which keep the graph in one piece."""
    n = len(centroids)
    random = np.random.default_rng(s.seed)
    near = min(s.degree, n - 1)
    out = np.empty((n, near + s.degree // 2), np.int64)
    square = (centroids * centroids).sum(1)
    for a in range(0, n, 1024):
        d = square - 2 * centroids[a : a + 1024] @ centroids.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = -np.inf
        out[a : a + 1024, :near] = np.argsort(d, axis=1, kind="stable")[:, 1 : near + 1]
    out[:, near:] = random.integers(0, n, (n, s.degree // 2))
    return out


def graph_search(queries: np.ndarray, centroids: np.ndarray, graph: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest centroids found for each query (ids and distances, nearest first).

    Best-first search, all queries in step: each expands the nearest centroid in view that it has not expanded yet, until
    everything in its view is expanded.
    """
    n, rows = len(centroids), np.arange(len(queries))
    beam = min(beam, n)
    square = (queries * queries).sum(1)

    def distances(ids):
        found = centroids[ids]
        return np.maximum(square[:, None] - 2 * np.einsum("qkd,qd->qk", found, queries) + (found * found).sum(2), 0)

    ids = np.tile(np.unique(np.linspace(0, n - 1, beam).astype(int)), (len(queries), 1))
    d = distances(ids)
    done = np.zeros(ids.shape, bool)
    while True:
        at = np.where(done, np.inf, d).argmin(1)
        open_ = ~done[rows, at]
        if not open_.any():
            break
        done[rows, at] = True
        new = graph[ids[rows, at]]
        both = np.concatenate([ids, new], axis=1)
        length = np.concatenate([d, distances(new)], axis=1)
        was = np.concatenate([done, np.zeros(new.shape, bool)], axis=1)
        order = np.lexsort((~was, both), axis=1)  # equal ids together, an expanded one first
        both, length, was = (np.take_along_axis(x, order, 1) for x in (both, length, was))
        length[:, 1:][both[:, 1:] == both[:, :-1]] = np.inf
        order = np.argsort(length, axis=1, kind="stable")[:, :beam]
        ids, d, done = (np.take_along_axis(x, order, 1) for x in (both, length, was))
        done |= np.isinf(d)
    return ids, np.sqrt(d)


def _tried(asked: DataFrame, width: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The ids and vectors of about ``tried`` queries, drawn by a hash of the id."""
    place = F.pmod(F.xxhash64(F.lit(s.seed + 1), "vec_id"), F.lit(1 << 30)) / float(1 << 30)
    found = asked.filter(place * asked.count() < s.tried).select("vec_id", "value").toArrow()
    ids, at = np.unique(found["vec_id"].to_numpy(), return_index=True)
    return ids, matrix(found["value"], width)[at] if len(ids) else np.empty((0, width))


def _lists_of_neighbours(rows: DataFrame, lists: DataFrame, tried: np.ndarray, points: np.ndarray, fitted: np.ndarray, k: int, width: int) -> list[list[set[int]]]:
    """Per tried query the lists of each of its k nearest vectors, by comparison with all of ``rows``.

    A task sends at most k rows a query, and none that is worse than the k nearest of the vectors ``fitted``.
    """
    bounds = np.full(len(points), -np.inf)
    if len(fitted) > k:
        bounds = np.partition(points @ fitted.T, -k - 1, axis=1)[:, -k - 1]  # the query may be one of them
        bounds -= 1e-9 * np.maximum(1.0, np.abs(bounds))

    def best(batches):
        ids, scores = [np.empty(0, np.int64)] * len(points), [np.empty(0)] * len(points)
        for batch in batches:
            names, at = np.unique(batch["vec_id"].to_numpy(), return_index=True)
            found = points @ matrix(batch["value"], width)[at].T
            for i, query in enumerate(tried.tolist()):
                hit = np.flatnonzero((found[i] >= bounds[i]) & (names != query))
                own, first = np.unique(np.append(ids[i], names[hit]), return_index=True)
                score = np.append(scores[i], found[i][hit])[first]
                order = np.lexsort((own, -score))[:k]
                ids[i], scores[i] = own[order], score[order]
        columns = [np.repeat(tried, [len(x) for x in ids]), np.concatenate([*ids, np.empty(0, np.int64)]), np.concatenate([*scores, np.empty(0)])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    found = rows.mapInArrow(best, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    pairs = found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "vec_id").collect()  # k rows a tried query
    own = lists.sparkSession.createDataFrame(sorted({(r["vec_id"],) for r in pairs}), "vec_id long")
    of: dict[int, set[int]] = {}
    for row in lists.select("list", "vec_id").join(own, "vec_id", "left_semi").distinct().collect():
        of.setdefault(row["vec_id"], set()).add(row["list"])
    held: dict[int, list[set[int]]] = {q: [] for q in tried.tolist()}
    for row in pairs:
        held[row["query_id"]].append(of[row["vec_id"]])
    return list(held.values())


def search_width(points: np.ndarray, held: list[list[set[int]]], centroids: np.ndarray, graph: np.ndarray, s: Settings) -> tuple[float, int, int]:
    """The reach, probes and beam at which the share ``recall`` of known neighbours is found; held: per point, the lists of each.

    Half of what may be missed is left to the reach, half to the probes. A beam of all centroids finds every list.
    """
    level, beam = (1 + s.recall) / 2, min(s.beam, len(centroids))
    while True:
        ids, d = graph_search(points, centroids, graph, beam)
        places, farther = [], []
        for own, length, lists in zip(ids.tolist(), d.tolist(), held, strict=True):
            at = {c: k for k, c in enumerate(own) if length[k] < np.inf}
            for place in (min((at[c] for c in some if c in at), default=None) for some in lists):
                places.append(np.inf if place is None else place + 1)
                farther.append(np.inf if place is None or (place and not length[0]) else length[place] / (length[0] or 1) - 1 if place else 0.0)
        if not places:
            return s.reach, s.probes, s.beam
        probes, reach = (float(np.quantile(x, level, method="higher")) for x in (places, farther))
        if beam == len(centroids) or 2 * probes <= beam or (probes <= s.probes and beam == s.beam):
            # A little more than the greatest ratio needed, for the rounding of distances.
            return max(s.reach, reach * (1 + 1e-9) + 1e-9), max(s.probes, int(min(probes, len(centroids)))), max(s.beam, beam)
        beam = min(len(centroids), 2 * beam)


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, settings: Settings = Settings()) -> DataFrame:
    """Per query its k nearest vectors found, by largest inner product: query_id, rank (from 1), vec_id, score.

    Both tables need vec_id and embedding; a query is never its own neighbour. Vectors get one component more, so that
    the largest inner product is the least distance. Centroids are fitted on a bounded sample; every vector goes to the
    list of its nearest centroid and, if it lies near a boundary, to those of others that are nearly as near. A query reads
    the lists whose centroids are at most ``reach`` farther than its nearest, ``probes`` at most, and as many more as hold
    enough candidates. How far and how many depends on the table: both are raised until ``recall`` of the neighbours of a
    bounded sample of the queries, compared with all vectors, are in lists that would be read. Centroids are found through
    a graph held in memory, whose size does not grow with the table. Scores are inner products of the original vectors in double precision; ties go to the smaller
    vec_id. Lists of any size are split into blocks, as are their queries, so none is gathered in one task.

    Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor do
    rows without vec_id. Repeated rows count once. With k candidates or fewer all are returned. Other columns are
    ignored; an empty table gives an empty result.
    """
    s = settings
    rows, width = usable(vectors)
    norm = F.aggregate("value", F.lit(0.0), lambda total, x: total + x * x)
    total, longest = rows.agg(F.count("*"), F.max(norm)).first()
    asked = usable(queries)[0] if queries is not vectors else rows
    if not total:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def lifted(values: np.ndarray, top: float) -> np.ndarray:
        return np.hstack([values, np.sqrt(np.maximum(top - (values * values).sum(1), 0))[:, None]])

    n_lists = max(1, min(s.lists, -(-total // s.list_size)))
    fitted = drawn(rows, s.sample, total, width, s.seed)
    centroids = balanced_centroids(lifted(fitted, longest), n_lists, s)
    graph = centroid_graph(centroids, s)

    def posted(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, s.batch):
                batch = whole.slice(low, s.batch)
                values = matrix(batch["value"], width)
                ids, d = graph_search(lifted(values, longest), centroids, graph, s.beam)
                chosen = d <= (1 + s.near) * d[:, :1]
                chosen[:, 0] = True
                chosen[:, s.copies :] = False
                at, j = np.nonzero(chosen)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at, j]), batch["vec_id"].take(pa.array(at)), as_binary(values[at])], ["list", "vec_id", "vector"])

    lists = stored(rows.mapInArrow(posted, "list long, vec_id long, vector binary"), "lists")
    sizes = np.zeros(len(centroids), np.int64)
    for row in lists.groupBy("list").agg(F.count("*").alias("n")).collect():  # a row per centroid
        sizes[row["list"]] = row["n"]
    enough = s.copies * (k + 1)
    reach, probes_, beam = s.reach, s.probes, s.beam
    if len(centroids) > s.probes:
        tried, points = _tried(asked, width, s)
        held = _lists_of_neighbours(rows, lists, tried, points, fitted, k, width)
        reach, probes_, beam = search_width(np.hstack([points, np.zeros((len(points), 1))]), held, centroids, graph, s)

    def probed(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, s.batch):
                batch = whole.slice(low, s.batch)
                values = matrix(batch["value"], width)
                points = np.hstack([values, np.zeros((len(values), 1))])
                ids, d = graph_search(points, centroids, graph, max(beam, min(len(centroids), enough)) if sizes.min() < 2 else beam)
                before = np.cumsum(sizes[ids], axis=1) - sizes[ids]
                read = d <= (1 + reach) * d[:, :1] if np.isfinite(reach) else np.isfinite(d)
                read[:, probes_:] = False
                at, j = np.nonzero(read | (before < enough))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at, j]), batch["vec_id"].take(pa.array(at)), as_binary(values[at])], ["list", "query_id", "vector"])

    probes = stored(asked.mapInArrow(probed, "list long, query_id long, vector binary"), "probes")

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("list").agg(F.ceil(F.count("*") / s.block).alias(name))

    split = stored(blocks(lists, "v_blocks").join(blocks(probes, "q_blocks"), "list"), "blocks")

    def dealt(df: DataFrame, key: str, own: str, other: str, is_query: bool) -> DataFrame:
        """A row goes to one block of its own kind, at random, and meets all blocks of the other."""
        df = df.join(split, "list").withColumn(own[0], F.pmod(F.xxhash64(F.lit(s.seed), key), F.col(own)))
        df = df.withColumn(other[0], F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        return df.select("list", "v", "q", F.lit(is_query).alias("is_query"), F.col(key).alias("id"), "vector")

    def compared(table: pa.Table):
        bounds = bounds_of(table, ["list", "v", "q"])
        everything, ids, is_query = matrix(table["vector"], width), table["id"].to_numpy(), table["is_query"].to_numpy()
        out: list[list[np.ndarray]] = [[], [], []]
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            asks = is_query[low:high]
            own, theirs = everything[low:high][asks], everything[low:high][~asks]
            names = ids[low:high][~asks]
            if not len(own) or not len(theirs):
                continue
            found = own @ theirs.T
            for i, name in enumerate(ids[low:high][asks].tolist()):
                scores = np.where(names == name, -np.inf, found[i])
                least = np.partition(scores, -k)[-k] if len(scores) > k else -np.inf
                at = np.flatnonzero((scores >= least - 1e-9 * max(1.0, abs(least))) & (scores > -np.inf)) if np.isfinite(least) else np.flatnonzero(scores > -np.inf)
                exact = (theirs[at] * own[i]).sum(1)  # the same sum wherever the pair meets, so that ties are ties
                best = np.lexsort((names[at], -exact))[:k]
                for column, values in zip(out, (np.full(len(best), name), names[at[best]], exact[best]), strict=True):
                    column.append(values)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["query_id", "vec_id", "score"])

    both = dealt(lists, "vec_id", "v_blocks", "q_blocks", False).unionByName(dealt(probes, "query_id", "q_blocks", "v_blocks", True))
    found = in_groups(both, ["list", "v", "q"], compared, "query_id long, vec_id long, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
