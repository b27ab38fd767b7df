"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph for each shard.

Equal vectors are one point that carries its smallest ids (as many as an answer can hold, and one more for a query that is
itself among them), so copies neither crowd the graph nor lose an answer. Points are dealt at random to shards of a bounded expected
size, which grows with the table up to that bound, as every shard is asked about every query. A shard's graph is kept as flat
arrays: for each layer one row of neighbours for each of its points. The greatest inner
product becomes the least distance by one more component that gives all points of a shard the same length. A point's candidates are
its exactly nearest points among those before it, by products of whole blocks; links back are added and thinned when a layer is
complete. Many queries walk a graph side by side, each with its own list of the best points, so a step is a few operations on arrays.
How broadly a graph must be searched depends on its vectors (most on how uneven their lengths are), so each shard finds its own
breadth when it is built: raised until enough of the exact answers of a fixed number of its points are found, each of them by a walk
that passes over the point itself, as most queries that come to a shard are not among its points. Every block of queries is searched in
every shard of its dimension, some blocks and one shard at a time, and the shards' answers are merged by score.

Vectors that are null, empty, zero or hold a null or non-finite component take no part; neither do rows without an id, nor
pairs of different dimensions. Ties go to the smaller id. Ids that occur in several rows are ranked once, with their best vector.
An empty table gives no row. Graphs are built and walked in single precision; scores are double-precision inner products of the
original vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.base import read
from tidewire.session import cut_lineage

#: Least expected points of a shard, most expected numbers of one above that (shorter vectors than of 64 count as such),
#: shards that a table has before they grow, most partitions of a step.
SHARD, NUMBERS, SPREAD, PARTITIONS = 4096, 1 << 21, 8, 20_000
#: Queries of a block, most blocks that meet a shard at once, meetings that a search has if its blocks suffice.
BLOCK, BLOCKS, MEETINGS = 256, 64, 32
#: Neighbours of a point on upper layers, breadth of building, least breadth of searching, breadth on upper layers.
LINKS, BUILD_BREADTH, SEARCH_BREADTH, UPPER_BREADTH = 16, 64, 96, 16
#: Points of a shard whose exact answers set its breadth, and the share of them that must be found.
PROBES, FOUND = 48, 0.97
#: Numbers that a table of one step of building or walking may hold, those that fit a core's cache, and the key of no point.
CELLS, CHUNK, NONE = 1 << 22, 1 << 16, np.iinfo(np.int64).max


class Graph:
    """Flat arrays: vectors, and for each layer the points on it and their neighbours (-1 where there is none)."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, breadth: int = BUILD_BREADTH):
        self._hold(vectors)
        length = (self.walked.astype(np.float64) ** 2).sum(axis=1)
        reach = length.max(initial=0.0)
        # the component that makes all lengths equal, less its greatest value, so that short vectors keep their precision
        last = -length / np.maximum(np.sqrt(reach - length) + np.sqrt(reach), 1e-30)
        points = np.column_stack((self.walked, last.astype(np.float32)))
        self.links, self.breadth = links, breadth
        n = len(vectors)
        draws = np.random.default_rng(n).random(n)
        level = np.minimum(12, np.floor(-np.log(np.maximum(draws, 1e-12)) / np.log(links))).astype(np.int64)
        top = int(level.max(initial=0))
        self.entry = int(level.argmax()) if n else -1
        self.layers = [self._layer(points, np.flatnonzero(level >= layer), links * (2 if layer == 0 else 1)) for layer in range(top + 1)]

    def _hold(self, vectors: np.ndarray) -> None:
        """The vectors as given, and in single precision on a scale on which no square overflows."""
        self.vectors = vectors
        self.walked = (vectors / max(float(np.abs(vectors).max(initial=0.0)), np.finfo(np.float64).tiny)).astype(np.float32)

    def _layer(self, points: np.ndarray, members: np.ndarray, most: int) -> np.ndarray:
        """Each member's links to members before it, and the links back, at most that many for each."""
        own = points[members]
        size, n = (own**2).sum(axis=1), len(members)
        links = np.full((n, self.links), -1, dtype=np.int64)
        gaps = np.full((n, self.links), np.inf, dtype=np.float32)
        low = 0
        while low < n:
            high = min(n, low + max(1, min(512, CELLS // (low + 512), CELLS // (self.breadth * own.shape[1]))))
            distance = own[low:high] @ own[:high].T
            distance *= -2
            distance += size[:high]
            distance[:, low:high][np.triu_indices(high - low)] = np.inf
            near = _least(distance, min(self.breadth, high))
            gap = np.take_along_axis(distance, near, axis=1) + size[low:high, None]
            links[low:high], gaps[low:high] = self._diverse(own, size, near, gap, self.links)
            low = high
        table = self._both_ways(own, size, links, gaps, most)
        out = np.full((len(points), most), -1, dtype=np.int32)
        out[members] = np.where(table >= 0, members[table], -1)
        return out

    @staticmethod
    def _diverse(own: np.ndarray, size: np.ndarray, near: np.ndarray, gap: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row, candidates nearer to its point than to any chosen before, filled up with the nearest others."""
        order = np.argsort(gap, axis=1, kind="stable")
        near, gap = np.take_along_axis(near, order, axis=1), np.take_along_axis(gap, order, axis=1)
        there, vectors, sizes = np.isfinite(gap), own.take(near, axis=0), size.take(near)
        between = vectors @ vectors.transpose(0, 2, 1)
        between *= -2
        between += sizes[:, :, None]
        between += sizes[:, None, :]
        closest = np.full(gap.shape, np.inf, dtype=np.float32)
        chosen, count = np.zeros(gap.shape, dtype=bool), np.zeros(len(gap), dtype=np.int64)
        for i in range(gap.shape[1]):
            new = np.flatnonzero((gap[:, i] < closest[:, i]) & there[:, i] & (count < most))
            chosen[new, i] = True
            count[new] += 1
            closest[new] = np.minimum(closest[new], between[new, i])
        first = np.argsort(np.where(chosen, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :most]
        near, gap = np.take_along_axis(near, first, axis=1), np.take_along_axis(gap, first, axis=1)
        missing = ((0, 0), (0, most - near.shape[1]))
        return np.pad(np.where(np.isfinite(gap), near, -1), missing, constant_values=-1), np.pad(gap, missing, constant_values=np.inf)

    def _both_ways(self, own: np.ndarray, size: np.ndarray, links: np.ndarray, gaps: np.ndarray, most: int) -> np.ndarray:
        """The links and those back; where they are too many, diverse ones of the nearest four times as many."""
        n = len(links)
        point, other = np.nonzero(links >= 0)[0].astype(np.int32), links[links >= 0].astype(np.int32)
        start, end, gap = np.concatenate((point, other)), np.concatenate((other, point)), np.tile(gaps[links >= 0], 2)
        order = np.lexsort((gap, start))
        start, end, gap = start[order], end[order], gap[order]
        count = np.bincount(start, minlength=n)
        first = np.cumsum(count) - count
        rank = np.arange(len(start)) - first[start]
        out = np.full((n, most), -1, dtype=np.int32)
        kept = rank < most
        out[start[kept], rank[kept]] = end[kept]
        many = np.flatnonzero(count > most)
        many = many[np.argsort(count[many], kind="stable")]
        step = max(1, min(256, CELLS // (4 * most * own.shape[1])))
        for low in range(0, len(many), step):
            at = many[low : low + step]
            place = np.arange(min(4 * most, int(count[at[-1]])))
            there, place = place < count[at, None], np.minimum(first[at, None] + place, len(end) - 1)
            out[at] = self._diverse(own, size, end[place], np.where(there, gap[place], np.float32(np.inf)), most)[0]
        return out

    def _keys(self, queries: np.ndarray, rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        """A number for each pair of query and point: the greatest inner product first, then the point; the last bit is free."""
        product = np.empty(len(points), dtype=np.float32)
        step = max(1, CHUNK // queries.shape[1])
        for low in range(0, len(points), step):  # a few pairs at a time, whose vectors stay in the cache
            at = slice(low, low + step)
            np.einsum("ij,ij->i", self.walked.take(points[at], axis=0), queries.take(rows[at], axis=0), out=product[at])
        bits = np.negative(product, out=product).view(np.int32)
        return ((bits ^ ((bits >> 31) & 0x7FFFFFFF)).astype(np.int64) << 32) | (points.astype(np.int64) << 1)

    def _search(self, queries: np.ndarray, start: np.ndarray, breadth: int, layer: int, without: np.ndarray | None) -> np.ndarray:
        """The nearest points found from each query's start points, nearest first, -1 where there is none.

        A walk passes over the query's point in without; as a start point alone it is met.
        """
        table, n = self.layers[layer], len(self.walked)
        together = _together(breadth)
        seen = np.zeros(len(queries) * n, dtype=np.uint16)
        best = np.full((len(queries), breadth), NONE, dtype=np.int64)
        out = np.full((len(queries), breadth), -1, dtype=np.int64)
        walking = np.arange(len(queries))
        rows, columns = np.nonzero(start >= 0)
        points = start[rows, columns]
        seen[rows * n + points] = 1
        if without is not None:
            seen[np.arange(len(queries)) * n + without] = 1
        best = _joined(best, rows, self._keys(queries, rows, points))
        while len(walking):
            left = (best & 1) == 0
            at = np.flatnonzero(left & (np.cumsum(left, axis=1, dtype=np.int32) <= together))
            rows, points = at // breadth, (best.take(at) >> 1) & 0x7FFFFFFF
            best.reshape(-1)[at] |= 1
            near = table.take(points, axis=0).ravel()
            at = np.flatnonzero(near >= 0)
            which, near = at // table.shape[1], near.take(at)
            places = (walking.take(rows) * n).take(which) + near
            new = np.flatnonzero(seen.take(places) == 0)
            which, near, places = which.take(new), near.take(new), places.take(new)
            # of a point met from several others in this step one stays, as the mark that is written last
            marks = (np.arange(1, 1 + len(rows)) - np.searchsorted(rows, rows)).astype(np.uint16).take(which)
            seen[places] = marks
            once = np.flatnonzero(seen.take(places) == marks)
            rows, near = rows.take(which.take(once)), near.take(once)
            keys = self._keys(queries, walking.take(rows), near)
            good = np.flatnonzero(keys < best[:, -1].take(rows))
            best = _joined(best, rows.take(good), keys.take(good))
            left = ((best & 1) == 0).any(axis=1)
            if not left.all():
                done = best[~left]
                out[walking[~left]] = np.where(done == NONE, -1, (done >> 1) & 0x7FFFFFFF)
                best, walking = best[left], walking[left]
        return out

    def nearest_each(self, vectors: np.ndarray, breadth: int, without: np.ndarray | None = None) -> np.ndarray:
        """For each vector a row of points near it, the greatest inner product first as far as found, -1 where there is none."""
        breadth = min(breadth, len(self.vectors))
        scale = np.maximum(np.abs(vectors).max(axis=1, initial=0.0), np.finfo(np.float64).tiny)
        queries = (vectors / scale[:, None]).astype(np.float32)
        n, links = self.layers[0].shape
        # queries side by side, so that their marks, their lists and the links they follow stay small
        side = max(1, min(2 * CELLS // n, CELLS // (4 * breadth), CELLS // (16 * links * _together(breadth))))
        out = np.empty((len(queries), breadth), dtype=np.int64)
        for low in range(0, len(queries), side):
            some, passed = queries[low : low + side], None if without is None else without[low : low + side]
            start = np.full((len(some), 1), self.entry)
            for layer in range(len(self.layers) - 1, 0, -1):
                start = self._search(some, start, UPPER_BREADTH, layer, passed)
            out[low : low + side] = self._search(some, start, breadth, 0, passed)
        return out

    def nearest(self, vector: np.ndarray, breadth: int) -> np.ndarray:
        """Points near the vector, the greatest inner product first as far as found."""
        found = self.nearest_each(np.asarray(vector)[None], breadth)[0]
        return found[found >= 0]


def _together(breadth: int) -> int:
    """Points of a query's list that are left in one step."""
    return max(4, breadth // 12)


def _least(table: np.ndarray, k: int) -> np.ndarray:
    """The columns of each row's k least values."""
    if k == table.shape[1]:
        return np.broadcast_to(np.arange(k), table.shape)
    rows, columns = np.divmod(np.flatnonzero(table <= np.partition(table, k - 1, axis=1)[:, k - 1 : k]), table.shape[1])
    if len(rows) > k * len(table):  # ties
        columns = columns[np.arange(len(rows)) - np.searchsorted(rows, rows) < k]
    return columns.reshape(-1, k)


def _joined(best: np.ndarray, rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The least numbers of each row and of the given ones (ordered by row), in order."""
    if not len(rows):
        return best
    count = np.bincount(rows, minlength=len(best))
    more = np.full((len(best), int(count.max())), NONE, dtype=np.int64)
    more[rows, np.arange(len(rows)) - (np.cumsum(count) - count)[rows]] = keys
    return np.ascontiguousarray(np.sort(np.concatenate((best, more), axis=1), axis=1)[:, : best.shape[1]])


def needed_breadth(graph: Graph, k: int, breadth: int = SEARCH_BREADTH, probes: int = PROBES, share: float = FOUND) -> int:
    """The least of breadth, half as much again and so on that finds that share of the k nearest others of evenly spaced points."""
    n = len(graph.vectors)
    if breadth >= n:
        return breadth
    k, own = min(k, n - 1), np.linspace(0, n - 1, min(n, probes)).astype(np.int64)
    asked = graph.vectors[own]
    scores = asked @ graph.vectors.T
    scores[np.arange(len(own)), own] = -np.inf
    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    while breadth < n:
        near = graph.nearest_each(asked, breadth, own)
        found = ((np.take_along_axis(scores, np.maximum(near, 0), axis=1) >= least[:, None]) & (near >= 0)).sum(axis=1)
        if np.minimum(found, k).sum() >= share * k * len(asked):
            break
        breadth += breadth // 2
    return breadth


def graph_row(dimension: int, shard: int, vectors: np.ndarray, ids: list, k: int) -> dict:
    graph = Graph(vectors)
    flat = [np.ascontiguousarray(x).tobytes() for x in graph.layers]
    breadth = needed_breadth(graph, k + 1)
    single = vectors.astype(np.float32)
    kept = single if (single == vectors).all() else vectors  # half the bytes where that loses nothing
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    row = {"dim": dimension, "shard": shard, "entry": graph.entry, "breadth": breadth, "vectors": kept.tobytes(), "layers": flat}
    return row | {"ids": np.concatenate(ids).astype(np.int64).tobytes(), "ends": ends.tobytes()}


def restored(row) -> Graph:
    """A graph from its stored arrays."""
    graph = Graph.__new__(Graph)
    n = len(row.ends) // 8
    kind = np.float32 if len(row.vectors) == 4 * n * row.dim else np.float64
    graph._hold(np.frombuffer(row.vectors, dtype=kind).reshape(n, row.dim))
    graph.entry = row.entry
    graph.layers = [np.frombuffer(x, dtype=np.int32).reshape(n, -1) for x in row.layers]
    return graph


def built_rows(k: int):
    """The graph of one shard, to be searched for k answers."""

    def rows(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("point", ignore_index=True)
        vectors = np.stack(group["vector"].to_numpy()).astype(np.float64)
        return pd.DataFrame([graph_row(int(key[0]), int(key[1]), vectors, list(group["ids"]), k)])

    return rows


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, every component finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0)


def vectors_of(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    # adding zero turns a negative zero into a positive one, so that equal vectors are equal as keys
    return rows.filter(F.col("id").isNotNull() & F.coalesce(usable(F.col("vector")), F.lit(False))).withColumn("vector", F.transform("vector", lambda x: x + 0.0))


def build_index(
    table: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD, numbers: int = NUMBERS
) -> DataFrame:
    """One row for each shard: dim, shard, entry, breadth, vectors, ids of all points and where each point's end, layers."""
    rows = vectors_of(table, id_col, vector_col).withColumn("point", F.xxhash64("vector"))
    few = Window.partitionBy("point", "vector").orderBy("id")
    points = rows.dropDuplicates(["id", "point"]).withColumn("n", F.row_number().over(few)).filter(F.col("n") <= k + 1)
    points = points.groupBy("point", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = cut_lineage(points.withColumn("dim", F.size("vector")))
    n, widest = points.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(1))).first()
    shards = max(1, -(-n // max(shard, min(numbers // max(64, widest), n // SPREAD))))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("point", F.lit(1)), F.lit(shards)).cast("int"))
    # dealt by number, to far more partitions than shards, so that few shards share a task
    return dealt.repartition(min(16 * shards, PARTITIONS), "dim", "shard").groupBy("dim", "shard").applyInPandas(
        built_rows(k), "dim int, shard int, entry int, breadth int, vectors binary, ids binary, ends binary, layers array<binary>"
    )


def answers_in(shard, queries: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """The best answers of some queries in one shard."""
    graph = restored(shard)
    ids, ends = np.frombuffer(shard.ids, dtype=np.int64), np.frombuffer(shard.ends, dtype=np.int64)
    out = []
    for low in range(0, len(queries), BLOCK):
        asked, some = queries[low : low + BLOCK], vectors[low : low + BLOCK]
        near = graph.nearest_each(some, shard.breadth)[:, : 2 * k + 2]
        row, column = np.nonzero(near >= 0)
        point = near[row, column]
        score = (graph.vectors.take(point, axis=0).astype(np.float64) * some.take(row, axis=0)).sum(axis=1)
        count = np.diff(ends, prepend=0)[point]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(ends[point] - count, count)
        row, score, found = np.repeat(row, count), np.repeat(score, count), ids[place]
        other = found != asked[row]
        row, score, found = row[other], score[other], found[other]
        order = np.lexsort((found, -score, row))
        row, score, found = row[order], score[order], found[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < k
        out.append(pd.DataFrame({"query_id": asked[row[first]], "vec_id": found[first], "score": score[first]}))
    return pd.concat(out, ignore_index=True)


def searched_rows(k: int):
    """Best answers of some blocks of queries in one shard."""

    def rows(blocks: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        if not (len(blocks) and len(shards)):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        queries = np.concatenate(list(blocks["query_ids"])).astype(np.int64)
        vectors = np.concatenate([np.stack(x) for x in blocks["query_vectors"]]).astype(np.float64)
        return pd.concat([answers_in(shard, queries, vectors, k) for shard in shards.itertuples()], ignore_index=True)

    return rows


def search(index: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, together: int = BLOCKS) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of each query (id, vector)."""
    index = cut_lineage(index)
    asked = cut_lineage(queries.withColumn("dim", F.size("vector")).withColumn("row", F.monotonically_increasing_id()))
    shards = 1 + index.agg(F.coalesce(F.max("shard"), F.lit(-1))).first()[0]
    n, widest = asked.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(1))).first()
    blocks = max(1, -(-n // block))
    together = max(1, min(together, NUMBERS // (block * widest)))
    salts = max(-(-blocks // together), min(blocks, -(-MEETINGS // max(1, shards))))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))) if shards else F.explode(F.array().cast("array<int>"))
    grouped = (
        asked.groupBy("dim", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
        .agg(F.collect_list(F.struct("id", "vector")).alias("q"))
        .select("dim", F.pmod("block", F.lit(salts)).cast("int").alias("salt"), F.col("q.id").alias("query_ids"), F.col("q.vector").alias("query_vectors"))
        .withColumn("shard", every_shard)
    )
    # a shard is copied for some blocks of queries; a task holds one copy and those blocks
    copies = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keys = ("dim", "shard", "salt")
    parts = min(8 * max(1, shards) * salts, PARTITIONS)
    found = (
        grouped.repartition(parts, *keys).groupBy(*keys).cogroup(copies.repartition(parts, *keys).groupBy(*keys))
        .applyInPandas(searched_rows(k), "query_id long, vec_id long, score double")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_ann(spark: SparkSession, folder: str, k: int = 20) -> DataFrame:
    table = read(spark, folder, "embeddings")
    queries = vectors_of(table, "vec_id", "embedding").filter(F.col("id") % 20 == 0)
    return search(build_index(table, k), queries, k)
