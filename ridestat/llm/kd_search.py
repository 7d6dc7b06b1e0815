"""Exact top-k search by inner product with KD-trees per shard.

Vectors are quantised to integers and dealt to cells by the median splits of a KD-tree over a
bounded sample; a cell of more than ``SHARD_ROWS`` vectors (copies of one vector may fill one) is
salted into several shards. A task builds its shard's KD-tree: median splits on the widest
dimension, a tight bounding box at each node. A query walks the tree best box first: a box's bound
is the highest inner product that any point of it could have, and the walk ends when the best bound
left is below the k-th score found. Each query first searches its own cell; the k-th score found
there goes with it to those other cells whose box bound reaches it, so cells that cannot hold a
better vector are not visited, and the others start with a high bar. All vectors are indexed and
the result is exact. The queries that visit a cell go in blocks of about ``QUERY_BLOCK``, and a shard is
copied once for each block of its own cell, so what is shuffled grows with the visits.

Defined cases: vectors that are null or hold a null, NaN or infinite component, and rows without an
id, take no part; shorter vectors are filled with zeros; rows that share an id each take part as
candidates and each as a query of their own, leaving out that one row alone; an empty vector scores 0;
ties go to the smaller id; a query with fewer than k others gets them all; an empty table gives an
empty result. Only the id and vector columns are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, stored

K, SCALE = 5, 256.0
SHARD_ROWS, LEAF_ROWS, QUERY_BLOCK = 8192, 32, 2048
#: Vectors that the cells' splits are fitted on, and the most levels of splits.
SAMPLE, MAX_LEVELS = 16_384, 16
#: Bytes of all cells' boxes, which go to the driver and to every task.
BOX_BYTES = 1 << 25
#: Scores below this are exact in double precision.
_EXACT = 2.0**53


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(row, id, v) with a number for each row and integer vectors of one length, and that length."""
    v = F.col(vector_col)
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v"))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", "v"))  # the numbers hold once they are written
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))
    return rows.select("row", "id", F.concat("v", zeros).alias("v")), width


def matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.array(column.tolist(), np.int64).reshape(len(column), -1)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def median_splits(points: np.ndarray, levels: int) -> list[tuple[int, int]]:
    """(dimension, highest value of the left side) of each inner node of a full tree, level by level."""
    groups, out = [points], []
    for _ in range(levels):
        halves = []
        for g in groups:
            if len(g) and g.shape[1]:
                d = int(np.argmax(np.ptp(g, axis=0)))
                at = int(np.sort(g[:, d])[(len(g) - 1) // 2])
            else:
                d, at = 0, 0
            out.append((d, at))
            left = g[:, d] <= at if g.shape[1] else np.ones(len(g), bool)
            halves += [g[left], g[~left]]
        groups = halves
    return out


def cells_of(points: np.ndarray, splits: list[tuple[int, int]]) -> np.ndarray:
    """The leaf of the full tree that each point falls into."""
    node = np.zeros(len(points), np.int64)
    if not splits or not points.shape[1]:
        return node
    d, at = np.array([s[0] for s in splits]), np.array([s[1] for s in splits])
    for _ in range((len(splits) + 1).bit_length() - 1):
        node = 2 * node + 1 + (points[np.arange(len(points)), d[node]] > at[node])
    return node - len(splits)


def upper_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query and box, the highest inner product a point in the box could have."""
    q = queries.astype(float)
    return np.maximum(q, 0) @ high.T.astype(float) + np.minimum(q, 0) @ low.T.astype(float)


def products(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products (modulo 2**64 beyond that range)."""
    return points @ query


class Tree:
    """A KD-tree over a shard's vectors; node i's children are left[i] and right[i] (0: a leaf)."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        self.order = np.arange(len(ids))
        self.span, self.left, self.right, low, high = [], [], [], [], []
        todo = [(0, len(ids), -1, False)]
        while todo:
            lo, hi, parent, is_right = todo.pop()
            node = len(self.span)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = node
            part = points[self.order[lo:hi]]
            self.span.append((lo, hi))
            self.left.append(0)
            self.right.append(0)
            low.append(part.min(0))
            high.append(part.max(0))
            wide = high[-1] - low[-1]
            if hi - lo > LEAF_ROWS and len(wide) and wide.max() > 0:
                mid = (hi - lo) // 2
                self.order[lo:hi] = self.order[lo:hi][np.argpartition(part[:, int(np.argmax(wide))], mid)]
                todo += [(lo + mid, hi, node, True), (lo, lo + mid, node, False)]
        self.low, self.high = np.array(low), np.array(high)
        self.rows, self.ids, self.points = rows[self.order], ids[self.order], points[self.order]

    def search(self, query_rows: np.ndarray, queries: np.ndarray, bars: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query's row, id, score) of each query's best k here that reach its bar."""
        bounds = upper_bounds(queries, self.low, self.high)
        # Beyond exact doubles a bound gets room for its rounding.
        slack = np.abs(bounds) * 2.0**-45 if len(bounds) and np.abs(bounds).max() >= _EXACT else np.zeros((1, 1))
        bounds = (bounds + slack).tolist()
        out = []
        for i, (query_row, bar) in enumerate(zip(query_rows.tolist(), bars.tolist(), strict=True)):
            bound, best = bounds[i], []  # best: a heap of (score, -id)
            heap = [(-bound[0], 0)]
            while heap:
                top, node = heapq.heappop(heap)
                if -top < bar:
                    break
                if self.left[node]:
                    for child in (self.left[node], self.right[node]):
                        if bound[child] >= bar:
                            heapq.heappush(heap, (-bound[child], child))
                    continue
                lo, hi = self.span[node]
                score = products(self.points[lo:hi], queries[i])
                for j in np.flatnonzero(score >= bar).tolist() if np.isfinite(bar) else range(hi - lo):
                    if self.rows[lo + j] == query_row:
                        continue
                    item = (int(score[j]), -int(self.ids[lo + j]))
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k:
                    bar = max(bar, best[0][0])
            out += [(query_row, -n, s) for s, n in best]
        return out


def _searched(shards: DataFrame, visits: DataFrame, salted: DataFrame, k: int) -> DataFrame:
    """query, vec_id, score: visits (cell, query, q, bar) searched in the trees of their cell's shards."""

    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(points) and len(queries):
            tree = Tree(points["row"].to_numpy(np.int64), points["id"].to_numpy(np.int64), matrix(points["v"]))
            bars = queries["bar"].astype(float).fillna(-np.inf).to_numpy()
            found = tree.search(queries["query"].to_numpy(np.int64), matrix(queries["q"]), bars, k)
        return pd.DataFrame(found, columns=["query", "vec_id", "score"], dtype=np.int64)

    keys = ["cell", "salt", "block"]
    blocks = F.broadcast(visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("blocks")))  # 2**MAX_LEVELS rows at most
    every = shards.join(blocks, "cell").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    asked = visits.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks"))).join(salted, "cell")
    asked = asked.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "block", "query", "q", "bar")
    return every.select(*keys, "row", "id", "v").groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query long, vec_id long, score long")


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest inner product for each query row."""
    spark = ready(vectors.sparkSession)
    rows, width = quantised(vectors, id_col, vector_col)
    total = rows.count()
    room = max(0, int(np.log2(BOX_BYTES / (16 * max(width, 1)))))  # a box is two vectors of 8-byte numbers
    levels = min(MAX_LEVELS, room, max(0, int(np.ceil(np.log2(max(total, 1) / SHARD_ROWS)))))
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").toArrow().column("v")  # SAMPLE rows at most
    splits = median_splits(matrix(sample.combine_chunks()), levels) if total else []

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cells = cells_of(matrix(b.column(2)), splits)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells)], names=["row", "id", "v", "cell"])

    celled = stored(rows.mapInArrow(placed, "row long, id long, v array<long>, cell long"))

    def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, count = {}, {}, {}
        for b in batches:
            points, cell = matrix(b.column(2)), b.column(3).to_numpy()
            for c in np.unique(cell).tolist():
                p = points[cell == c]
                low[c] = np.minimum(low[c], p.min(0)) if c in low else p.min(0)
                high[c] = np.maximum(high[c], p.max(0)) if c in high else p.max(0)
                count[c] = count.get(c, 0) + len(p)
        if low:
            lists = [pa.array([x[c].tolist() for c in low], pa.list_(pa.int64())) for x in (low, high)]
            yield pa.RecordBatch.from_arrays([pa.array(list(low), pa.int64()), *lists, pa.array([count[c] for c in low], pa.int64())], names=["cell", "low", "high", "n"])

    def merged(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"cell": parts["cell"][:1].tolist(), "low": [matrix(parts["low"]).min(0)], "high": [matrix(parts["high"]).max(0)], "n": [int(parts["n"].sum())]})

    shape = "cell long, low array<long>, high array<long>, n long"
    boxes = celled.mapInArrow(boxed, shape).groupBy("cell").applyInPandas(merged, shape).orderBy("cell").toArrow().combine_chunks()  # BOX_BYTES at most
    if not boxes.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sizes = zip(boxes["cell"].to_pylist(), boxes["n"].to_pylist(), strict=True)
    salted = F.broadcast(spark.createDataFrame([(c, -(-n // SHARD_ROWS)) for c, n in sizes], "cell long, salts long"))  # 2**MAX_LEVELS rows at most
    shards = celled.join(salted, "cell").select("cell", F.pmod(F.xxhash64("row"), F.col("salts")).alias("salt"), "row", "id", "v")
    queries = celled.withColumnRenamed("id", id_col).where(is_query).select(F.col("row").alias("query"), F.col(id_col).alias("query_id"), F.col("v").alias("q"), "cell")
    queries = stored(queries)
    none = F.lit(None).cast("long")
    home = stored(_searched(shards, queries.select("cell", "query", "q", none.alias("bar")), salted, k))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    bars = home.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).groupBy("query").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("bar"))
    asked = queries.join(bars, "query", "left")
    edges = [matrix(boxes[side].combine_chunks()) for side in ("low", "high")]
    given = spark.sparkContext.broadcast((boxes["cell"].to_numpy(), *edges))

    def away(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, low, high = given.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                bounds = upper_bounds(matrix(part.column(1)), low, high)
                bars = part.column(3).to_numpy(zero_copy_only=False).astype(float)
                go = ~(bounds + np.abs(bounds) * 2.0**-45 < bars[:, None]) & (part.column(2).to_numpy()[:, None] != cells)
                who, where = np.nonzero(go)
                if len(who):
                    yield pa.RecordBatch.from_arrays([pa.array(cells[where]), *part.take(pa.array(who)).select([0, 1, 3]).columns], names=["cell", "query", "q", "bar"])

    sent = stored(asked.select("query", "q", "cell", "bar").mapInArrow(away, "cell long, query long, q array<long>, bar long"))
    found = home.union(_searched(shards, sent, salted, k))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(queries.select("query", "query_id"), "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
