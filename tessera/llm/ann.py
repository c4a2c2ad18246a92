"""Approximate nearest neighbours by an inverted multi-index.

Each vector's two halves are quantised separately, so that K + K centroids make K * K cells. For a query, the centroids of
either half are ranked by inner product and the cells traversed by the summed distance (least, that is the largest summed
inner product, first) with a heap, until they hold a set share of all vectors. The rows of those cells are ranked by the
exact inner product of the original vectors in double precision.

Centroids are fitted in numpy on at most ``FIT_ROWS`` vectors; their number grows with the fourth root of the rows, so that
cells grow with the square root. The share is calibrated there too: brute force over that sample tells how far a traversal
must go for ``RECALL``. Every row is indexed. Cells are packed into blocks of about ``BLOCK`` rows; a cell with more, whatever
it holds, is dealt over several blocks, so none grows with the data. A row is copied once for ``QUERIES_A_TASK`` queries.

Rows are told apart by a number of their own, so rows that share a vec_id are candidates and queries of their own. Vectors
are searched among those of their length, since others have no inner product with them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpoint, table

LEAST_CENTROIDS, MOST_CENTROIDS, FIT_ROWS, FIT_QUERIES, RECALL = 32, 256, 10_000, 200, 0.97
BLOCK, QUERIES_A_TASK = 4096, 16_384
#: Vectors of more lengths than this are refused with an error, never cut.
MOST_LENGTHS = 100
RESULT = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(rid, vec_id, v): rows whose vector is neither null, empty, zero nor holds null or non-finite components.

    ``rid`` numbers the rows. Rows without an id take no part.
    """
    v = F.col("v")
    rows = vectors.select(vectors[f"`{id_col}`"].cast("long").alias("vec_id"), vectors[f"`{vector_col}`"].cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.where(F.coalesce(fine, F.lit(False))).select(F.monotonically_increasing_id().alias("rid"), "vec_id", "v")


def centroids_for(rows: int) -> int:
    """Twice the fourth root of the rows, within bounds that hold the fit and the table of cells."""
    return int(min(MOST_CENTROIDS, max(LEAST_CENTROIDS, round(2 * rows**0.25))))


def k_means(x: np.ndarray, k: int, g: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """At most ``k`` centroids of distinct rows; an empty one keeps its place."""
    distinct = np.unique(x, axis=0)
    c = distinct[g.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        s = np.zeros_like(c)
        np.add.at(s, at, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)


def cells_of(x: np.ndarray, halves: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    h = halves[0].shape[1]
    return nearest(x[:, :h], halves[0]) * len(halves[1]) + nearest(x[:, h:], halves[1])


def traverse(q: np.ndarray, halves: tuple[np.ndarray, np.ndarray], sizes: np.ndarray, rows: float) -> list[int]:
    """Non-empty cells by growing summed distance, until they hold ``rows`` rows. ``sizes``: rows of each cell."""
    h, k2 = halves[0].shape[1], len(halves[1])
    d1, d2 = -(halves[0] @ q[:h]), -(halves[1] @ q[h:])
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    d1, d2, o1, o2 = d1[o1].tolist(), d2[o2].tolist(), o1.tolist(), o2.tolist()
    heap, cells, held = [(d1[0] + d2[0], 0, 0)], [], 0
    while heap and held < rows:
        _, i, j = heapq.heappop(heap)
        cell = o1[i] * k2 + o2[j]
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        if j + 1 < len(d2):
            heapq.heappush(heap, (d1[i] + d2[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(d1):
            heapq.heappush(heap, (d1[i + 1] + d2[0], i + 1, 0))
    return cells


def calibrate(x: np.ndarray, halves: tuple[np.ndarray, np.ndarray], k: int, recall: float, queries: int) -> float:
    """The share of rows whose cells must be visited for ``recall`` among the ``k`` nearest of sample rows; at least 1 %."""
    n = len(x)
    if n <= 4 * k:
        return 1.0
    cell = cells_of(x, halves)
    sizes = np.bincount(cell, minlength=len(halves[0]) * len(halves[1]))
    need = []
    for i in range(0, n, max(1, n // queries)):
        s = x @ x[i]
        s[i] = -np.inf
        top = np.argpartition(-s, k)[:k]
        order = traverse(x[i], halves, sizes, n)
        before = dict(zip(order, np.cumsum(sizes[order]) / n, strict=True))
        need += [before[c] for c in cell[top]]
    return float(min(1.0, max(0.01, np.quantile(need, recall))))


def exact(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal rows give equal results, wherever they stand."""
    return (rows * q).sum(axis=1)


def search(vectors: DataFrame, query_rows, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int | None = None, fit_rows: int = FIT_ROWS, recall: float = RECALL, seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query among all other rows.

    ``query_rows`` is a condition on ``vec_id``. Ties go to the smaller vec_id; a query with fewer candidates gets them all.
    Rows that share a vec_id are rows of their own: each is a candidate of the others, and as queries each has its ranks.
    See :func:`usable` for rows left out; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = checkpoint(usable(vectors, id_col, vector_col))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(MOST_LENGTHS + 1).collect()
    if len(lengths) > MOST_LENGTHS:
        raise ValueError(f"vectors of more than {MOST_LENGTHS} lengths")
    out = spark.createDataFrame([], RESULT)
    for r in lengths:
        out = out.unionByName(search_length(rows.where(F.size("v") == r["d"]), r["d"], r["count"], query_rows, k, centroids, fit_rows, recall, seed))
    return out


def search_length(rows: DataFrame, dim: int, n: int, query_rows, k: int, centroids: int | None, fit_rows: int, recall: float, seed: int) -> DataFrame:
    """:func:`search` among the ``n`` rows of one length."""
    spark = rows.sparkSession
    centroids = centroids or centroids_for(n)
    pool = rows if n <= 2 * fit_rows else rows.where(F.pmod(F.xxhash64(F.lit(4), "vec_id"), F.lit(1_000_000)) < 2.0 * fit_rows / n * 1_000_000)
    sample = np.array([r["v"] for r in pool.orderBy(F.xxhash64("vec_id"), "vec_id", "rid").limit(fit_rows).select("v").collect()], np.float64)  # at most fit_rows
    g = np.random.Generator(np.random.PCG64(seed))
    half = max(1, dim // 2)
    halves = (k_means(sample[:, :half], centroids, g), k_means(sample[:, half:], centroids, g))
    share = calibrate(sample, halves, k, recall, FIT_QUERIES)
    many = len(halves[0]) * len(halves[1])
    index = spark.sparkContext.broadcast(halves)  # 2 * centroids half vectors

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array(b["v"].tolist(), np.float64).reshape(-1, dim)
            yield pd.DataFrame({"rid": b["rid"], "vec_id": b["vec_id"], "cell": cells_of(x, index.value), "vec": [r.tobytes() for r in x]})

    indexed = checkpoint(rows.mapInPandas(assign, "rid long, vec_id long, cell int, vec binary"))
    sizes = np.zeros(many, np.int64)
    for r in indexed.groupBy("cell").count().collect():  # at most centroids ** 2 rows
        sizes[r["cell"]] = r["count"]

    # Cells in order share blocks; a cell of over BLOCK rows has several to itself.
    first, parts, block, room = np.zeros(many, np.int64), np.ones(many, np.int64), 0, BLOCK
    for c in np.flatnonzero(sizes):
        if sizes[c] > room and room < BLOCK:
            block, room = block + 1, BLOCK
        first[c] = block
        if sizes[c] > BLOCK:
            parts[c] = -(-sizes[c] // BLOCK)
            block, room = block + int(parts[c]), BLOCK
        else:
            room -= int(sizes[c])
    plan = spark.sparkContext.broadcast((sizes, first, parts))
    queries = indexed.where(query_rows)
    asking = queries.count()
    chunks = max(1, -(-asking // QUERIES_A_TASK))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes, first, parts = plan.value
        for b in batches:
            out = []
            for own, q, raw in zip(b["rid"], b["vec_id"], b["vec"], strict=True):
                by_block: dict[int, list[int]] = {}
                for c in traverse(np.frombuffer(raw), index.value, sizes, share * n + k + 1):
                    for p in range(parts[c]):
                        by_block.setdefault(int(first[c] + p), []).append(c)
                out += [(k, own, q, raw, np.array(sorted(cs), "<i4").tobytes()) for k, cs in by_block.items()]
            yield pd.DataFrame(out, columns=["block", "rid", "query_id", "vec", "cells"])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, first, parts = plan.value
        for b in batches:
            c = b["cell"].values
            deal = (b["rid"].values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            yield b.assign(block=first[c] + deal % parts[c])[["block", "rid", "vec_id", "cell", "vec"]]

    # Traversal takes longer than its rows are long, so their number, not their bytes, decides on the tasks.
    tasks = max(1, min(-(-asking // 64), max(spark.sparkContext.defaultParallelism, -(-asking // 1024))))
    asked = queries.repartition(tasks, "rid").mapInPandas(route, "block long, rid long, query_id long, vec binary, cells binary")
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("rid"), F.lit(chunks)))
    held = indexed.mapInPandas(place, "block long, rid long, vec_id long, cell int, vec binary")
    held = held.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))

    def rank(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(asked) and len(held):
            held = held.sort_values(["cell", "vec_id", "rid"], kind="stable")
            ids, own, x = held["vec_id"].values, held["rid"].values, np.frombuffer(b"".join(held["vec"])).reshape(len(held), -1)
            cell = held["cell"].values
            starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            spans = {int(cell[a]): (a, b) for a, b in zip(starts, np.append(starts[1:], len(cell)), strict=True)}
            for at in range(0, len(asked), 256):
                part = asked.iloc[at : at + 256]
                q = np.frombuffer(b"".join(part["vec"])).reshape(len(part), -1)
                near = np.full((len(part), len(held)), -np.inf)
                visits: dict[int, list[int]] = {}
                for i, cs in enumerate(part["cells"]):
                    for c in np.frombuffer(cs, "<i4").tolist():
                        visits.setdefault(c, []).append(i)
                for c, who in visits.items():
                    if c in spans:
                        a, b = spans[c]
                        near[who, a:b] = q[who] @ x[a:b].T
                near[part["rid"].values[:, None] == own[None, :]] = -np.inf
                for i, (query, asker) in enumerate(zip(part["query_id"].values, part["rid"].values, strict=True)):
                    s = near[i]
                    least = np.partition(s, -k)[-k] if len(s) > k else -np.inf
                    slack = 1e-9 * max(1.0, abs(least)) if np.isfinite(least) else 0.0
                    pick = np.flatnonzero((s >= least - slack) & (s > -np.inf))
                    score = exact(x[pick], q[i])
                    best = np.lexsort((own[pick], ids[pick], -score))[:k]
                    found += [(asker, query, own[pick[j]], ids[pick[j]], score[j]) for j in best]
        return pd.DataFrame(found, columns=["asker", "query_id", "rid", "vec_id", "score"])

    top = asked.groupBy("block", "chunk").cogroup(held.groupBy("block", "chunk")).applyInPandas(rank, "asker long, query_id long, rid long, vec_id long, score double")
    order = F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id", "rid"))  # at most k rows a block
    return top.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
