"""Nearest neighbours by a permutation index.

A bounded sample of vectors are pivots. Every vector is represented by the order of its nearest
pivots and posted, with its place in that order, in the inverted file of each of them. A query
reads the files of its own nearest pivots, ranks what it finds by the footrule distance between
the two orders, and computes the exact measure for the best of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bodega.llm.common import column_of
from bodega.session import materialize

PIVOTS = 512         # vectors sampled as pivots, at most
PREFIX = 64          # nearest pivots that represent a vector
SHARE = 0.2          # of each block, the nearest by footrule that the exact measure is computed for
LEAST = 64           # and of a small block at least so many
BLOCK_ROWS = 8192    # vectors of one inverted file block
QUERY_ROWS = 4096    # queries that meet a block at a time


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part.

    Null keys, null or empty vectors, vectors of zeros or with null, NaN or infinite components take
    no part, and neither do vectors of another length than the most frequent one (the shortest of
    those, if several are).
    """
    v = F.transform(column_of(rows, vector), lambda x: x.cast("double"))
    good = rows.select(column_of(rows, key).cast("long").alias("vec_id"), v.alias("v")).where(
        "vec_id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
        "AND exists(v, x -> x != 0)")
    sizes = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(F.size("v") == (sizes["n"] if sizes else 0))


def to_matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_numpy()).astype(np.float64)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The order of each vector's nearest pivots, by angle; ties to the smaller pivot number."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix]


class Postings:
    """Inverted files of a block: for each pivot the vectors that have it among their nearest."""

    def __init__(self, order: np.ndarray, pivots: int):
        n, prefix = order.shape
        flat = order.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.rows = (by_pivot // prefix).astype(np.int64)
        self.weights = (prefix - by_pivot % prefix).astype(np.float64)
        self.ends = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))
        self.n, self.prefix = n, prefix

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance between a query's order and every order of the block.

        A pivot outside an order has the place behind its end. Two orders that share no pivot are
        farthest; each shared pivot, at places i and j, brings them nearer by twice the smaller of
        what i and j leave to the end.
        """
        near = np.zeros(self.n)
        for place, pivot in enumerate(order.tolist()):
            a, b = self.ends[pivot], self.ends[pivot + 1]
            near[self.rows[a:b]] += np.minimum(self.weights[a:b], self.prefix - place)
        return self.prefix * (self.prefix + 1) - 2 * near


def search_block(ids: np.ndarray, x: np.ndarray, order: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                 query_order: np.ndarray, pivots: int, k: int) -> list[tuple[int, int, float]]:
    """(query, vector, score) of the best ``k`` of a block for each query."""
    files = Postings(order, pivots)
    most = min(len(ids), max(int(np.ceil(SHARE * len(ids))), LEAST, k + 1))
    out = []
    for query, vector, own in zip(query_ids.tolist(), queries, query_order):
        distance = files.footrule(own)
        # ties at the border go along
        near = np.flatnonzero(distance <= np.partition(distance, most - 1)[most - 1])
        near = near[ids[near] != query]
        score = (x[near] * vector).sum(axis=1)  # row by row alike, so equal vectors score equally
        best = np.lexsort((ids[near], -score))[:k]
        out.extend(zip([query] * len(best), ids[near][best].tolist(), score[best].tolist()))
    return out


def search(rows: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query the ``k`` vectors of the largest inner product found.

    ``is_query``: a condition on vec_id. A query's own id is no candidate. Ties go to the smaller id. A
    query for which there are ``k`` candidates gets ``k``, else all. A vec_id that several rows have is
    several vectors; of equal rows (id and score) each is listed. Vectors that take no part, see
    ``valid_vectors``, are neither queries nor found. An empty table gives an empty result.

    The pivots are a sample of ``PIVOTS`` vectors at most, chosen by a hash of the id; every vector is
    indexed. Vectors lie in blocks of about ``BLOCK_ROWS``, each with its own inverted files; queries
    come to every block in groups of about ``QUERY_ROWS``, so a task holds one block and one group.
    In each block the ``SHARE`` nearest by footrule are compared exactly, so what is compared grows
    with the block and no fixed number cuts candidates off.
    """
    spark = rows.sparkSession
    vectors = materialize(valid_vectors(rows, key, vector), "vectors")
    total = vectors.count()
    sample = vectors.select("vec_id", "v").orderBy(F.xxhash64("vec_id", F.lit("pivot")), "vec_id").limit(PIVOTS).collect()
    pivots = np.array([r["v"] for r in sample], dtype=np.float64)
    if len(pivots):
        pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    prefix = min(PREFIX, len(pivots))
    shared = spark.sparkContext.broadcast(pivots)  # at most PIVOTS vectors

    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order = nearest_pivots(to_matrix(batch.column(1)), shared.value, prefix).astype(np.int32)
                ends = pa.array(np.arange(len(order) + 1, dtype=np.int32) * prefix)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(order.ravel()))],
                    names=["vec_id", "v", "near"])

    index = materialize(vectors.mapInArrow(represent, "vec_id bigint, v array<double>, near array<int>"), "index")
    n_queries = index.where(is_query).count()
    blocks, groups = max(1, -(-total // BLOCK_ROWS)), max(1, -(-n_queries // QUERY_ROWS))
    spread = F.xxhash64("vec_id", F.lit("block"))

    def to_all(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = index.withColumn("block", F.pmod(spread, F.lit(blocks)).cast("int")).withColumn("part", to_all(groups))
    right = index.where(is_query).withColumn("part", F.pmod(spread, F.lit(groups)).cast("int")).withColumn("block", to_all(blocks))

    def meet(block: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if block.num_rows and queries.num_rows:
            found = search_block(
                block["vec_id"].to_numpy(), to_matrix(block["v"]), to_matrix(block["near"]).astype(np.int64),
                queries["vec_id"].to_numpy(), to_matrix(queries["v"]), to_matrix(queries["near"]).astype(np.int64),
                len(shared.value), k)
        return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()), "vec_id": pa.array([f[1] for f in found], pa.int64()),
                         "score": pa.array([f[2] for f in found], pa.float64())})

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
        meet, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
