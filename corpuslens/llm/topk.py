"""Exact top-k inner products by a three-phase uniform threshold.

The candidates are dealt into blocks, the "nodes" of the threshold algorithm.

1. Every node sends its best few entries for each query: the local score lists.
2. The k-th best score gathered so far cannot exceed the true k-th best, so it
   is a safe cutoff.  It goes to the nodes whose list ended at or above it.
3. Those nodes send what else reaches the cutoff, at most k entries each; all
   entries together then hold the exact result.

Queries and candidates meet block by block in a co-grouped equi-join on the pair
of block numbers; a task holds one block of each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.scratch import stored

KEYS = ["query_block", "block"]
LIST_SCHEMA = "query_block int, block int, query_id long, vec_id long, score long, position int"


def quantized(vectors: DataFrame, *, scale: int = 64) -> DataFrame:
    """``vec_id, vector`` with components floor(scale * x); rows with null or non-finite components are left out, larger ones raise."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    usable = F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))

    def whole(x: Column) -> Column:
        outside = (F.abs(x * scale) >= 2.0**63) & (F.abs(x) != F.lit(float("inf"))) & ~F.isnan(x)
        return F.when(outside, F.raise_error(F.lit("a component is outside the 64-bit integers")).cast("long")).otherwise(F.floor(x * scale).cast("long"))

    return v.filter(F.coalesce(usable, F.lit(False))).select("vec_id", F.transform("v", whole).alias("vector"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows as int64; shorter vectors are filled with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes := lists.value_lengths().to_numpy(zero_copy_only=False))
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(ends - sizes, sizes)] = values
    return out


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in float64 where no sum can pass 2**53, in Python's integers where one could pass 2**63.

    A score that doesn't fit 64 bits raises ``OverflowError``.
    """
    most = math.prod(max(-int(x.min(initial=0)), int(x.max(initial=0))) for x in (queries, rows)) * queries.shape[1]
    if most < 2**53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if most < 2**63:
        return queries @ rows.T
    exact = queries.astype(object) @ rows.T.astype(object)
    return np.array(exact.tolist(), dtype=np.int64).reshape(exact.shape)


def _order(scores: np.ndarray, ids: np.ndarray, own: int, count: int) -> np.ndarray:
    """Places of the best ``count`` scores of other ids than ``own``, equal ones by ascending id; ``ids`` ascend."""
    a, z = np.searchsorted(ids, [own, own + 1])
    free = np.ones(len(ids), dtype=bool)
    free[a:z] = False
    places = np.flatnonzero(free)
    if len(places) > count:
        least = np.partition(scores[places], len(places) - count)[len(places) - count]
        places = places[scores[places] >= least]
    # ~x turns the order of 64-bit integers round without overflow.
    return places[np.argsort(~scores[places], kind="stable")][:count]


def _best(keys: tuple, queries: pa.Table, rows: pa.Table, count: int, later: bool) -> pa.Table:
    """Best entries of one block for each query, ties to the smaller id; ``later``: those behind the first list down to the cutoff."""
    out: list[list] = [[], [], [], []]
    if queries.num_rows and rows.num_rows:
        order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
        ids = rows["vec_id"].to_numpy()[order]
        width = max(pc.max(pc.list_value_length(c)).as_py() or 0 for c in (queries["asked"], rows["vector"]))
        data, asked, names = _matrix(rows["vector"], width)[order], _matrix(queries["asked"], width), queries["query_id"].to_numpy()
        cut = queries["cutoff"].to_pylist() if later else None
        last = queries["listed"].to_numpy() if later else None
        for a in range(0, len(names), 256):
            scores = _scores(asked[a : a + 256], data)
            for r in range(len(scores)):
                best = _order(scores[r], ids, int(names[a + r]), count)
                position = np.arange(1, len(best) + 1)
                if later:
                    keep = position > last[a + r]
                    if cut[a + r] is not None:
                        keep &= scores[r, best] >= cut[a + r]
                    best, position = best[keep], position[keep]
                out[0] += [int(names[a + r])] * len(best)
                out[1] += ids[best].tolist()
                out[2] += scores[r, best].tolist()
                out[3] += position.tolist()
    n = len(out[0])
    arrays = [pa.array([keys[0].as_py()] * n, pa.int32()), pa.array([keys[1].as_py()] * n, pa.int32())]
    arrays += [pa.array(x, pa.int64()) for x in out[:3]] + [pa.array(out[3], pa.int32())]
    return pa.table(arrays, names=[c.split()[0] for c in LIST_SCHEMA.split(", ")])


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 20, block_rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of ``vectors`` for each query.

    Both tables have vec_id and vector (array<bigint>).  A row never answers a
    query of its own vec_id; ties go to the smaller vec_id; with fewer rows than
    k, all are returned.  Repeated query rows count once, repeated vectors each
    by itself.  Shorter vectors are filled with zeros.  Empty tables give no
    rows; null ids take no part; other columns are ignored.
    """
    vectors = vectors.select("vec_id", "vector").filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    queries = queries.select("vec_id", "vector").filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).distinct()
    n, n_queries = vectors.count(), queries.count()
    blocks, query_blocks = math.ceil(n / block_rows) or 1, math.ceil(n_queries / block_rows) or 1
    first = min(k, max(4, math.ceil(2 * k / blocks)))

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int"))
    dealt = dealt.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("asked"), F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("query_block"))
    asked_all = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def gather(keys, left, right):
        return _best(keys, left, right, first, False)

    def rest(keys, left, right):
        return _best(keys, left, right, k, True)

    grouped = dealt.groupBy(*KEYS)
    lists = stored(asked_all.groupBy(*KEYS).cogroup(grouped).applyInArrow(gather, LIST_SCHEMA), "lists")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    cutoff = lists.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
    cutoff = cutoff.groupBy("query_id").agg(F.max(F.when(F.col("place") == k, F.col("score"))).alias("cutoff"))
    ends = lists.groupBy("query_id", *KEYS).agg(F.min("score").alias("lowest"), F.count("*").cast("int").alias("listed"))
    open_lists = ends.join(cutoff, "query_id").filter((F.col("listed") >= first) & (F.col("cutoff").isNull() | (F.col("lowest") >= F.col("cutoff"))))
    again = open_lists.select("query_id", *KEYS, "cutoff", "listed").join(asked.select("query_id", "asked"), "query_id")
    needed = dealt.join(open_lists.select(*KEYS).distinct(), KEYS, "left_semi")
    more = again.groupBy(*KEYS).cogroup(needed.groupBy(*KEYS)).applyInArrow(rest, LIST_SCHEMA)

    final = lists.unionByName(more).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return final.select("query_id", "rank", "vec_id", "score")
