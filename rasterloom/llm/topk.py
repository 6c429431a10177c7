"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Every component x becomes the integer floor(256 * x), without bounds, and scores are exact:
float64 where no sum can pass 2**53, int64 where none can pass 2**63, else whole numbers
of any size.  Rows and queries are dealt into blocks of bounded size and every pair of a row
block with a query block is one task.  It sorts the block's rows by each dimension; for a query
each list is read from its favourable end, rows met are scored in full, and reading stops when
the bound - the best score that values not yet read could sum up to - is below the k-th best
score.  (At equality reading goes on, as an unread row could tie with a smaller id.)  The best
k of each block meet in a window over k rows a block for each query.

Defined results.  Vectors that are null or hold null or non-finite components take no part, nor do
rows with a null id.  Shorter vectors count as padded with zeros, empty ones as zeros.  Ranks follow
the exact scores; a score that no long holds is reported as the nearest long.  Repeated rows are
candidates each; rows with the query's id are its own.  A repeated query id is asked once, with its
first vector in order.  Texts play no part, and other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

K = 5
ROWS = 8192
QUERIES = 4096
STEP = 32
EXACT_FLOAT, EXACT_LONG = 1 << 53, 1 << 63


def usable(embedding: Column) -> Column:
    """Whether all components are there and finite."""
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _whole(x: float) -> int:
    """floor(256 * x) of any finite x: a product that overflows belongs to a whole x."""
    return 256 * int(x) if abs(x) > 2.0**60 else math.floor(256 * x)


def quantised(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A row of integers for each vector: float64 if all are exact in it, else Python's."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if np.abs(flat).max(initial=0) < EXACT_FLOAT >> 8:
        flat = np.floor(256 * flat)
    else:
        flat = np.array([_whole(x) for x in flat.tolist()], dtype=object)
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), flat.dtype)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def exact(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the narrowest type in which no inner product, nor any part of one, can pass its exact range."""
    most = rows.shape[1] * int(np.abs(rows).max(initial=0)) * int(np.abs(queries).max(initial=0))
    kind = np.float64 if most < EXACT_FLOAT else np.int64 if most < EXACT_LONG and max(rows.dtype.kind, queries.dtype.kind) == "f" else object
    if kind is object:
        return tuple(np.array([[int(x) for x in r] for r in m.tolist()], dtype=object).reshape(m.shape) for m in (rows, queries))
    return rows.astype(kind), queries.astype(kind)


def _order(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """By score, descending, then id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), dtype=np.int64)
    return np.lexsort((ids, -scores))


def ordered_bytes(score: int) -> bytes:
    """Bytes that sort as the integers do."""
    size = (abs(score).bit_length() + 8) // 8
    sign = (1 << 31) + (size if score >= 0 else -size)
    return sign.to_bytes(4, "big") + score.to_bytes(size, "big", signed=True)


def threshold_search(rows: np.ndarray, ids: np.ndarray, lists: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows of a block; lists[:, d] are row numbers by value of dimension d, ascending."""
    n = len(rows)
    dims = np.flatnonzero(query)
    seen = ids == own
    best_ids, best = np.zeros(0, np.int64), np.zeros(0, rows.dtype)
    if not len(dims):
        met = np.flatnonzero(~seen)
        order = np.argsort(ids[met], kind="stable")[:k]
        return ids[met][order], np.zeros(len(order), rows.dtype)
    up = query[dims] > 0
    weights = query[dims].astype(rows.dtype)
    at, step = 0, STEP
    while at < n:
        end = min(n, at + step)
        met = np.concatenate([lists[n - end : n - at, dims[up]].ravel(), lists[at:end, dims[~up]].ravel()])
        mark = np.zeros(n, bool)
        mark[met] = True
        met = np.flatnonzero(mark & ~seen)
        seen[met] = True
        best = np.concatenate([best, rows[met] @ query.astype(rows.dtype)])
        best_ids = np.concatenate([best_ids, ids[met]])
        order = _order(best_ids, best)[:k]
        best, best_ids = best[order], best_ids[order]
        at, step = end, step * 2
        if len(best) == k:
            edge = np.where(up, lists[n - at, dims], lists[at - 1, dims])
            if best[-1] > weights @ rows[edge, dims]:
                break
    return best_ids, best


def _search(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        names = ("query_id", "vec_id", "score", "place")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        out: tuple[list, ...] = ([], [], [], [])
        if rows.num_rows and queries.num_rows:
            width = max(1, *(int(pc.max(pc.list_value_length(t["v"])).as_py()) for t in (rows, queries)))
            values, asked = exact(quantised(rows["v"], width), quantised(queries["v"], width))
            ids = rows["vec_id"].to_numpy()
            lists = np.argsort(values, axis=0, kind="stable").astype(np.int32)
            for own, query in zip(queries["vec_id"].to_pylist(), asked, strict=True):
                found, score = threshold_search(values, ids, lists, query, own, k)
                score = [int(s) for s in score]
                out[0].extend([own] * len(found))
                out[1].extend(found.tolist())
                out[2].extend(max(-EXACT_LONG, min(EXACT_LONG - 1, s)) for s in score)
                out[3].extend(map(ordered_bytes, score))
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=list(names))

    return run


def search(vectors: DataFrame, is_query: Column, k: int = K, rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for every row for which is_query holds."""
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"), is_query.alias("asked"))
    own = own.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    if own.schema["v"].dataType != ArrayType(FloatType(), own.schema["v"].dataType.containsNull):
        own = own.withColumn("v", F.col("v").cast("array<double>"))
    asked = own.where("asked").groupBy("vec_id").agg(F.min("v").alias("v"))
    n = own.agg(F.count("*").alias("n"), F.count_if("asked").alias("m")).first()
    row_blocks, query_blocks = max(1, -(-n["n"] // rows)), max(1, -(-n["m"] // queries))
    block = lambda count, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = own.select("vec_id", "v", block(row_blocks, 1).alias("r"), every(query_blocks).alias("c"))
    right = asked.select("vec_id", "v", block(query_blocks, 2).alias("c"), every(row_blocks).alias("r"))
    found = left.groupBy("r", "c").cogroup(right.groupBy("r", "c")).applyInArrow(_search(k), "query_id long, vec_id long, score long, place binary")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("place"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
