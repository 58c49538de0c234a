"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are cut into ``lists`` parts; a part's inner products with a query
are that part's list of local scores. Queries go in blocks of bounded size; candidates
stay where they are read.

1. Every task gathers the k best entries of each query and list among its rows,
   with the full scores of these few. The k-th best full score seen anywhere is a
   lower bound for the true k-th score.
2. Its share per list, bound / lists, is a safe cutoff: a row that reaches the bound
   has at least one list entry at the cutoff or above. The cutoffs (one number a query of
   the block) are broadcast, and every task collects all entries at or above them.
3. The remaining lists' scores of the rows that occur there are added exactly; a task
   passes on its k best rows at or above the bound, and these lists are merged by rank.

Only k rows per query, list and task are shuffled in either pass.

Defined results: vectors that are null, or hold a null or non-finite component, and
rows with a null id take no part; a missing dimension counts as zero; rows that share
the query's id are its own and are left out; repeated candidate rows count each; ties go to the smaller id; scores are
64-bit integers (sums beyond 64 bits wrap around); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

LISTS = 2
#: Most queries of a block: bounds what is broadcast (times dimensions).
BLOCK = 2048
ROWS = 1024


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """Rows (id, v): floor(scale * component) of the vectors that take part."""
    rows = pick(vectors, id=id_col, x=vector_col)
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("x").isNotNull()).where(~bad)
    return rows.select("id", F.transform("x", lambda c: F.floor(c.cast("double") * F.lit(scale)).cast("long")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, cut or filled with zeros to ``width``."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row[at < width], at[at < width]] = flat[at < width]
    return out


def _products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point where that is exact."""
    high = lambda x: int(np.abs(x).max()) if x.size and x.min() > np.iinfo(np.int64).min else 1 << 62
    if high(rows) * high(queries) * max(1, rows.shape[1]) < 1 << 53:
        return (rows.astype(np.float64) @ queries.astype(np.float64).T).astype(np.int64)
    with np.errstate(over="ignore"):
        return rows @ queries.T


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best entries of each query: score down, then id up."""
    by = np.lexsort((ids, -score, query))
    q = query[by]
    start = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, dtype=np.int64)
    nth = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return by[nth < k]


def _top(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of at least the k largest entries of each column."""
    if len(matrix) <= k:
        row, column = np.indices(matrix.shape)
        return row.ravel(), column.ravel()
    row = np.argpartition(matrix, len(matrix) - k, axis=0)[len(matrix) - k :]
    return row.ravel(), np.tile(np.arange(matrix.shape[1]), k)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, lists: int = LISTS, block: int = BLOCK
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score). ``is_query`` is a condition on ``id``."""
    spark = vectors.sparkSession
    rows = written(whole_numbers(vectors, id_col, vector_col, scale))
    asked = rows.where(is_query)
    n, width = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks = max(1, -(-n // block))
    out = None
    for b in range(blocks):
        mine = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == b)
        found = written(_block(rows, mine, k, int(width or 0), lists))
        out = found if out is None else out.union(found)
    return out


def _block(rows: DataFrame, asked: DataFrame, k: int, width: int, lists: int) -> DataFrame:
    spark = rows.sparkSession
    asked = asked.toPandas()  # one block: about ``block`` queries
    query_ids = asked["id"].to_numpy()
    queries = np.zeros((len(asked), width), dtype=np.int64)
    for i, v in enumerate(asked["v"]):
        queries[i, : len(v)] = v
    cuts = [width * i // lists for i in range(lists + 1)]
    shared = spark.sparkContext.broadcast((query_ids, queries))

    def parts(batches: Iterator[pa.RecordBatch]):
        """Ids and the local scores of each list, for pieces of the task's rows."""
        query_ids, queries = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                piece = batch.slice(i, ROWS)
                ids = piece.column(0).to_numpy(zero_copy_only=False)
                matrix = _matrix(piece.column(1), width)
                scores = [_products(matrix[:, a:z], queries[:, a:z]) for a, z in zip(cuts[:-1], cuts[1:])]
                yield ids, scores, ids[:, None] == query_ids[None, :]

    names = ["q", "id", "score"]

    def entries(q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(ids), pa.array(score)], names=names)

    def merged(held, new, k: int):
        q, ids, score = (np.concatenate(x) for x in zip(held, new)) if held else new
        keep = _best(q, score, ids, k)
        return q[keep], ids[keep], score[keep]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [None] * lists  # per list: (query, position, local score, full score) of the k best
        for ids, scores, own in parts(batches):
            full = sum(scores)
            for j, local in enumerate(scores):
                row, q = _top(np.where(own, np.iinfo(np.int64).min, local), k)
                ok = ~own[row, q]
                row, q = row[ok], q[ok]
                new = (q, ids[row], local[row, q], full[row, q])
                if best[j] is not None:
                    new = tuple(np.concatenate(x) for x in zip(best[j], new))
                keep = _best(new[0], new[2], new[1], k)
                best[j] = tuple(x[keep] for x in new)
        for held in best:
            if held is not None:
                yield entries(held[0], held[1], held[3])

    kind = rows.schema["id"].dataType.simpleString()
    seen = rows.mapInArrow(gather, f"q int, id {kind}, score long")
    # the k-th best full score among those gathered; a row gathered by two lists counts once
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    bound = seen.distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") == k).select("q", "score")
    bounds = np.full(len(queries), np.iinfo(np.int64).min, dtype=np.int64)
    found = bound.toPandas()
    bounds[found["q"].to_numpy()] = found["score"].to_numpy()
    cutoffs = spark.sparkContext.broadcast(bounds)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, held = cutoffs.value, None
        # lists * entry >= bound, in whole numbers; nothing is cut where no bound is known
        least = np.where(bounds == np.iinfo(np.int64).min, bounds, -((-bounds) // lists))
        for ids, scores, own in parts(batches):
            enough = np.zeros(own.shape, dtype=bool)
            for local in scores:
                enough |= local >= least
            row, q = np.nonzero(enough & ~own)
            score = sum(local[row, q] for local in scores)
            ok = score >= bounds[q]
            new = (q[ok], ids[row[ok]], score[ok])
            held = merged(held, new, k)
        if held is not None:
            yield entries(*held)

    kept = rows.mapInArrow(collect, f"q int, id {kind}, score long")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # the block's ids again, by query number: a table of the block's size
    numbers = spark.createDataFrame([(i, x.item() if hasattr(x, "item") else x) for i, x in enumerate(query_ids)], f"q int, query_id {kind}")
    return ranked.join(numbers, "q").select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
