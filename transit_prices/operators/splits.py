"""Leak-free splits.

Positional splits count rows per date first; whole dates fall on one side, and
only the rows of the date at the border need positions. Those come without a
single-partition window: the rows are range-partitioned on the tie-break key,
sorted within partitions and written down, and each partition's offset comes
from a tiny per-partition count table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage


def global_positions(df: DataFrame, order_cols, out: str = "_pos", num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the total order ``order_cols``
    (which must be unique for the result to be deterministic).

    Each partition's rows and their numbering are written down once, before the
    partitions are counted: two runs of a range exchange may sample other bounds, and
    offsets of one run do not fit the rows of another."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    tagged = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_m0"))
    # one row per partition: a global window here is over n rows only
    offs = counts.withColumn(
        "_off", F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    offs = offs.select("_pid", "_m0", F.coalesce("_off", F.lit(0)).alias("_off"))
    pos = F.col("_off") + F.col("_mid") - F.col("_m0")
    return tagged.join(F.broadcast(offs), "_pid").withColumn(out, pos).drop("_pid", "_mid", "_m0", "_off")


def _border(counts: DataFrame, share: float):
    """Total of ``_n``, int(total * share), and the row (_v, _n, _upto) with the first value
    whose running total is beyond it (None if there is none).

    Values are range-partitioned and written down; the partitions' totals, a few numbers, tell in
    which of them the border lies, and only that one is summed up in order."""
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(counts.repartitionByRange(n, "_v").withColumn("_part", F.spark_partition_id()))
    parts = sorted(tuple(r) for r in ranged.groupBy("_part").agg(F.sum("_n")).collect())
    total = sum(k for _, k in parts)
    cut, before = int(total * share), 0
    for part, k in parts:
        if before + k > cut:
            upto = F.sum("_n").over(Window.partitionBy("_part").orderBy("_v")) + before
            inside = ranged.where(F.col("_part") == part).withColumn("_upto", upto)
            return total, cut, inside.where(F.col("_upto") > cut).orderBy("_v").first()
        before += k
    return total, cut, None


def _split_first(df: DataFrame, order_cols, share: float) -> DataFrame:
    """Add ``split``: 'train' for the first int(N * share) rows in the order, 'test'
    for the rest. Rows are counted per value of the first order column; whole
    values fall on one side, and only the rows of the value at the border are ordered."""
    first = F.col(order_cols[0])
    # one row per value of the first order column (dates, or all stations)
    _, cut, border = _border(df.groupBy(first.alias("_v")).agg(F.count(F.lit(1)).alias("_n")), share)
    if border is None:  # no row, or all are on the first side
        return df.withColumn("split", F.lit("train"))
    value = F.lit(border["_v"]).cast(df.schema[order_cols[0]].dataType)
    at = first.eqNullSafe(value)
    before = F.lit(False) if border["_v"] is None else (first.isNull() | (first < value))
    whole = df.where(~at).withColumn("split", F.when(before, "train").otherwise("test"))
    left = cut - (border["_upto"] - border["_n"])
    if not left:
        return whole.unionByName(df.where(at).withColumn("split", F.lit("test")))
    ordered = global_positions(df.where(at), list(order_cols[1:]) or list(order_cols))
    ordered = ordered.withColumn("split", F.when(F.col("_pos") < left, "train").otherwise("test")).drop("_pos")
    return whole.unionByName(ordered)


def chrono_split(df: DataFrame, date_col: str, min_year: int, max_year: int, test_size: float = 0.2,
                 tie_cols=()) -> DataFrame:
    """Keep years in [min_year, max_year]; order by date (then the
    declared tie-break); the first int(N*(1-test_size)) rows are train.
    Adds ``split`` ('train'/'test')."""
    dtype = df.schema[date_col].dataType
    year = F.year(date_col) if isinstance(dtype, (T.DateType, T.TimestampType)) else F.col(date_col)
    kept = df.where(year.between(min_year, max_year))
    return _split_first(kept, [date_col, *tie_cols], 1 - test_size)


def positional_split(df: DataFrame, order_cols, train_frac: float = 0.8) -> DataFrame:
    """First int(N*train_frac) rows in the declared order are train."""
    return _split_first(df, list(order_cols), train_frac)


def date_split(df: DataFrame, date_col: str, test_start, test_end, check: bool = True) -> DataFrame:
    """train = before ``test_start``, test = [test_start, test_end];
    rows after the end are dropped. Raises when either side is empty (one
    aggregate)."""
    d = F.col(date_col)
    start, end = F.to_date(F.lit(str(test_start))), F.to_date(F.lit(str(test_end)))
    out = df.withColumn("split", F.when(d < start, "train").when(d.between(start, end), "test")).where(
        F.col("split").isNotNull())
    if check:
        r = out.agg(F.count_if(F.col("split") == "train").alias("tr"), F.count_if(F.col("split") == "test").alias("te")).first()
        if not r["tr"] or not r["te"]:
            raise ValueError(f"date_split leaves an empty side: {r['tr']} rows before the start date, {r['te']} in the test range")
    return out


def last_n_split(df: DataFrame, station_col: str, date_col: str, horizon: int) -> DataFrame:
    """Per station, the last ``horizon`` rows are test, the rest train;
    a station with ``horizon`` rows or fewer cannot be split and is marked
    'reject' (the reference raises for it)."""
    w_desc = Window.partitionBy(station_col).orderBy(F.col(date_col).desc())
    w_all = Window.partitionBy(station_col)
    out = df.withColumn("_rn", F.row_number().over(w_desc)).withColumn("_n", F.count(F.lit(1)).over(w_all))
    split = F.when(F.col("_n") <= horizon, "reject").when(F.col("_rn") <= horizon, "test").otherwise("train")
    return out.withColumn("split", split).drop("_rn", "_n")


def min_rows_guard(df: DataFrame, station_col: str, min_rows: int):
    """Stations with enough rows, and a reject table of the others."""
    counts = df.groupBy(station_col).agg(F.count(F.lit(1)).alias("n_rows"))
    ok = counts.where(F.col("n_rows") >= min_rows).select(station_col)
    rejected = counts.where(F.col("n_rows") < min_rows)
    return df.join(ok, station_col, "left_semi"), rejected
