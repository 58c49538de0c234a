"""Sliding sequences per station.

The reference loops over rows in Python; here a frame window partitioned by
station builds each window, so a window never crosses stations and the
work is spread by station. Windows count rows, not months; the complete
month filter (F6) or ``month_spine`` guarantees contiguity when needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sequences(
    df: DataFrame,
    station_col: str,
    date_col: str,
    feature_cols,
    target_col: str | None,
    n_steps: int,
    horizon: int = 1,
    multi: bool = False,
) -> DataFrame:
    """G1/G2 (``multi=False``): for t >= n, X = rows t-n..t-1, y = row t.
    G3/G4 (``multi=True``): t from n to T-h, X = t-n..t-1, y = t..t+h-1,
    skipped when any target is missing.

    Output: station, date of t, ``x`` (array of feature structs, oldest
    first) and ``y`` (double, or array of ``horizon`` doubles)."""
    w = Window.partitionBy(station_col).orderBy(date_col)
    past = w.rowsBetween(-n_steps, -1)
    x = F.collect_list(F.struct(*[F.col(c).cast("double").alias(c) for c in feature_cols])).over(past)
    cols = [F.col(station_col), F.col(date_col), x.alias("x"), F.row_number().over(w).alias("_rn")]
    if target_col is not None:
        if multi:
            # collect_list skips nulls, so a short list means a missing target
            cols.append(F.collect_list(F.col(target_col).cast("double")).over(w.rowsBetween(0, horizon - 1)).alias("y"))
        else:
            cols.append(F.col(target_col).cast("double").alias("y"))
    out = df.select(*cols).where(F.col("_rn") > n_steps)
    if target_col is not None and multi:
        out = out.where(F.size("y") == horizon)
    return out.drop("_rn")


def flatten_window(df: DataFrame, feature_cols, x_col: str = "x", out: str = "x_flat") -> DataFrame:
    """(steps x features) struct array -> one flat double array (step-major),
    the layout of a lag-feature vector."""
    parts = [F.transform(F.col(x_col), lambda s, c=c: s[c]) for c in feature_cols]
    flat = F.flatten(F.transform(F.sequence(F.lit(0), F.size(x_col) - 1),
                                 lambda i: F.array(*[p[i] for p in parts])))
    return df.withColumn(out, flat)


def month_spine(df: DataFrame, station_col: str, date_col: str) -> DataFrame:
    """Optional contiguity: every month between each station's first and
    last month, missing months as rows of nulls (sequence + explode, per
    station, no global step)."""
    bounds = df.groupBy(station_col).agg(F.min(date_col).alias("_a"), F.max(date_col).alias("_b"))
    spine = bounds.select(station_col, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias(date_col))
    return spine.join(df, [station_col, date_col], "left")


def window_before(df: DataFrame, date_col: str, end, steps: int, horizon: int) -> DataFrame:
    """Rows from ``steps + horizon`` months before ``end`` to ``end``,
    both inclusive."""
    e = F.to_date(F.lit(str(end)))
    return df.where(F.col(date_col).between(F.add_months(e, -(steps + horizon)), e))


def last_horizon_actuals(df: DataFrame, date_col: str, end, horizon: int, inclusive_start: bool = True) -> DataFrame:
    """Actuals of the last horizon; the reference's inclusive slice
    gives h+1 months (``inclusive_start=False`` gives h)."""
    e = F.to_date(F.lit(str(end)))
    start = F.add_months(e, -horizon)
    cond = F.col(date_col).between(start, e) if inclusive_start else (F.col(date_col) > start) & (F.col(date_col) <= e)
    return df.where(cond)
