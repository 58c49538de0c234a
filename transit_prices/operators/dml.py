"""Double Machine Learning, partially linear model.

Cross-fitting with k folds: nuisances E[Y|X] and E[D|X] are fitted on the
other folds and applied to the held-out fold; tau = sum(d~ y~) / sum(d~^2),
sigma^2 = RSS / (n - 1), se = sqrt(sigma^2 / sum(d~^2)), tau +- 1.96 se.

Linear nuisance (``nuisance='linear'``, OLS with intercept) needs no model
objects at all: every quantity above is a quadratic form of per-fold
sufficient statistics (Z'Z, Z'y, Z'd, y'y, d'd, y'd with Z = [1, X], X and y
centred first), so one ``groupBy(fold)`` aggregate is enough and only a (p+1)^2
matrix per fold reaches the driver. The per-station variant (J2) adds one
``groupBy(fold, station)`` over treated rows and solves every station's
D-nuisance from the shared Z'Z, one small group per station, instead of refitting
once per station.

Any other nuisance goes through Spark ML estimators (default: random forest
with the reference's 200 trees, depth 10, leaf size 5): k x 2 distributed
fits, each scored on its held-out fold. Beyond ``FOREST_ROWS`` rows the default forests are grown
by ``trees.grow_forest`` under the same rules, a tree a task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ship_package, spread_rows
from ..sources.readers import require_columns
from . import trees

Z_95 = 1.96
#: The default forest nuisances; rows up to which Spark ML grows them.
N_TREES, DEPTH, LEAST = 200, 10, 5
FOREST_ROWS = 200_000

DML_SCHEMA = T.StructType([
    T.StructField("tau_hat", T.DoubleType()), T.StructField("se_tau", T.DoubleType()),
    T.StructField("ci_low", T.DoubleType()), T.StructField("ci_high", T.DoubleType()),
    T.StructField("n", T.LongType()), T.StructField("n_splits", T.IntegerType()),
    T.StructField("y_col", T.StringType()), T.StructField("d_col", T.StringType()),
    T.StructField("x_cols", T.ArrayType(T.StringType())), T.StructField("random_state", T.IntegerType()),
])

BY_STATION_SCHEMA = T.StructType([
    T.StructField("station_id", T.LongType()), T.StructField("tau_hat", T.DoubleType()),
    T.StructField("se_tau", T.DoubleType()), T.StructField("ci_low", T.DoubleType()),
    T.StructField("ci_high", T.DoubleType()), T.StructField("ate_pct", T.DoubleType()),
    T.StructField("ci_low_pct", T.DoubleType()), T.StructField("ci_high_pct", T.DoubleType()),
    T.StructField("n", T.LongType()), T.StructField("n_treated", T.LongType()),
])


def prepare_dml_frame(df: DataFrame, y_col: str, d_col: str, x_cols, dropna: bool = True, extra=()):
    """Keep outcome, treatment (as int) and features; optional null drop
    (NaN counts as null). Raises KeyError listing missing columns."""
    cols = [y_col, d_col, *x_cols]
    require_columns(df, cols, "the Double ML table")
    out = df.select(*[c for c in extra if c not in cols], F.col(y_col), F.col(d_col).cast("int").alias(d_col),
                    *[F.col(c) for c in x_cols])
    if dropna:
        out = out.na.drop(how="any", subset=cols)
    return out, list(x_cols)


def assign_folds(df: DataFrame, n_splits: int, fold_col: str | None = None, key_cols=(), seed: int = 42) -> DataFrame:
    """Fold id: ``pmod(fold_col, k)`` when given, else a seeded hash of the
    key columns (stable under recomputation, so a lost task recomputes the
    same folds)."""
    if fold_col is not None:
        f = F.pmod(F.col(fold_col).cast("long"), F.lit(n_splits))
    else:
        keys = list(key_cols) or df.columns
        f = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in keys]), F.lit(n_splits))
    return df.withColumn("_fold", f.cast("int"))


# ---------------------------------------------------------------------------
# Linear nuisance from sufficient statistics
# ---------------------------------------------------------------------------


def _centred(df: DataFrame, y_col: str, x_cols):
    """([1, x...], y) as columns, x centred and scaled, y centred. With an intercept the
    residuals stay the same, and sums of squares keep their digits."""
    cols = [F.col(c).cast("double") for c in (y_col, *x_cols)]
    r = df.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = [r[f"m_{i}"] or 0.0 for i in range(len(cols))]
    z = [(c - F.lit(mean[i])) / F.lit(r[f"s_{i}"] or 1.0) for i, c in enumerate(cols) if i]
    return [F.lit(1.0), *z], cols[0] - F.lit(mean[0])


def _fold_stats(df: DataFrame, y, d_col: str, z, n_splits: int):
    """One aggregate: per fold Z'Z (upper triangle), Z'y, Z'd, y'y, d'd, y'd, n."""
    q = len(z)
    d = F.col(d_col).cast("double")
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(z[i] * z[j]).alias(f"a_{i}_{j}") for i in range(q) for j in range(i, q)]
    aggs += [F.sum(z[i] * y).alias(f"zy_{i}") for i in range(q)]
    aggs += [F.sum(z[i] * d).alias(f"zd_{i}") for i in range(q)]
    aggs += [F.sum(y * y).alias("yy"), F.sum(d * d).alias("dd"), F.sum(y * d).alias("yd")]
    rows = {r["_fold"]: r for r in df.groupBy("_fold").agg(*aggs).collect()}
    stats = []
    for f in range(n_splits):
        r = rows.get(f)
        a = np.zeros((q, q))
        zy, zd = np.zeros(q), np.zeros(q)
        if r is None:
            stats.append(dict(n=0, A=a, zy=zy, zd=zd, yy=0.0, dd=0.0, yd=0.0))
            continue
        for i in range(q):
            for j in range(i, q):
                a[i, j] = a[j, i] = r[f"a_{i}_{j}"] or 0.0
            zy[i] = r[f"zy_{i}"] or 0.0
            zd[i] = r[f"zd_{i}"] or 0.0
        stats.append(dict(n=r["n"], A=a, zy=zy, zd=zd, yy=r["yy"] or 0.0, dd=r["dd"] or 0.0, yd=r["yd"] or 0.0))
    return stats


def _solve(a, b):
    """OLS coefficients; least-norm solution when Z'Z is singular."""
    return np.linalg.lstsq(a, b, rcond=None)[0]


def _tau_se(sum_yd, sum_dd, sum_yy, n):
    if n <= 1 or sum_dd <= 0:
        return float("nan"), float("nan")
    tau = float(sum_yd) / float(sum_dd)
    rss = max(float(sum_yy) - 2 * tau * float(sum_yd) + tau * tau * float(sum_dd), 0.0)
    se = math.sqrt(rss / (n - 1) / float(sum_dd))
    return tau, se


def dml_linear_stats(df: DataFrame, y_col: str, d_col: str, x_cols, n_splits: int = 2, fold_col=None,
                     key_cols=(), seed: int = 42):
    data, x_cols = prepare_dml_frame(df, y_col, d_col, x_cols, extra=[c for c in ([fold_col] if fold_col else []) + list(key_cols)])
    # read twice: for the centres and for the sums
    data = assign_folds(data, n_splits, fold_col, key_cols, seed).persist(StorageLevel.MEMORY_AND_DISK)
    z, y = _centred(data, y_col, x_cols)
    st = _fold_stats(data, y, d_col, z, n_splits)
    data.unpersist()
    tot = {k: sum(s[k] for s in st) for k in ("A", "zy", "zd")}
    syd = sdd = syy = 0.0
    n = 0
    for s in st:
        a_o = tot["A"] - s["A"]
        by = _solve(a_o, tot["zy"] - s["zy"])
        bd = _solve(a_o, tot["zd"] - s["zd"])
        a = s["A"]
        syy += s["yy"] - 2 * by @ s["zy"] + by @ a @ by
        sdd += s["dd"] - 2 * bd @ s["zd"] + bd @ a @ bd
        syd += s["yd"] - by @ s["zd"] - bd @ s["zy"] + by @ a @ bd
        n += s["n"]
    return syd, sdd, syy, n


def run_dml(
    df: DataFrame,
    y_col: str,
    d_col: str,
    x_cols,
    n_splits: int = 2,
    nuisance="linear",
    ml_y=None,
    ml_d=None,
    random_state: int = 42,
    fold_col: str | None = None,
    key_cols=(),
) -> DataFrame:
    """Cross-fitted partially linear DML; returns the one-row result
    table (tau_hat, se_tau, ci_low, ci_high, n, n_splits, y_col, d_col,
    x_cols, random_state)."""
    x_cols = list(x_cols)
    if nuisance == "linear":
        syd, sdd, syy, n = dml_linear_stats(df, y_col, d_col, x_cols, n_splits, fold_col, key_cols, random_state)
    else:
        syd, sdd, syy, n = _dml_ml_stats(df, y_col, d_col, x_cols, n_splits, ml_y, ml_d, random_state, fold_col, key_cols)
    tau, se = _tau_se(syd, sdd, syy, n)
    row = (tau, se, tau - Z_95 * se, tau + Z_95 * se, int(n), int(n_splits), y_col, d_col, x_cols, int(random_state))
    return df.sparkSession.createDataFrame([row], DML_SCHEMA)


# ---------------------------------------------------------------------------
# ML nuisance (Spark ML estimators)
# ---------------------------------------------------------------------------


def default_forest(seed: int):
    from pyspark.ml.regression import RandomForestRegressor

    # a larger node-memory budget lets each data pass split more nodes
    return RandomForestRegressor(numTrees=N_TREES, maxDepth=DEPTH, minInstancesPerNode=LEAST, seed=seed, maxMemoryInMB=1024)


def _dml_ml_stats(df, y_col, d_col, x_cols, n_splits, ml_y, ml_d, seed, fold_col, key_cols):
    from pyspark.ml.feature import VectorAssembler

    data, x_cols = prepare_dml_frame(df, y_col, d_col, x_cols, extra=[c for c in ([fold_col] if fold_col else []) + list(key_cols)])
    data = assign_folds(data, n_splits, fold_col, key_cols, seed)
    data = VectorAssembler(inputCols=x_cols, outputCol="_x").transform(data).select(
        "_fold", F.col(y_col).cast("double").alias("_y"), F.col(d_col).cast("double").alias("_d"), "_x")
    data = cut_lineage(data)
    if ml_y is None and ml_d is None and data.count() > FOREST_ROWS:
        return _residual_sums(_forest_residuals(data, x_cols, n_splits, seed))
    ml_y = ml_y or default_forest(seed)
    ml_d = ml_d or default_forest(seed + 1)
    # read by 2k fits and the scoring: keep it (memory, then disk) instead of
    # recomputing the lineage each time; a lost block is recomputed
    data = spread_rows(data).persist(StorageLevel.MEMORY_AND_DISK)
    parts = []
    for f in range(n_splits):
        train = data.where(F.col("_fold") != f)
        test = data.where(F.col("_fold") == f)
        my = ml_y.copy().setFeaturesCol("_x").setLabelCol("_y").setPredictionCol("_my").fit(train)
        md = ml_d.copy().setFeaturesCol("_x").setLabelCol("_d").setPredictionCol("_md").fit(train)
        scored = md.transform(my.transform(test))
        parts.append(scored.select((F.col("_y") - F.col("_my")).alias("yt"), (F.col("_d") - F.col("_md")).alias("dt")))
    sums = _residual_sums(parts)
    data.unpersist()
    return sums


def _forest_residuals(data, x_cols, n_splits, seed):
    """Residuals (yt, dt) of rows (_x, _y, _d, _fold). As ``default_forest``'s: a third of the columns (rounded up) for each node, Poisson bootstraps of all rows;
    bins are exact quantiles."""
    from pyspark.ml.functions import vector_to_array

    names, each = [f"_x{i}" for i in range(len(x_cols))], -(-len(x_cols) // 3)
    flat = data.withColumn("_x", vector_to_array("_x")).select("_fold", "_y", F.col("_d").alias("d"), *[F.col("_x")[i].alias(c) for i, c in enumerate(names)])
    rows = cut_lineage(trees.binned(flat, names, trees.bin_edges(flat, names), "_y").select("x", "y", "d", "_fold"))
    parts = []
    for f in range(n_splits):
        train, scored = rows.where(F.col("_fold") != f), rows.where(F.col("_fold") == f).drop("_fold")
        for label, out, own in (("y", "_my", seed), ("d", "_md", seed + 1)):
            grown = trees.grow_forest(train.select("x", F.col(label).alias("y")), N_TREES, DEPTH, own, least=float(LEAST), columns=each)
            scored = trees.forest_predict(scored.withColumn("_x", F.col("x")), grown, out).withColumnRenamed("_x", "x")
        parts.append(scored.select((F.col("y") - F.col("_my")).alias("yt"), (F.col("d") - F.col("_md")).alias("dt")))
    return parts


def _residual_sums(parts):
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    r = res.agg(F.sum(F.col("yt") * F.col("dt")).alias("syd"), F.sum(F.col("dt") * F.col("dt")).alias("sdd"),
                F.sum(F.col("yt") * F.col("yt")).alias("syy"), F.count(F.lit(1)).alias("n")).first()
    return r["syd"] or 0.0, r["sdd"] or 0.0, r["syy"] or 0.0, r["n"]


# ---------------------------------------------------------------------------
# One effect per station, linear nuisance, all stations in one pass
# ---------------------------------------------------------------------------


def run_dml_by_station(
    df: DataFrame,
    y_col: str,
    base_treat_col: str,
    station_col: str,
    x_cols,
    n_splits: int = 2,
    random_state: int = 42,
    min_treated: int = 100,
    fold_col: str | None = None,
    key_cols=(),
) -> DataFrame:
    """For each station s, D_s = 1 when treated and nearest to s; skip
    stations with fewer than ``min_treated`` treated rows, none, or all;
    effect in log points and in percent (B34).

    n_treated and the skip test count all rows, n only the rows without a null outcome
    or feature; a null treatment is none. A station is a group of one row per fold."""
    x_cols = list(x_cols)
    ship_package(df.sparkSession)
    extra = [station_col] + ([fold_col] if fold_col else []) + list(key_cols)
    data = df.withColumn(base_treat_col, F.coalesce(F.col(base_treat_col).cast("int"), F.lit(0)))
    data, _ = prepare_dml_frame(data, y_col, base_treat_col, x_cols, dropna=False, extra=extra)
    data = assign_folds(data, n_splits, fold_col, key_cols, random_state)
    known = F.lit(True)
    for c in (y_col, *x_cols):
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    data = data.withColumn("_known", known).persist(StorageLevel.MEMORY_AND_DISK)
    complete = data.where("_known")
    n_rows = data.count()
    z, y = _centred(complete, y_col, x_cols)
    st = _fold_stats(complete, y, base_treat_col, z, n_splits)
    q = len(z)
    treated = data.where((F.col(base_treat_col) == 1) & F.col(station_col).isNotNull())
    own = lambda c: F.coalesce(F.sum(F.when(F.col("_known"), c)), F.lit(0.0))
    id_type = df.schema[station_col].dataType
    id_type = T.LongType() if isinstance(id_type, T.IntegralType) else id_type
    # one row per fold and station, written down; the stations stay a table
    per = cut_lineage(treated.groupBy(F.col(station_col).cast(id_type).alias("station_id"), "_fold").agg(
        F.count(F.lit(1)).alias("rows"), own(F.lit(1.0)).alias("m"), own(y).alias("sy"),
        *[own(z[i]).alias(f"z_{i}") for i in range(q)]))
    data.unpersist()
    n_total = sum(s["n"] for s in st)
    tot_a = sum(s["A"] for s in st)
    tot_zy = sum(s["zy"] for s in st)
    beta_y = [_solve(tot_a - s["A"], tot_zy - s["zy"]) for s in st]

    def effect(folds: pd.DataFrame) -> pd.DataFrame:
        """The row of one station, from its rows per fold."""
        n_treated = int(folds["rows"].sum())
        names = [f.name for f in BY_STATION_SCHEMA]
        if n_treated < min_treated or n_treated == n_rows:
            return pd.DataFrame([], columns=names)
        at = {int(r["_fold"]): r for _, r in folds.iterrows() if pd.notna(r["_fold"])}
        zd = [np.array([at[f][f"z_{i}"] for i in range(q)], dtype=float) if f in at else np.zeros(q) for f in range(n_splits)]
        zd_tot = sum(zd)
        syd = sdd = syy = 0.0
        for f, s in enumerate(st):
            a, by = s["A"], beta_y[f]
            bd = _solve(tot_a - a, zd_tot - zd[f])
            m, sy = (at[f]["m"], at[f]["sy"]) if f in at else (0.0, 0.0)
            syd += sy - by @ zd[f] - bd @ (s["zy"] - a @ by)   # D'y~ less the fitted part
            sdd += m - 2 * bd @ zd[f] + bd @ a @ bd
            syy += s["yy"] - 2 * by @ s["zy"] + by @ a @ by
        tau, se = _tau_se(syd, sdd, syy, n_total)
        lo, hi = tau - Z_95 * se, tau + Z_95 * se
        percent = [math.expm1(v) * 100 for v in (tau, lo, hi)]
        return pd.DataFrame([(folds["station_id"].iloc[0], tau, se, lo, hi, *percent, n_total, n_treated)], columns=names)

    schema = T.StructType([T.StructField("station_id", id_type), *BY_STATION_SCHEMA.fields[1:]])
    return per.groupBy("station_id").applyInPandas(effect, schema)
