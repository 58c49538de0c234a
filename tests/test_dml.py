import numpy as np

from pyspark.sql import functions as F

from transit_prices.operators import dml


def _numpy_dml(y, d, x, fold, k=2):
    z = np.column_stack([np.ones(len(y)), x])
    yt, dt = np.zeros(len(y)), np.zeros(len(y))
    for f in range(k):
        tr, te = fold != f, fold == f
        by = np.linalg.lstsq(z[tr], y[tr], rcond=None)[0]
        bd = np.linalg.lstsq(z[tr], d[tr], rcond=None)[0]
        yt[te] = y[te] - z[te] @ by
        dt[te] = d[te] - z[te] @ bd
    tau = (dt @ yt) / (dt @ dt)
    se = np.sqrt(((yt - tau * dt) ** 2).sum() / (len(y) - 1) / (dt @ dt))
    return tau, se


def _frame(spark, n=3000, effect=0.15, seed=3):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.uniform(0, 5, size=n)
    station = rng.integers(0, 4, size=n)
    d = (rng.uniform(size=n) < 0.2 + 0.1 * (x1 > 0)).astype(int)
    y = 8 + 0.3 * x1 - 0.1 * x2 + effect * d + rng.normal(scale=0.2, size=n)
    rows = [(int(i), float(a), float(b), int(c), float(e), int(s)) for i, a, b, c, e, s in zip(range(n), x1, x2, d, y, station)]
    df = spark.createDataFrame(rows, "key long, x1 double, x2 double, d int, y double, station long")
    return df, y, d, np.column_stack([x1, x2]), station


def test_linear_dml_matches_numpy_and_recovers_effect(spark):
    df, y, d, x, _ = _frame(spark)
    r = dml.run_dml(df, "y", "d", ["x1", "x2"], n_splits=2, fold_col="key").first()
    tau, se = _numpy_dml(y, d.astype(float), x, np.arange(len(y)) % 2)
    assert abs(r["tau_hat"] - tau) < 1e-8 and abs(r["se_tau"] - se) < 1e-8
    assert abs(r["tau_hat"] - 0.15) < 4 * r["se_tau"]
    assert r["n"] == len(y) and r["x_cols"] == ["x1", "x2"]


def test_placebo_is_null(spark):
    df, *_ = _frame(spark, effect=0.0, seed=5)
    placebo = df.withColumn("d", (F.xxhash64("key") % 2 == 0).cast("int"))
    r = dml.run_dml(placebo, "y", "d", ["x1", "x2"], n_splits=3).first()
    assert abs(r["tau_hat"]) < 4 * r["se_tau"]


def test_by_station_equals_per_station_loop(spark):
    df, *_ = _frame(spark, n=2000)
    out = {r["station_id"]: r for r in dml.run_dml_by_station(df, "y", "d", "station", ["x1", "x2"], fold_col="key",
                                                              min_treated=10).collect()}
    assert out
    for s, r in out.items():
        ds = df.withColumn("ds", ((F.col("d") == 1) & (F.col("station") == s)).cast("int"))
        one = dml.run_dml(ds, "y", "ds", ["x1", "x2"], fold_col="key").first()
        assert abs(one["tau_hat"] - r["tau_hat"]) < 1e-8 and abs(one["se_tau"] - r["se_tau"]) < 1e-8
        assert abs(r["ate_pct"] - (np.exp(r["tau_hat"]) - 1) * 100) < 1e-9


def test_min_treated_skips(spark):
    df, *_ = _frame(spark, n=500)
    assert dml.run_dml_by_station(df, "y", "d", "station", ["x1"], fold_col="key", min_treated=10_000).count() == 0


def test_forest_dml_recovers_planted_effect(spark):
    from pyspark.ml.regression import RandomForestRegressor

    df, *_ = _frame(spark, n=1500, effect=0.3, seed=9)
    rf = lambda s: RandomForestRegressor(numTrees=20, maxDepth=5, minInstancesPerNode=5, seed=s)
    r = dml.run_dml(df, "y", "d", ["x1", "x2"], n_splits=2, nuisance="forest", ml_y=rf(1), ml_d=rf(2),
                    fold_col="key").first()
    assert r["n"] == 1500 and r["se_tau"] > 0
    assert abs(r["tau_hat"] - 0.3) < 5 * r["se_tau"]


def test_large_offsets_keep_their_digits(spark):
    df, y, d, x, _ = _frame(spark)
    far = df.selectExpr("key", "x1 + 1e7 AS x1", "x2 * 1e-6 AS x2", "d", "y + 1e6 AS y", "station")
    r = dml.run_dml(far, "y", "d", ["x1", "x2"], fold_col="key").first()
    tau, se = _numpy_dml(y, d.astype(float), x, np.arange(len(y)) % 2)
    assert abs(r["tau_hat"] - tau) < 1e-6 and abs(r["se_tau"] - se) < 1e-6


def test_by_station_counts_come_before_the_null_drop(spark):
    df, *_ = _frame(spark, n=2000)
    holes = df.withColumn("x1", F.when(F.col("key") % 5 != 0, F.col("x1"))).withColumn("d", F.when(F.col("key") % 7 != 0, F.col("d")))
    raw = {r["station"]: r["n"] for r in holes.where("d = 1").groupBy("station").agg(F.count("*").alias("n")).collect()}
    out = {r["station_id"]: r for r in dml.run_dml_by_station(holes, "y", "d", "station", ["x1", "x2"], fold_col="key", min_treated=10).collect()}
    assert {s: r["n_treated"] for s, r in out.items()} == raw
    assert {r["n"] for r in out.values()} == {1600}
    for s, r in out.items():
        ds = holes.withColumn("ds", F.coalesce((F.col("d") == 1) & (F.col("station") == s), F.lit(False)).cast("int"))
        one = dml.run_dml(ds, "y", "ds", ["x1", "x2"], fold_col="key").first()
        assert abs(one["tau_hat"] - r["tau_hat"]) < 1e-8 and abs(one["se_tau"] - r["se_tau"]) < 1e-8


def test_forests_of_many_rows_find_the_effect_that_spark_ml_finds(spark, monkeypatch):
    """beyond FOREST_ROWS the default forests are grown a tree a task, and Spark ML is not called."""
    monkeypatch.setattr(dml, "N_TREES", 20)
    monkeypatch.setattr(dml, "DEPTH", 5)
    df, *_ = _frame(spark, n=1500, effect=0.3, seed=9)
    by_ml = dml.run_dml(df, "y", "d", ["x1", "x2"], nuisance="forest", fold_col="key").first()
    monkeypatch.setattr(dml, "FOREST_ROWS", 1000)
    monkeypatch.setattr(dml, "default_forest", None)
    r = dml.run_dml(df, "y", "d", ["x1", "x2"], nuisance="forest", fold_col="key").first()
    assert r["n"] == 1500 and abs(r["tau_hat"] - 0.3) < 5 * r["se_tau"]
    assert abs(r["tau_hat"] - by_ml["tau_hat"]) < r["se_tau"] and abs(r["se_tau"] / by_ml["se_tau"] - 1) < 0.1
