import numpy as np
import pytest
from pyspark.sql import functions as F

from transit_prices.operators import dml_forest, trees

X = ["x1", "x2"]


def frame(spark, n=2400, seed=3):
    """Three stations with their own effects; treatment depends on x1."""
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.uniform(0, 5, size=n)
    station = rng.integers(0, 3, size=n)
    d = (rng.uniform(size=n) < 0.2 + 0.2 * (x1 > 0)).astype(int)
    y = 8 + 0.5 * (x1 > 0) - 0.1 * x2 + np.array([0.5, 0.0, -0.4])[station] * d + rng.normal(scale=0.1, size=n)
    rows = [(i, float(a), float(b), int(c), float(e), int(s)) for i, (a, b, c, e, s) in enumerate(zip(x1, x2, d, y, station))]
    return spark.createDataFrame(rows, "key long, x1 double, x2 double, d int, y double, station long").repartition(3)


@pytest.mark.parametrize("entries", [10_000_000, 50])
def test_equals_one_fit_per_station(spark, entries, monkeypatch):
    """The same forests, one station after the other, all shares worked out anew."""
    df, grown = frame(spark, 600), []
    grow = trees.grow_forest
    monkeypatch.setattr(trees, "grow_forest", lambda *a, **b: grown.append(grow(*a, **b)) or grown[-1])
    found = {r["station_id"]: r for r in dml_forest.run_dml_by_station_forest(
        df, "y", "d", "station", X, min_treated=20, fold_col="key", n_trees=6, depth=4, entries=entries).collect()}
    assert set(found) == {0, 1, 2}
    binned = trees.binned(df, X, trees.bin_edges(df, X), "y").withColumn("fold", F.col("key") % 2)
    local = binned.orderBy("key").toPandas()
    x, fold = np.array(local["x"].tolist()), local["fold"].to_numpy()
    held = [dml_forest._held(f) for f in grown]
    forests = {0: held[:2], 1: held[2:]}
    for s, r in found.items():
        ds = ((local["d"] == 1) & (local["station"] == s)).to_numpy().astype(float)
        yt, dt = np.zeros(len(x)), np.zeros(len(x))
        for f in range(2):
            train, test = fold != f, fold == f
            yt[test] = local["y"][test] - sum(trees._leaf(t, x[test]) for t in forests[f][0]) / 6
            m = 0
            a, b = dml_forest.leaves(forests[f][1], x[train]), dml_forest.leaves(forests[f][1], x[test])
            for t in range(6):
                share = {leaf: ds[train][a[:, t] == leaf].mean() for leaf in np.unique(a[:, t])}
                m = m + np.array([share.get(leaf, 0.0) for leaf in b[:, t]]) / 6
            dt[test] = ds[test] - m
        tau = (dt @ yt) / (dt @ dt)
        se = np.sqrt(((yt - tau * dt) ** 2).sum() / (len(x) - 1) / (dt @ dt))
        assert r["tau_hat"] == pytest.approx(tau, abs=1e-9) and r["se_tau"] == pytest.approx(se, abs=1e-9)
        assert r["n"] == 600 and r["n_treated"] == int(ds.sum())


def test_planted_effects_are_found(spark):
    found = {r["station_id"]: r for r in dml_forest.run_dml_by_station_forest(frame(spark), "y", "d", "station", X, fold_col="key", n_trees=30, depth=6).collect()}
    # the other stations' effects are part of the noise of one
    for s, effect in enumerate([0.5, 0.0, -0.4]):
        assert abs(found[s]["tau_hat"] - effect) < 0.1
        assert found[s]["ate_pct"] == pytest.approx(np.expm1(found[s]["tau_hat"]) * 100)


def test_stations_with_few_treated_rows_are_left_out(spark):
    assert dml_forest.run_dml_by_station_forest(frame(spark, 300), "y", "d", "station", X, fold_col="key", min_treated=10_000).collect() == []


def test_leaf_shares_over_short_batches(spark, monkeypatch):
    """Counts gathered over batches, and passed on in parts, give each leaf its shares."""
    monkeypatch.setattr(dml_forest, "HELD", 20)
    x = [[i % 4, i % 3] for i in range(400)]
    rows = spark.createDataFrame([(v, "a" if i % 5 == 0 else "b" if i % 7 == 0 else None) for i, v in enumerate(x)], "x array<int>, station string").coalesce(1)
    tree = trees.grow(np.array(x), np.array([float(a + 2 * b) for a, b in x]), np.ones(400), 3, range(2))
    key, was = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, "10")
    try:
        found = {(r["tree"], r["leaf"], r["station"]): r["share"] for r in dml_forest.leaf_vectors(rows, [tree, tree]).collect()}
    finally:
        spark.conf.set(key, was)
    at = dml_forest.leaves([tree], np.array(x))[:, 0]
    for leaf in np.unique(at):
        for s in "ab":
            own = np.array([r["station"] == s for r in rows.collect()])[at == leaf]
            for t in (0, 1):
                assert found.get((t, leaf, s), 0.0) == pytest.approx(own.mean())
