from transit_prices.operators import features


def test_scalers_invert_and_exactness(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], "a double, c double")
    for kind in ("standard", "robust", "minmax"):
        p = features.fit_scaler(df, ["a", "c"], kind)
        back = features.invert_scaler(features.apply_scaler(df, p, ["a", "c"]), p, ["a", "c"]).collect()
        assert [round(r["a"], 9) for r in back] == [1.0, 2.0, 3.0, 10.0]
    rob = features.fit_scaler(df, ["a"], "robust").first()
    assert rob["a__center"] == 2.5 and abs(rob["a__scale"] - (4.75 - 1.75)) < 1e-12
    mm = features.apply_scaler(df, features.fit_scaler(df, ["c"], "minmax"), ["c"]).collect()
    assert all(r["c"] == 0.0 for r in mm)                      # constant column -> 0
    st = features.fit_scaler(df, ["a"], "standard").first()
    assert abs(st["a__scale"] - 3.5355339059327378) < 1e-12   # ddof 0


def test_encoders(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "v string")
    test = spark.createDataFrame([("c",), ("z",), (None,)], "v string")
    m = features.fit_ordinal(train, "v")
    got = [r["v"] for r in features.apply_ordinal(test, m, "v").orderBy("v").collect()]
    assert sorted(got) == [-1.0, -1.0, 2.0]
    oh = features.one_hot(test, "v", ["a", "c"]).collect()
    assert sorted((r["v_a"], r["v_c"]) for r in oh) == [(0.0, 0.0), (0.0, 0.0), (0.0, 1.0)]
    two = features.one_hot(train.where("v != 'c'"), "v", drop_if_binary=True)
    assert [c for c in two.columns if c.startswith("v_")] == ["v_b"]


def test_exact_quantiles_equal_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    for values in ([1.0, 2.0, 3.0, 10.0], [5.0], [1.0] * 50 + [2.0], list(rng.normal(size=999)), [None, 4.0, float(2**40)]):
        df = spark.createDataFrame([(v if v is None else float(v),) for v in values], "x double").repartition(4)
        got = features.exact_quantiles(df, "x", (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0))
        assert np.allclose(got, np.quantile([v for v in values if v is not None], (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)))
    assert features.exact_quantiles(spark.createDataFrame([], "x double"), "x", (0.5,)) == [None]
    r = features.fit_scaler(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double"), ["x"], "robust").first()
    assert (r["x__center"], r["x__scale"]) == (2.5, 3.0)


def test_metrics_of_constant_truth(spark):
    from transit_prices.operators import regress

    df = spark.createDataFrame([("one", 2.0, 3.0), ("flat", 1.0, 1.0), ("flat", 1.0, 3.0), ("ok", 1.0, 1.0), ("ok", 3.0, 2.0)], "g string, t double, p double")
    got = {r["g"]: r for r in regress.regression_metrics(df, "t", "p", ["g"]).collect()}
    assert got["one"]["r2"] is None and got["flat"]["r2"] is None and got["ok"]["r2"] == 0.5
    assert got["one"]["mae"] == 1.0 and got["flat"]["mse"] == 2.0
