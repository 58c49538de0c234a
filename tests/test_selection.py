import datetime as dt

import pytest

from transit_prices.operators import features, forecast, selection


def test_each_filter_is_optional(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.5), ("a", 0, 0.5), ("b", 1, 5.0), ("b", None, 0.1), ("c", 1, None)],
        "nom_gare string, is_new_gare int, distance_gare_km double")
    assert selection.select_sales(df).count() == 5
    assert selection.select_sales(df, "all").count() == 5
    assert selection.select_sales(df, "new").count() == 3
    assert selection.select_sales(df, "old").count() == 1
    assert selection.select_sales(df, "new", max_distance_km=5).count() == 2
    assert [r["nom_gare"] for r in selection.select_sales(df, "new", 1.0, "a").collect()] == ["a"]
    with pytest.raises(ValueError):
        selection.select_sales(df, "other")


def test_station_codes_follow_first_dates(spark):
    rows = [("b", dt.date(2000, 1, 1)), ("a", dt.date(2000, 2, 1)), ("b", dt.date(2001, 1, 1)), ("c", dt.date(2000, 1, 1)), (None, dt.date(1999, 1, 1))]
    df = spark.createDataFrame(rows, "s string, d date")
    assert {r["s"]: r["gare_id"] for r in selection.station_codes(df, "s", "d").collect()} == {"b": 0, "c": 1, "a": 2}
    assert selection.station_codes(df.limit(0), "s", "d").count() == 0


def test_preprocessor_learns_from_train_only(spark):
    train = spark.createDataFrame([("x", 1.0, 0.0), ("y", 2.0, 10.0), ("y", 3.0, 5.0)], "c string, r double, m double")
    test = spark.createDataFrame([("z", 4.0, 20.0), (None, None, 5.0)], "c string, r double, m double")
    got = features.fit_preprocessor(train, ["c"], ["r"], ["m"]).transform(test)
    assert got.columns == ["c", "r", "m"]
    assert sorted(map(tuple, got.collect()), key=str) == [(-1.0, 2.0, 2.0), (-1.0, None, 0.5)]


def test_station_inputs_and_encode_table(spark):
    df = spark.createDataFrame([("a", "u", 1.0, 100.0), ("b", "v", 3.0, 300.0)], "s string, k string, x double, y double")
    test = spark.createDataFrame([("c", "w", 5.0, 500.0)], "s string, k string, x double, y double")
    train_x, test_x, _, target = features.station_inputs(df, test, ["x"], "y", ["s"])
    assert sorted((r["s_b"], r["x"], r["y"]) for r in train_x.collect()) == [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)]
    assert [(r["s_b"], r["x"], r["y"]) for r in test_x.collect()] == [(0.0, 2.0, 2.0)]
    assert features.invert_scaler(test_x, target, ["y"]).first()["y"] == 500.0
    coded = features.encode_table(df, ["k"], "s", ["x"])
    assert sorted((r["s"], r["k"], r["x"], r["s_b"]) for r in coded.collect()) == [("a", 0.0, 0.0, 0.0), ("b", 1.0, 1.0, 1.0)]
    lone = features.encode_table(df.where("s = 'a'"), ["k"], "s", ["x"]).first()
    assert (lone["s_a"], lone["k"], lone["x"]) == (0.0, 0.0, 0.0)


def test_many_categories_stay_sparse(spark):
    df = spark.range(12_000).selectExpr("cast(id as string) as c", "double(id) as y", "id % 2 as d")
    out, names = features.design_matrix(df, "y", "d", ["c"], ["c"])
    assert len(names) == 12_000
    row = out.where("y = 7").first()
    assert row["features"].size == 12_000 and row["features"].numNonzeros() == 1
    assert names[int(row["features"].indices[0])] == "cat__c_7"


def test_direct_models_score_unseen_months(spark):
    rows = [(s, dt.date(2000 + m // 12, m % 12 + 1, 1), 10.0 * s + m) for s in (1, 2) for m in range(40)]
    panel = spark.createDataFrame(rows, "s long, d date, y double")
    win = forecast.direct_windows(panel, "s", "d", "y", ["y"], 4, 3)
    assert win.count() == 2 * 37
    out = forecast.score_direct(forecast.fit_direct(win, 3), win, "s")
    newest = out.where("origin = date '2003-04-01' and s = 1").orderBy("step").collect()
    assert [r["y_true"] for r in newest] == [None] * 3
    for r in newest:
        assert abs(r["y_pred"] - (49 + r["step"])) < 0.5
