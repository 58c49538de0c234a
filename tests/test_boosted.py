"""Boosting with an implicit one-hot key against Spark ML's on the dense columns."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from transit_prices.operators import boosted, forecast


def _rows(spark, n=600):
    rng = np.random.default_rng(3)
    a, b, k = rng.integers(0, 45, n) // rng.integers(1, 4, n), rng.normal(size=n), rng.integers(0, 25, n)
    y = 3.0 * a + 40 * b + np.where(k == 7, 150, 0) - np.where(k == 12, 90, 0) + rng.normal(0, 3, n)
    return spark.createDataFrame([(float(p), float(q), f"k{r:02d}", float(s)) for p, q, r, s in zip(a, b, k, y)], "a double, b double, k string, y double")


@pytest.mark.parametrize("tasks", [1, 3])
def test_trees_are_those_of_spark_ml_on_one_hot_columns(spark, tasks):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    indexer = StringIndexer(inputCol="k", outputCol="i", handleInvalid="keep", stringOrderType="alphabetAsc")
    rows = indexer.fit(df := _rows(spark).cache()).transform(df)
    dense = Pipeline(stages=[OneHotEncoder(inputCol="i", outputCol="o", handleInvalid="keep"), VectorAssembler(inputCols=["a", "b", "o"], outputCol="features"),
                             GBTRegressor(labelCol="y", maxIter=6, maxDepth=3, seed=1, predictionCol="theirs")]).fit(rows)
    edges = boosted.middle_edges(rows, ["a", "b"])
    trees = boosted.boosted_trees(rows, ["a", "b"], "y", "i", edges, rounds=6, depth=3, tasks=tasks)
    mine = boosted.BoostedModel(inputCols=["a", "b"], keyCol="i", edges=edges, trees=[[v.tolist() for v in t] for t in trees])
    assert any((t[0] == 2).any() for t in trees)  # a key is split on
    apart = mine.transform(dense.transform(rows)).agg(F.max(F.abs(F.col("prediction") - F.col("theirs")))).first()[0]
    assert apart < 1e-8


def test_station_forecast_holds_no_column_per_station(spark, tmpdir_path):
    """a row is as wide as its lags, however many stations; the model saves, loads and scores
    stations it has not seen."""
    rows = [(s, dt.date(2000 + t // 12, 1 + t % 12, 1), 1000.0 + 10 * t + 50 * (s or 0) + ((s or 0) * t) % 7) for s in [*range(12), None] for t in range(30)]
    late = [(99, dt.date(2002, 1 + t, 1), 900.0 + t) for t in range(5)]
    panel = spark.createDataFrame(rows + late, "station long, date date, p double")
    pred, model = forecast.forecast_station_prices(panel, "station", "date", "p", "2002-01-01", n_lags=3, max_iter=5)
    assert pred.count() == 13 * 6 + 2 and pred.where("y_pred is null or y_pred < 100").count() == 0
    wide = [f.name for f in model.transform(panel.selectExpr("cast(station as string) station", *[f"p p_lag{k}" for k in (1, 2, 3)])).schema.fields if f.dataType.typeName() == "vector" or "VectorUDT" in str(f.dataType)]
    assert wide == []
    forecast.save_model(model, uri := os.path.join(tmpdir_path, "boosted"))
    scored = forecast.score_saved_model(uri, panel, "station", "date", "p", n_lags=3).where("date >= '2002-01-01'")
    assert sorted(map(str, scored.select("station", "date", "y_pred").collect())) == sorted(map(str, pred.select("station", "date", "y_pred").collect()))


def test_edges_of_repeated_values(spark):
    """Few values: every middle; a value holding several shares: the next edges follow it at once."""
    few = spark.createDataFrame([(float(v),) for v in [1, 1, 2, 4]], "v double")
    assert boosted.middle_edges(few, ["v"]) == [[1.5, 3.0]]
    values = [0.0] * 60 + [float(v) for v in range(1, 41)]
    many = spark.createDataFrame([(v,) for v in values], "v double")
    assert boosted.middle_edges(many, ["v"], 5)[0][:3] == [0.5, 1.5, 2.5]


def test_ties_do_not_hang_on_rounding():
    """Columns that part the rows alike: the first one, whatever the order of the sums."""
    n = np.tile([3.0, 2.0] + [0.0] * 30, (1, 2, 1))
    for noise in (1e-13, -1e-13):
        s = np.array([[[6.0, 10.0] + [0.0] * 30, [6.0 + noise, 10.0 - 2 * noise] + [0.0] * 30]])
        gain, column, cut, n_l, _ = boosted._best_cuts(n, s, None)
        assert (column[0], cut[0], n_l[0]) == (0, 0, 3.0) and gain[0] > 0
    none = boosted._best_keys(np.zeros((1, 2)), np.zeros((1, 2)), np.array([4.0]), np.array([1.0]), np.array([5, 6]))
    assert none[0, 0] == -np.inf
    a, b = [(np.zeros(1), np.array([[g], [k], [1.0], [1.0]])) for g, k in ((2.0, 9.0), (2.0 - 1e-12, 4.0))]
    assert boosted._add_and_best(a, b)[1][1, 0] == boosted._add_and_best(b, a)[1][1, 0] == 4.0
    empty = (np.zeros(1), np.full((4, 1), -np.inf))
    assert boosted._add_and_best(a, empty)[1][1, 0] == boosted._add_and_best(empty, a)[1][1, 0] == 9.0
