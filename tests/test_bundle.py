import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from transit_prices.operators import bundle, forecast


def month(t):
    return dt.date(2000 + t // 12, 1 + t % 12, 1)


def panel(spark, months=72, noise=3.0):
    """A trend, a season and a little noise for six stations; two features."""
    rng = random.Random(2)
    rows = []
    for s in range(6):
        for t in range(months):
            y = 1000.0 + 200 * s + 6 * t + (40 + 5 * s) * math.sin(2 * math.pi * t / 12) + rng.gauss(0, noise)
            rows.append((s, month(t), y, float(t % 12), rng.random()))
    return spark.createDataFrame(rows, "station long, date date, prix double, a double, b double").repartition(3)


def key(r):
    return (r["station"], r["origin"], r["step"])


def test_saved_and_loaded_bundles_score_alike(spark, tmpdir_path):
    p, registry = panel(spark), os.path.join(tmpdir_path, "registry")
    train = p.where(F.col("date") < "2004-01-01")
    fitted = bundle.fit_bundle(train, "station", "date", ["a", "b", "prix"], "prix", 6, 3)
    bundle.save_bundle(spark, fitted, os.path.join(tmpdir_path, "old"), registry, run_id="1")
    bundle.save_bundle(spark, fitted, os.path.join(tmpdir_path, "new"), registry, run_id="2")
    held = bundle.newest_bundle(spark.newSession(), registry)
    assert (held.features, held.target, held.n_steps, held.horizon) == (["a", "b", "prix"], "prix", 6, 3)
    test = p.where(F.col("date") >= "2004-01-01")
    one = sorted(fitted.score(test, "station", "date").collect(), key=key)
    two = sorted(held.score(spark.createDataFrame(test.collect(), test.schema), "station", "date").collect(), key=key)
    assert len(one) == 6 * 19 * 3 and [tuple(r)[:3] for r in one] == [tuple(r)[:3] for r in two]
    assert [r["y_pred"] for r in one] == pytest.approx([r["y_pred"] for r in two])
    # the scaler knows the train rows only, and a missing feature is told before any job
    assert held.scaler.first()["a__center"] == 0.0 and held.scaler.first()["prix__scale"] < 1700
    with pytest.raises(KeyError, match="b"):
        held.score(test.drop("b"), "station", "date")
    with pytest.raises(ValueError, match="registered"):
        bundle.newest_bundle(spark, registry, "other")


def test_best_round():
    assert forecast.best_round([5, 4, 3, 3.5, 3.4, 2.0], 2) == 3
    assert forecast.best_round([5, 4, 3, 3.5, 3.4, 2.0], 3) == 6
    assert forecast.best_round([1.0], 5) == 1 and forecast.best_round([1, 2, 3], 1) == 1


def test_early_stopping_beats_both_naive_forecasts(spark):
    p = panel(spark, 84, noise=6.0)
    pred, facts = forecast.forecast_with_early_stopping(p, "station", "date", "prix", "2006-01-01", max_rounds=40, patience=5, depth=3)
    rounds, losses = facts["best_round"], facts["losses"]
    assert 1 <= rounds < 40 and losses[rounds - 1] == min(losses[: rounds + 5])
    assert facts["model"].getNumTrees == rounds
    # what was restored scores as the long run did after that round
    table = forecast.compare_with_baselines(pred.withColumn("station", F.col("station").cast("string")), p, "station", "date", "prix")
    mae = {r["forecaster"]: r["m"] for r in table.groupBy("forecaster").agg(F.avg("mae").alias("m")).collect()}
    assert pred.count() == 6 * 12
    assert mae["model"] < mae["last_value"] and mae["model"] < mae["year_ago"]


def test_first_trees_are_the_shorter_fit(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rows = spark.range(200).selectExpr("cast(id % 17 as double) a", "cast(id % 5 as double) b", "cast((id * 7) % 17 + id % 3 as double) label")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).coalesce(1).cache()
    make = lambda n: GBTRegressor(maxIter=n, maxDepth=2, seed=1)
    cut = forecast.FirstTrees(make(7).fit(rows), 3)
    order = lambda df: [r["prediction"] for r in df.orderBy("a", "b", "label").collect()]
    assert cut.getNumTrees == 3 and order(cut.transform(rows)) == pytest.approx(order(make(3).fit(rows).transform(rows)))
