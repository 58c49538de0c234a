import os

from pyspark.sql import functions as F

from transit_prices.operators import clean, features, forecast
from transit_prices.sources import sinks


def _panel(spark):
    rows = [(s, F_date(t), 1000.0 + 10 * t + 50 * s) for s in range(3) for t in range(30)]
    return spark.createDataFrame(rows, "station long, date date, prix_m2 double")


def F_date(t):
    import datetime as dt

    return dt.date(2000 + t // 12, 1 + t % 12, 1)


def test_forecast_save_load_score(spark, tmpdir_path):
    p = _panel(spark)
    pred, model = forecast.forecast_station_prices(p, "station", "date", "prix_m2", "2002-01-01", n_lags=3,
                                                   model="linear")
    assert pred.count() == 3 * 6
    uri = os.path.join(tmpdir_path, "model")
    forecast.save_model(model, uri)
    scored = forecast.score_saved_model(uri, p, "station", "date", "prix_m2", n_lags=3)
    assert scored.count() == 3 * (30 - 3)
    err = scored.select(F.max(F.abs(F.col("y_true") - F.col("y_pred")))).first()[0]
    assert err < 1e-6                                    # linear series, linear model
    m = forecast.compare_with_baselines(pred, p, "station", "date", "prix_m2")
    assert {r["forecaster"] for r in m.collect()} == {"model", "last_value", "year_ago"}
    assert forecast.pred_vs_true(pred).count() == pred.count()


def test_design_matrix(spark):
    df = spark.createDataFrame([(1.0, 1, 2.0, "a"), (2.0, 0, 4.0, "b"), (3.0, 1, 6.0, "a")],
                               "y double, d int, x double, c string")
    out, names = features.design_matrix(df, "y", "d", ["x", "c"], ["c"])
    rows = out.collect()
    assert names == ["num__x", "cat__c_a", "cat__c_b"]
    assert [round(v, 9) for v in rows[0]["features"].toArray()] == [-1.224744871, 1.0, 0.0]


def test_sinks(spark, tmpdir_path):
    res = spark.createDataFrame([(0.1, 0.02)], "tau_hat double, se_tau double")
    sinks.write_results_json(res, os.path.join(tmpdir_path, "dml"))
    assert spark.read.json(os.path.join(tmpdir_path, "dml")).count() == 1
    met = spark.createDataFrame([(1.0, 2.0)], "mae double, mse double")
    sinks.append_metrics(met, os.path.join(tmpdir_path, "metrics"), "gbt", "Issy")
    sinks.append_metrics(met, os.path.join(tmpdir_path, "metrics"), "gbt", "Issy")
    assert spark.read.parquet(os.path.join(tmpdir_path, "metrics")).where("model = 'gbt'").count() == 2
    reg = sinks.register_run(spark, os.path.join(tmpdir_path, "registry"), "forest", {"numTrees": 200}, {"r2": 0.5, "mae": 3.0})
    assert reg.first()["r2"] == 0.5
    params = features.fit_scaler(met, ["mae"], "minmax")
    sinks.save_scaler(params, os.path.join(tmpdir_path, "scaler"))
    assert sinks.load_scaler(spark, os.path.join(tmpdir_path, "scaler")).count() == 1


def test_station_subset(spark):
    st = spark.createDataFrame([("B", 1.0, 2.0), ("A", 3.0, 4.0)], "nom_gare string, latitude double, longitude double")
    out = {r["nom_gare"]: r["id_gare"] for r in clean.station_subset(st).collect()}
    assert out == {"A": 0, "B": 1}


def test_registered_models_run_the_library_defaults(monkeypatch):
    import inspect

    from transit_prices.plans import queries_ml as q

    class Stop(Exception):
        pass

    seen = []

    def catch(function):
        def run(*args, **kwargs):
            bound = inspect.signature(function).bind(*args, **kwargs)
            bound.apply_defaults()
            seen.append(bound.arguments)
            raise Stop

        return run

    monkeypatch.setattr(q, "_design", lambda *a: (None, None))
    monkeypatch.setattr(q, "_dml_frame", lambda *a: None)
    monkeypatch.setattr(q, "supplier_panel", lambda *a: None)
    monkeypatch.setattr(q.trees, "staged_search", catch(q.trees.staged_search))
    monkeypatch.setattr(q.dml, "run_dml", catch(q.dml.run_dml))
    monkeypatch.setattr(q.forecast, "forecast_station_prices", catch(q.forecast.forecast_station_prices))
    for query in (q.q_search_forest, q.q_search_gbt, q.q_dml_forest, q.q_forecast_gbt):
        try:
            query(None, "")
        except Stop:
            pass
    forest, gbt, dml_forest, forecast = seen
    assert [(x["name"], len(x["draws"]), x["folds"]) for x in (forest, gbt)] == [("forest", 50, 5), ("gbt", 50, 5)]
    assert {k for d in gbt["draws"] for k in d} == set(q.regress.GBT_SPACE)
    assert dml_forest["ml_y"] is None and dml_forest["ml_d"] is None and forecast["max_iter"] == 50


def test_a_run_written_twice_leaves_one_copy(spark, tmpdir_path):
    met, uri = spark.createDataFrame([(1.0, 2.0)], "mae double, mse double"), os.path.join(tmpdir_path, "metrics")
    for _ in range(2):
        sinks.append_metrics(met, uri, "gbt", "Issy", run_id="a")
    sinks.append_metrics(met, uri, "gbt", "Issy", run_id="b")
    sinks.append_metrics(met, uri, "forest", "Issy", run_id="a")
    assert sorted((r["model"], r["run_id"]) for r in spark.read.parquet(uri).collect()) == [("forest", "a"), ("gbt", "a"), ("gbt", "b")]
    registry = os.path.join(tmpdir_path, "registry")
    for r2 in (0.5, 0.5, 0.6):
        sinks.register_run(spark, registry, "forest", {}, {"r2": r2}, run_date=F_date(3))
    assert sorted(r["r2"] for r in spark.read.parquet(registry).collect()) == [0.5, 0.6]


def test_comparison_replaces_its_own_pair_only(spark, tmpdir_path):
    """A10."""
    uri = os.path.join(tmpdir_path, "comparison")
    row = lambda station, y: spark.createDataFrame([("gbt", station, F_date(1), 1.0, y)], "model string, station string, date date, y_true double, y_pred double")
    for station, y in (("A", 1.0), ("B", 2.0), ("A", 3.0)):
        sinks.write_comparison(row(station, y), uri)
    found = spark.read.option("header", True).csv(uri).collect()
    assert sorted((r["station"], float(r["y_pred"])) for r in found) == [("A", 3.0), ("B", 2.0)]
