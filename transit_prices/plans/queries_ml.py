"""Registered queries, part 2: Double ML, station x month panels, splits,
sequences, scaling, encoding, metrics, models and coverage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from ..operators import bundle, clean, dml, dml_forest, enrich, features, forecast, panel, regress, selection, sequences, splits, trees
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources import adapters
from ..sources.readers import INDICATOR_COLUMNS
from . import causal
from .queries import _inputs, rounded

# Supplier x month panel of the driver data (F3 input): suppliers act as
# stations; 83 months, 61 of 100 suppliers complete at sf0.01.
PANEL_NUMERIC = ["rooms", "surface", "discount"]
PANEL_TARGET = "prix_m2"
PANEL_CATS = ["type_local", "nature_mutation"]

SEQ_STEPS, SEQ_HORIZON = 18, 6      # multi-horizon defaults of the reference
SINGLE_STEPS = 12                   # single-step window of the reference
TEST_START, TEST_END = "2000-01-01", "2000-12-01"
LAST_N = 24                         # last months held out (reference forecast_horizon)
DML_X = ["surface", "rooms", "taux", "distance_hist_km"]
DML_FOREST_X = ["surface", "rooms", "taux", "revenu_median_2021", "part_hlm_2022", "distance_hist_km"]
MIN_TREATED = 100


def supplier_panel(spark, sf_dir, complete_only=True):
    return panel.station_month_features(
        adapters.sales_typed(spark, sf_dir), "date", "station", PANEL_NUMERIC,
        complete_only=complete_only, target_col=PANEL_TARGET)


# ---------------------------------------------------------------------------
# Double ML
# ---------------------------------------------------------------------------


def _dml_frame(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return causal.enriched_sales(inp)


def q_dml_linear(spark, sf_dir):
    e = _dml_frame(spark, sf_dir)
    r = dml.run_dml(e, "log_prix_m2", "d_gp", DML_X, n_splits=2, nuisance="linear", fold_col="order_key")
    return rounded(r.select("tau_hat", "se_tau", "ci_low", "ci_high", "n", "n_splits", "y_col", "d_col"))


def q_dml_by_station_linear(spark, sf_dir):
    e = _dml_frame(spark, sf_dir)
    r = dml.run_dml_by_station(e, "log_prix_m2", "d_gp", "station_id", DML_X, n_splits=2,
                               min_treated=MIN_TREATED, fold_col="order_key")
    return rounded(r)


def q_dml_forest(spark, sf_dir):
    e = _dml_frame(spark, sf_dir)
    r = dml.run_dml(e, "log_prix_m2", "d_gp", DML_FOREST_X, n_splits=2, nuisance="forest", fold_col="order_key")
    return r.select("tau_hat", "se_tau", "ci_low", "ci_high", "n", "n_splits", "y_col", "d_col")


def q_dml_by_station_forest(spark, sf_dir):
    e = _dml_frame(spark, sf_dir)
    return dml_forest.run_dml_by_station_forest(e, "log_prix_m2", "d_gp", "station_id", DML_FOREST_X, n_splits=2,
                                                min_treated=MIN_TREATED, fold_col="order_key")


# ---------------------------------------------------------------------------
# Station x month panels
# ---------------------------------------------------------------------------


def q_station_month_features(spark, sf_dir):
    return rounded(supplier_panel(spark, sf_dir, complete_only=True))


def q_station_month_features_all(spark, sf_dir):
    return rounded(supplier_panel(spark, sf_dir, complete_only=False))


def q_station_month_features_mode(spark, sf_dir):
    df = adapters.sales_typed(spark, sf_dir)
    return rounded(panel.station_month_features_mode(df, "date", "station", PANEL_NUMERIC + [PANEL_TARGET], PANEL_CATS))


def q_station_month_modes(spark, sf_dir):
    df = adapters.sales_typed(spark, sf_dir)
    return rounded(panel.station_month_modes(df, "date", "station", [PANEL_TARGET, "surface"], PANEL_CATS))


# ---------------------------------------------------------------------------
# Splits and sequences
# ---------------------------------------------------------------------------


def q_chrono_split(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    s = splits.chrono_split(inp.sales, "annee", 1996, 2000, 0.2, tie_cols=["date_mutation", "sale_id"])
    return s.select("sale_id", "annee", "split")


def q_date_split(spark, sf_dir):
    p = supplier_panel(spark, sf_dir)
    return splits.date_split(p, "date", TEST_START, TEST_END).select("station", "date", "split")


def q_last_n_split(spark, sf_dir):
    p = supplier_panel(spark, sf_dir)
    return splits.last_n_split(p, "station", "date", LAST_N).select("station", "date", "split")


def _seq_summary(seq, multi: bool):
    xs = F.transform("x", lambda s: s["n_transactions"])
    cols = [F.col("station"), F.col("date"),
            F.aggregate(xs, F.lit(0.0), lambda a, v: a + v).alias("x_sum"),
            F.element_at(xs, 1).alias("x_first"), F.element_at(xs, -1).alias("x_last")]
    if multi:
        cols += [F.element_at("y", 1).alias("y_first"), F.element_at("y", -1).alias("y_last"),
                 F.size("y").alias("y_len")]
    else:
        cols.append(F.col("y"))
    return seq.select(*cols)


def q_sequences_single(spark, sf_dir):
    p = supplier_panel(spark, sf_dir)
    seq = sequences.sequences(p, "station", "date", ["n_transactions", PANEL_TARGET], PANEL_TARGET, SINGLE_STEPS)
    return rounded(_seq_summary(seq, False))


def q_sequences_multi(spark, sf_dir):
    p = supplier_panel(spark, sf_dir)
    seq = sequences.sequences(p, "station", "date", ["n_transactions", PANEL_TARGET], PANEL_TARGET,
                              SEQ_STEPS, SEQ_HORIZON, multi=True)
    return rounded(_seq_summary(seq, True))


def q_positional_split(spark, sf_dir):
    p = supplier_panel(spark, sf_dir)
    seq = sequences.sequences(p, "station", "date", ["n_transactions"], PANEL_TARGET, SINGLE_STEPS)
    return splits.positional_split(seq.select("station", "date"), ["station", "date"], 0.8)


def q_prediction_window(spark, sf_dir):
    """C11 (monthly count >= k) -> F4 -> C13 window -> G11 guard."""
    df = adapters.sales_typed(spark, sf_dir)
    p = panel.station_month_features(df, "date", "station", PANEL_NUMERIC, complete_only=False, target_col=PANEL_TARGET)
    p = p.where(F.col("n_transactions") >= 5)
    w = sequences.window_before(p, "date", "2001-06-01", SEQ_STEPS, SEQ_HORIZON)
    ok, _ = splits.min_rows_guard(w, "station", SEQ_STEPS + SEQ_HORIZON)
    return rounded(ok.select("station", "date", "n_transactions", PANEL_TARGET))


# ---------------------------------------------------------------------------
# Selection (C10-C12), station codes (B31), prediction chain (J10), unions
# ---------------------------------------------------------------------------

ONE_STATION = 14
MIN_COUNT = 5
PREDICTION_END = "2001-06-01"
PANEL_FEATURES = ["n_transactions", PANEL_TARGET, *PANEL_NUMERIC, "share_appartement", "share_vente"]


def q_select_new_within(spark, sf_dir):
    """C10 (new stations) and C11 (distance, monthly count) on the enriched sales."""
    e = causal.enriched_sales(_inputs(spark, sf_dir))
    near = selection.select_sales(e, "new", max_distance_km=2.0, new_col="d_gp", distance_col="distance_gp_km")
    months = near.groupBy("station_id", "date").agg(F.count(F.lit(1)).alias("n_transactions"))
    return selection.min_transactions(months, 2)


def q_select_one_station(spark, sf_dir):
    df = adapters.sales_typed(spark, sf_dir)
    return selection.select_sales(df, station=ONE_STATION, station_col="station").select("sale_id", "station", "date")


def q_station_codes(spark, sf_dir):
    return selection.station_codes(supplier_panel(spark, sf_dir, complete_only=False), "station", "date")


def _selected_panel(spark, sf_dir):
    """C10 -> F4 -> C11: suppliers with an even key are the new stations."""
    df = adapters.sales_typed(spark, sf_dir).withColumn("is_new_gare", (F.col("station") % 2 == 0).cast("int"))
    df = selection.select_sales(df, "new")
    p = panel.station_month_features(df, "date", "station", PANEL_NUMERIC, complete_only=False, target_col=PANEL_TARGET)
    return selection.min_transactions(p, MIN_COUNT)


def _scaled_history(spark, sf_dir):
    """The panel up to the end, scaled with parameters of the months before the
    prediction window; the target stays in euros as ``y``."""
    p = _selected_panel(spark, sf_dir)
    start = F.add_months(F.to_date(F.lit(PREDICTION_END)), -(SEQ_STEPS + SEQ_HORIZON))
    params = features.fit_scaler(p.where(F.col("date") < start), PANEL_FEATURES, "minmax")
    return features.apply_scaler(p.withColumn("y", F.col(PANEL_TARGET)), params, PANEL_FEATURES)


def q_prediction_input(spark, sf_dir):
    """J10 before the model: selection, window (C13), scaler, flattened windows."""
    from pyspark.ml.functions import vector_to_array

    w = sequences.window_before(_scaled_history(spark, sf_dir), "date", PREDICTION_END, SEQ_STEPS, SEQ_HORIZON)
    win = forecast.direct_windows(w, "station", "date", "y", PANEL_FEATURES, SEQ_STEPS, SEQ_HORIZON)
    x = vector_to_array("features")
    return rounded(win.select(
        "station", "origin", F.size(x).alias("x_len"), F.element_at(x, 1).alias("x_first"), F.element_at(x, -1).alias("x_last"),
        F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("x_sum"), "y1", F.col(f"y{SEQ_HORIZON}").alias("y_end")))


def q_predict_selected(spark, sf_dir):
    """One model per step, fitted on windows whose targets end before the
    prediction window; the newest windows score months that nobody has seen."""
    history = _scaled_history(spark, sf_dir)
    # read by every fit and by the scoring: written down once
    win = cut_lineage(forecast.direct_windows(history, "station", "date", "y", PANEL_FEATURES, SEQ_STEPS, SEQ_HORIZON))
    end = F.to_date(F.lit(PREDICTION_END))
    cut = F.add_months(end, -(SEQ_STEPS + SEQ_HORIZON))
    models = forecast.fit_direct(win.where(F.add_months("origin", SEQ_HORIZON) < cut), SEQ_HORIZON)
    return rounded(forecast.score_direct(models, win.where(F.col("origin").between(F.add_months(end, -SEQ_HORIZON), end)), "station"))


#: The 21 features of the reference's windows (19 means and two shares).
ALL_FEATURES = ["surface", "rooms", "distance_gare_km", "relative_signature", "relative_opening", "taux", "lat_gare", "lon_gare",
                "variation_mom", "variation_yoy", *INDICATOR_COLUMNS, "share_appartement", "share_vente"]


def _feature_panel(spark, sf_dir):
    """Station x month means of the price-regression table (F4), with all 21 features."""
    s = causal.price_features(_inputs(spark, sf_dir)).withColumnRenamed("nearest_gare", "station")
    p = panel.station_month_features(s, "date", "station", ALL_FEATURES[:-2], complete_only=False, target_col=PANEL_TARGET)
    return cut_lineage(p)


def q_feature_panel(spark, sf_dir):
    return rounded(_feature_panel(spark, sf_dir))


def q_predict_bundle(spark, sf_dir):
    """J10 from saved parts: fit before the prediction window, save, find the newest bundle
    through the registry, load it and score the newest windows."""
    p = _feature_panel(spark, sf_dir)
    end = F.to_date(F.lit(PREDICTION_END))
    train = p.where(F.col("date") < F.add_months(end, -(SEQ_STEPS + SEQ_HORIZON)))
    folder = f"{ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix='tp-models-')).rstrip('/')}/bundle-{uuid.uuid4().hex}"
    fitted = bundle.fit_bundle(train, "station", "date", ALL_FEATURES, PANEL_TARGET, SEQ_STEPS, SEQ_HORIZON)
    bundle.save_bundle(spark, fitted, f"{folder}/model", f"{folder}/registry")
    held = bundle.newest_bundle(spark, f"{folder}/registry")
    scored = held.score(p.where(F.col("date") >= F.add_months(end, -(SEQ_STEPS + SEQ_HORIZON))), "station", "date")
    return rounded(scored.where(F.col("origin") <= end))


def q_last_horizon_actuals(spark, sf_dir):
    p = supplier_panel(spark, sf_dir)
    return rounded(sequences.last_horizon_actuals(p, "date", PREDICTION_END, SEQ_HORIZON).select("station", "date", PANEL_TARGET))


def q_assemble_frames(spark, sf_dir):
    df = adapters.sales_typed(spark, sf_dir)
    return clean.assemble_frames(
        df.where(F.col("type_local") == "Appartement").select("sale_id", F.col("date").cast("timestamp").alias("date"), "rooms"),
        df.where(F.col("type_local") == "Maison").select("sale_id", "date", "surface"), ["date"])


# ---------------------------------------------------------------------------
# Scaling and encoding
# ---------------------------------------------------------------------------

SCALE_COLS = ["surface", "rooms", "prix_m2"]


def _scaled(spark, sf_dir, kind):
    inp = _inputs(spark, sf_dir)
    s = inp.sales.select("sale_id", *SCALE_COLS)
    params = features.fit_scaler(s, SCALE_COLS, kind)
    return rounded(features.apply_scaler(s, params, SCALE_COLS))


def q_scale_standard(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


def q_scale_robust(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


def q_scale_minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


def q_scale_inverse(spark, sf_dir):
    """Scaled and turned back."""
    s = adapters.sales_typed(spark, sf_dir).select("sale_id", *SCALE_COLS)
    params = features.fit_scaler(s, SCALE_COLS, "standard")
    back = features.invert_scaler(features.apply_scaler(s, params, SCALE_COLS), params, SCALE_COLS)
    # the price in cents: whole units stand clear of the last digit's noise
    return rounded(back.select("sale_id", "surface", "rooms", (F.col(PANEL_TARGET) * F.col("surface")).alias("value")), per_column={"value": 2})


def q_preprocess(spark, sf_dir):
    """I2, fitted on the sales before the test period."""
    df = adapters.sales_typed(spark, sf_dir).select("sale_id", "date", "type_local", "nature_mutation", *SCALE_COLS)
    fitted = features.fit_preprocessor(df.where(F.col("date") < TEST_START), PANEL_CATS, ["surface", "rooms"], [PANEL_TARGET])
    return rounded(fitted.transform(df).drop("date"))


def q_station_inputs(spark, sf_dir):
    """I3 on the complete panel: features and target scaled apart, both by the train months."""
    p = supplier_panel(spark, sf_dir)
    numeric = [c for c in PANEL_FEATURES if c != PANEL_TARGET]
    train, test, _, _ = features.station_inputs(
        p.where(F.col("date") < TEST_START), p.where(F.col("date") >= TEST_START), numeric, PANEL_TARGET)
    return rounded(train.unionByName(test).select("station", "date", *PANEL_FEATURES))


def q_encode_table(spark, sf_dir):
    """I4: labels, one-hot and min-max."""
    df = adapters.sales_typed(spark, sf_dir).select("sale_id", "nature_mutation", "type_local", *SCALE_COLS)
    return rounded(features.encode_table(df, ["nature_mutation"], "type_local", SCALE_COLS).drop("type_local"))


def q_ordinal_encode(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    typed = adapters.sales_typed(spark, sf_dir).select("sale_id", "type_local", "nature_mutation")
    out = typed
    for c in ("type_local", "nature_mutation"):
        out = features.apply_ordinal(out, features.fit_ordinal(inp.sales, c), c, out=f"{c}_idx")
    return out.select("sale_id", "type_local_idx", "nature_mutation_idx")


def q_one_hot(spark, sf_dir):
    typed = adapters.sales_typed(spark, sf_dir).select("sale_id", "type_local")
    return features.one_hot(typed, "type_local").drop("type_local")


# ---------------------------------------------------------------------------
# Metrics and models
# ---------------------------------------------------------------------------


def q_regression_metrics(spark, sf_dir):
    p = supplier_panel(spark, sf_dir)
    base = regress.naive_forecasts(p, "station", "date", PANEL_TARGET)
    parts = [regress.regression_metrics(base, PANEL_TARGET, col, ["station"]).withColumn("forecaster", F.lit(name))
             for name, col in (("last_value", "pred_last"), ("year_ago", "pred_year_ago"))]
    # squared euros reach 1e8: two places keep the digits above float noise
    return rounded(parts[0].unionByName(parts[1]), per_column={"mse": 2})


PRICE_X = ["surface", "rooms", "distance_gare_km", "taux", "revenu_median_2021", "part_hlm_2022"]
GBT_ROWS_PER_TASK = 50_000


def _design(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    f = causal.price_features(inp).where(F.col("annee").between(1996, 2000))
    f = f.na.drop(subset=PRICE_X + ["prix_m2"])
    sp = cut_lineage(splits.chrono_split(f, "annee", 1996, 2000, 0.2, tie_cols=["date", "sale_id"]).select(*PRICE_X, "prix_m2", "split"))
    return sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")


def _final_gbt(train, test, params):
    """The chosen draw on all training rows, by Spark ML."""
    from pyspark.ml.feature import VectorAssembler

    asm = VectorAssembler(inputCols=PRICE_X, outputCol="features")
    rows = asm.transform(train).withColumn("label", F.col("prix_m2"))
    # one task per so many rows: a round is a handful of short jobs
    rows = rows.coalesce(max(1, -(-rows.count() // GBT_ROWS_PER_TASK)))
    est = regress.make_estimator("gbt").setMaxMemoryInMB(1024)
    model = est.fit(rows, {est.getParam(k): v for k, v in params.items()})
    return model.transform(asm.transform(test))


def _search(spark, sf_dir, name):
    """The reference's ranges, 50 draws x 5 folds: draws share their trees."""
    train, test = _design(spark, sf_dir)
    draws = regress.sample_draws(regress.FOREST_SPACE if name == "forest" else regress.GBT_SPACE, 50)
    params, scores, edges, data = trees.staged_search(train, name, PRICE_X, "prix_m2", draws)
    if name == "forest":
        grown = trees.grow_forest(data, params["numTrees"], params["maxDepth"])
        pred = trees.forest_predict(trees.binned(test, PRICE_X, edges, "prix_m2").select("prix_m2", "x"), grown)
    else:
        pred = _final_gbt(train, test, params)
    m = regress.regression_metrics(pred, "prix_m2", "prediction")
    return m.withColumns({"model": F.lit(name), "params": F.lit(str(sorted(params.items()))), "cv_mae": F.lit(float(min(scores)))})


def q_search_forest(spark, sf_dir):
    return _search(spark, sf_dir, "forest")


def q_search_gbt(spark, sf_dir):
    return _search(spark, sf_dir, "gbt")


def q_forecast_early_stop(spark, sf_dir):
    """J9 with early stopping, against the two naive forecasts."""
    p = supplier_panel(spark, sf_dir)
    pred, _ = forecast.forecast_with_early_stopping(p, "station", "date", PANEL_TARGET, TEST_START)
    pred = pred.withColumn("station", F.col("station").cast("string"))
    return forecast.compare_with_baselines(pred, p, "station", "date", PANEL_TARGET)


def q_forecast_gbt(spark, sf_dir):
    p = supplier_panel(spark, sf_dir)
    pred, _ = forecast.forecast_station_prices(p, "station", "date", PANEL_TARGET, TEST_START, n_lags=12, model="gbt")
    return forecast.compare_with_baselines(pred, p, "station", "date", PANEL_TARGET)


# ---------------------------------------------------------------------------
# Coverage (F14-F16)
# ---------------------------------------------------------------------------


def q_coverage_report(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    e = causal.enriched_sales(inp)
    return rounded(enrich.missing_share(e, ["lon", "lat", "taux", "revenu_median_2021", "station_id"]))


def q_station_kind_counts(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return causal.all_stations(inp).groupBy("is_grand_paris").agg(F.count(F.lit(1)).alias("n"))


def q_distinct_stations(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    e = causal.enriched_sales(inp)
    return e.select("station_id").where(F.col("station_id").isNotNull()).distinct()


QUERIES = {
    "dml_linear": q_dml_linear,
    "dml_by_station_linear": q_dml_by_station_linear,
    "dml_forest": q_dml_forest,
    "dml_by_station_forest": q_dml_by_station_forest,
    "station_month_features": q_station_month_features,
    "station_month_features_all": q_station_month_features_all,
    "station_month_features_mode": q_station_month_features_mode,
    "station_month_modes": q_station_month_modes,
    "chrono_split": q_chrono_split,
    "date_split": q_date_split,
    "last_n_split": q_last_n_split,
    "positional_split": q_positional_split,
    "sequences_single": q_sequences_single,
    "sequences_multi": q_sequences_multi,
    "prediction_window": q_prediction_window,
    "select_new_within": q_select_new_within,
    "select_one_station": q_select_one_station,
    "station_codes": q_station_codes,
    "prediction_input": q_prediction_input,
    "predict_selected": q_predict_selected,
    "last_horizon_actuals": q_last_horizon_actuals,
    "assemble_frames": q_assemble_frames,
    "scale_inverse": q_scale_inverse,
    "preprocess": q_preprocess,
    "station_inputs": q_station_inputs,
    "encode_table": q_encode_table,
    "scale_standard": q_scale_standard,
    "scale_robust": q_scale_robust,
    "scale_minmax": q_scale_minmax,
    "ordinal_encode": q_ordinal_encode,
    "one_hot": q_one_hot,
    "regression_metrics": q_regression_metrics,
    "search_forest": q_search_forest,
    "search_gbt": q_search_gbt,
    "forecast_gbt": q_forecast_gbt,
    "forecast_early_stop": q_forecast_early_stop,
    "feature_panel": q_feature_panel,
    "predict_bundle": q_predict_bundle,
    "coverage_report": q_coverage_report,
    "station_kind_counts": q_station_kind_counts,
    "distinct_stations": q_distinct_stations,
}
