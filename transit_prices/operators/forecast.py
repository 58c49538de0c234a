"""Station price forecasting (J9, J10, J12, J13), re-aimed.

The reference trains one recurrent network per station on a single machine.
Here the same sliding windows (G1) become lag-feature vectors, and one
distributed regressor (gradient-boosted trees by default) is trained over
all stations at once with the station one-hot encoded (for boosted trees
without a column of its own, see ``boosted``); it is scored per station
against two naive baselines (last value, same month last year).
Multi-step horizons use direct models (one per step). Fitted pipelines are
saved and loaded with Spark ML's own writer, to any Hadoop URI.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, spread_rows
from .boosted import fit_boosted
from .regress import regression_metrics


def lag_features(panel: DataFrame, station_col: str, date_col: str, target_col: str, n_lags: int,
                 extra_cols=(), horizon_step: int = 1) -> DataFrame:
    """Lags 1..n of the target (and of ``extra_cols``) per station, plus the
    label ``horizon_step`` rows ahead; rows without a full history or label
    are dropped (G1 flattened)."""
    w = Window.partitionBy(station_col).orderBy(date_col)
    cols = {f"{target_col}_lag{k}": F.lag(target_col, k).over(w) for k in range(1, n_lags + 1)}
    for c in extra_cols:
        cols.update({f"{c}_lag{k}": F.lag(c, k).over(w) for k in range(1, n_lags + 1)})
    out = panel.withColumns(cols).withColumn("label", F.lead(target_col, horizon_step - 1).over(w))
    return out.na.drop(subset=list(cols) + ["label"])


def forecast_station_prices(
    panel: DataFrame,
    station_col: str,
    date_col: str,
    target_col: str,
    test_start,
    n_lags: int = 12,
    model: str = "gbt",
    extra_cols=(),
    seed: int = 42,
    max_iter: int = 50,
):
    """Fit on rows before ``test_start``, predict the rest. Returns
    (predictions: station, date, y_true, y_pred; fitted pipeline)."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.regression import LinearRegression, RandomForestRegressor

    data = lag_features(panel, station_col, date_col, target_col, n_lags, extra_cols)
    # boosting reads it for the edges, the trees and the scores
    data = cut_lineage(data) if model == "gbt" else data.persist()
    lag_cols = [c for c in data.columns if "_lag" in c]
    start = F.to_date(F.lit(str(test_start)))
    train = data.where(F.col(date_col) < start)
    test = data.where(F.col(date_col) >= start)
    idx = StringIndexer(inputCol=station_col, outputCol="_st_idx", handleInvalid="keep",
                        stringOrderType="alphabetAsc")
    train = train.withColumn(station_col, F.col(station_col).cast("string"))
    if model == "gbt":
        # a split on one station needs no column of its own
        codes = idx.fit(train)
        fitted = PipelineModel([codes, fit_boosted(codes.transform(train), lag_cols, "_st_idx", "label", max_iter, seed=seed)])
    else:
        ohe = OneHotEncoder(inputCol="_st_idx", outputCol="_st_oh", handleInvalid="keep")
        asm = VectorAssembler(inputCols=lag_cols + ["_st_oh"], outputCol="features")
        reg = RandomForestRegressor(labelCol="label", numTrees=100, maxDepth=8, seed=seed) if model == "forest" else LinearRegression(labelCol="label")
        fitted = Pipeline(stages=[idx, ohe, asm, reg]).fit(train)
    pred = fitted.transform(test.withColumn(station_col, F.col(station_col).cast("string")))
    out = pred.select(F.col(station_col), F.col(date_col), F.col("label").alias("y_true"),
                      F.col("prediction").alias("y_pred"), F.lit(model).alias("model"))
    return out, fitted


def best_round(losses: list[float], patience: int) -> int:
    """Early stopping: the round (from 1) with the least loss before the first run of
    ``patience`` rounds without a better one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


@dataclass
class FirstTrees:
    """The first ``getNumTrees`` trees of a boosted model, as a model."""

    model: object
    getNumTrees: int  # as Spark ML names it

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the sum of the trees as ``prediction``."""
        total, names = F.lit(0.0), [f"_tree{i}" for i in range(self.getNumTrees)]
        for name, tree, weight in zip(names, self.model.trees, self.model.treeWeights):
            rows = tree.setFeaturesCol("features").setPredictionCol(name).transform(rows)
            total = total + F.lit(float(weight)) * F.col(name)
        return rows.withColumn("prediction", total).drop(*names)


def forecast_with_early_stopping(panel: DataFrame, station_col: str, date_col: str, target_col: str, test_start, n_lags: int = 12,
                                 validation_share: float = 0.2, patience: int = 30, max_rounds: int = 200, step: float = 0.1, depth: int = 5, seed: int = 42):
    """J9 with early stopping and the best round restored. Targets are min-max scaled per
    station by its rows before the validation months (I3), and the model learns the change from the
    last month, so a trend goes on. The last ``validation_share`` of the months before ``test_start``
    validate. Boosting is sequential and seeded: the fit with the best round's number of
    rounds is the long fit cut there, so its first trees are the model. Returns (predictions, facts:
    best round, losses, model)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    start = F.to_date(F.lit(str(test_start)))
    months = sorted(r[0] for r in panel.where(F.col(date_col) < start).select(date_col).distinct().collect())  # a number of months
    validate_from = F.lit(months[min(len(months) - 1, int(len(months) * (1 - validation_share)))])
    seen = panel.where(F.col(date_col) < validate_from)
    limits = seen.groupBy(station_col).agg(F.min(target_col).alias("_low"), F.max(target_col).alias("_high"))
    width = F.when(F.col("_high") > F.col("_low"), F.col("_high") - F.col("_low")).otherwise(F.lit(1.0))
    scaled = panel.join(limits, station_col).withColumn("_width", width).withColumn("_y", (F.col(target_col) - F.col("_low")) / F.col("_width"))
    data = lag_features(scaled, station_col, date_col, "_y", n_lags)
    last = F.col("_y_lag1")
    data = data.withColumn("_last", last).withColumns({f"_x{k}": F.col(f"_y_lag{k}") - last for k in range(2, n_lags + 1)}).withColumn("_change", F.col("label") - last)
    inputs = [f"_x{k}" for k in range(2, n_lags + 1)] + ["_last"]
    data = VectorAssembler(inputCols=inputs, outputCol="features").transform(data).select(
        station_col, date_col, "features", "_change", "_last", "_low", "_width", target_col)
    data = spread_rows(cut_lineage(data)).persist()  # read by all rounds and two scorings
    train = data.where(F.col(date_col) < validate_from)
    valid = data.where((F.col(date_col) >= validate_from) & (F.col(date_col) < start))
    make = lambda rounds: GBTRegressor(labelCol="_change", maxIter=rounds, stepSize=step, maxDepth=depth, seed=seed)
    long = make(max_rounds).fit(train)
    losses = list(long.evaluateEachIteration(valid, "squared"))
    rounds = best_round(losses, patience)
    model = FirstTrees(long, rounds)
    test = model.transform(data.where(F.col(date_col) >= start))
    pred = (F.col("_last") + F.col("prediction")) * F.col("_width") + F.col("_low")
    out = test.select(station_col, date_col, F.col(target_col).alias("y_true"), pred.alias("y_pred"), F.lit("gbt").alias("model"))
    return out, {"best_round": rounds, "losses": losses, "model": model}


def direct_windows(panel: DataFrame, station_col: str, date_col: str, target_col: str, feature_cols, n_steps: int,
                   horizon: int) -> DataFrame:
    """Rows (station, origin, features, y1..yh): the last ``n_steps`` rows up to and
    including the origin as one vector, and the targets 1..h rows later (null where
    not known yet, so the newest window can be scored)."""
    from pyspark.ml.functions import array_to_vector

    w = Window.partitionBy(station_col).orderBy(date_col)
    past = w.rowsBetween(1 - n_steps, 0)
    flat = F.flatten(F.collect_list(F.array(*[F.col(c).cast("double") for c in feature_cols])).over(past))
    ahead = [F.lead(target_col, k).over(w).cast("double").alias(f"y{k}") for k in range(1, horizon + 1)]
    rows = panel.select(station_col, F.col(date_col).alias("origin"), flat.alias("_x"), *ahead)
    full = rows.where(F.size("_x") == n_steps * len(feature_cols))
    return full.withColumn("features", array_to_vector("_x")).drop("_x")


def fit_direct(windows: DataFrame, horizon: int, regressor=None) -> dict:
    """One model per step, each fitted on the windows whose target is known."""
    from pyspark.ml.regression import LinearRegression

    make = regressor or (lambda: LinearRegression(labelCol="label", regParam=0.1, solver="normal"))
    return {k: make().fit(windows.where(F.col(f"y{k}").isNotNull()).withColumn("label", F.col(f"y{k}")))
            for k in range(1, horizon + 1)}


def score_direct(models: dict, windows: DataFrame, station_col: str) -> DataFrame:
    """Long rows (station, origin, step, y_pred, y_true); y_true is null for
    months not seen yet."""
    scored = windows
    for k, model in models.items():
        scored = model.setPredictionCol(f"p{k}").transform(scored)
    steps = F.array(*[F.struct(F.lit(k).alias("step"), F.col(f"p{k}").alias("y_pred"), F.col(f"y{k}").alias("y_true"))
                      for k in models])
    return scored.select(station_col, "origin", F.explode(steps).alias("_s")).select(station_col, "origin", "_s.*")


def compare_with_baselines(pred: DataFrame, panel: DataFrame, station_col: str, date_col: str, target_col: str):
    """J8 by station for the model and the two naive baselines over the same
    test rows."""
    from .regress import naive_forecasts

    base = naive_forecasts(panel, station_col, date_col, target_col).withColumn(
        station_col, F.col(station_col).cast("string"))
    j = pred.join(base.drop(target_col), [station_col, date_col], "left")
    parts = []
    for name, col in (("model", "y_pred"), ("last_value", "pred_last"), ("year_ago", "pred_year_ago")):
        parts.append(regression_metrics(j, "y_true", col, [station_col]).withColumn("forecaster", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def save_model(model, uri: str) -> None:
    """Write a fitted pipeline (any Hadoop URI, overwrite)."""
    model.write().overwrite().save(uri)


def load_model(uri: str):
    """A11/A13."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(uri)


def score_saved_model(uri: str, panel: DataFrame, station_col: str, date_col: str, target_col: str,
                      n_lags: int = 12, extra_cols=()) -> DataFrame:
    """Load a saved pipeline and score the latest windows."""
    model = load_model(uri)
    data = lag_features(panel, station_col, date_col, target_col, n_lags, extra_cols).withColumn(
        station_col, F.col(station_col).cast("string"))
    pred = model.transform(data)
    return pred.select(station_col, date_col, F.col("label").alias("y_true"), F.col("prediction").alias("y_pred"))


def pred_vs_true(pred: DataFrame, date_col: str = "date") -> DataFrame:
    """The table behind the comparison plot, ordered by date."""
    return pred.select(date_col, "y_true", "y_pred", *[c for c in pred.columns if c not in (date_col, "y_true", "y_pred")]) \
        .orderBy(date_col)
