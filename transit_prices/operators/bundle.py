"""Saved forecasters (J10, A11-A13): everything that scoring needs, in one folder.

A bundle holds the feature list, target, window length and horizon (``meta``), the scaler's
parameters (``scaler``) and one Spark ML model per step (``step_1`` ...). A registry table
(``sinks.register_run``) tells where the newest bundle of a kind lies. Scoring checks the
panel's columns first, so a missing feature fails before any job runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from ..sources.readers import require_columns
from . import features, forecast

META = "features array<string>, target string, n_steps int, horizon int"


@dataclass
class Bundle:
    features: list[str]
    target: str
    n_steps: int
    horizon: int
    scaler: DataFrame  # one row: centre and scale per feature
    models: dict  # step -> fitted model

    def windows(self, panel: DataFrame, station_col: str, date_col: str) -> DataFrame:
        """Scaled windows of the panel; the targets stay as they are."""
        require_columns(panel, [station_col, date_col, self.target, *self.features], "panel")
        rows = features.apply_scaler(panel.withColumn("_y", F.col(self.target).cast("double")), self.scaler, self.features)
        return forecast.direct_windows(rows, station_col, date_col, "_y", self.features, self.n_steps, self.horizon)

    def score(self, panel: DataFrame, station_col: str, date_col: str) -> DataFrame:
        """Rows (station, origin, step, y_pred, y_true) for every full window."""
        return forecast.score_direct(self.models, self.windows(panel, station_col, date_col), station_col)


def fit_bundle(train: DataFrame, station_col: str, date_col: str, feature_cols, target: str, n_steps: int, horizon: int, regressor=None) -> Bundle:
    """Scaler (min-max) and one model per step, both from the rows of ``train`` only."""
    feature_cols = list(feature_cols)
    out = Bundle(feature_cols, target, n_steps, horizon, features.fit_scaler(train, feature_cols, "minmax"), {})
    out.models = forecast.fit_direct(out.windows(train, station_col, date_col), horizon, regressor)
    return out


def save_bundle(spark: SparkSession, bundle: Bundle, uri: str, registry: str | None = None, kind: str = "direct", metrics: dict | None = None, run_id: str | None = None) -> None:
    """Write the bundle and, if ``registry`` is given, register it."""
    row = (bundle.features, bundle.target, bundle.n_steps, bundle.horizon)
    spark.createDataFrame([row], META).coalesce(1).write.mode("overwrite").parquet(f"{uri}/meta")
    sinks.save_scaler(bundle.scaler, f"{uri}/scaler")
    for step, model in bundle.models.items():
        forecast.save_model(model, f"{uri}/step_{step}")
    if registry:
        sinks.register_run(spark, registry, kind, {"uri": uri}, metrics or {}, run_id=run_id)


def load_bundle(spark: SparkSession, uri: str) -> Bundle:
    from pyspark.ml.util import DefaultParamsReader

    meta = spark.read.parquet(f"{uri}/meta").first()
    models = {k: DefaultParamsReader.loadParamsInstance(f"{uri}/step_{k}", spark) for k in range(1, meta["horizon"] + 1)}
    return Bundle(list(meta["features"]), meta["target"], meta["n_steps"], meta["horizon"], sinks.load_scaler(spark, f"{uri}/scaler"), models)


def newest_bundle(spark: SparkSession, registry: str, kind: str = "direct") -> Bundle:
    """The bundle registered last under ``kind`` (by date, then run id)."""
    found = spark.read.parquet(registry).where(F.col("model_type") == kind).agg(F.max(F.struct("run_date", "run_id", F.col("params")["uri"].alias("uri"))).alias("x")).first()["x"]
    if found is None:
        raise ValueError(f"no {kind} model is registered in {registry}")
    return load_bundle(spark, found["uri"])
