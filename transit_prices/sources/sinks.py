"""Sinks (A8-A13): result tables written by Spark's own writers to any
Hadoop URI (local path, HDFS, object store); nothing passes through the
driver except one-row results that are already there.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_results_json(result: DataFrame, uri: str) -> None:
    """Effect results as JSON (one-row or per-station table); parent
    folders are created by the writer."""
    result.coalesce(1).write.mode("overwrite").json(uri)


def append_metrics(metrics: DataFrame, uri: str, model: str, station: str | None = None, run_id: str | None = None) -> None:
    """Metrics rows added to a Parquet table partitioned by model (and station when
    given) and run. A run written again, say by a retried job, replaces its own rows
    only; without ``run_id`` every call is a run of its own."""
    out = metrics.withColumn("model", F.lit(model))
    parts = ["model"]
    if station is not None:
        out = out.withColumn("station", F.lit(str(station)))
        parts.append("station")
    _replace(out.withColumn("run_id", F.lit(run_id or uuid.uuid4().hex)), uri, [*parts, "run_id"])


def _replace(rows: DataFrame, uri: str, parts: list[str]) -> None:
    """Write the rows' own partitions anew; all others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(uri)


def write_comparison(pred: DataFrame, uri: str, partition_cols=("model", "station")) -> None:
    """A10: (date, y_true, y_pred) per model x station, partitioned so that
    each pair is one folder; rewriting a pair replaces only its folder."""
    cols = [c for c in partition_cols if c in pred.columns]
    (pred.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).option("header", True).csv(uri))


REGISTRY_SCHEMA = T.StructType([
    T.StructField("model_type", T.StringType()), T.StructField("r2", T.DoubleType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("run_id", T.StringType()),
])


def register_run(spark: SparkSession, uri: str, model_type: str, params: dict, metrics: dict,
                 run_date: _dt.date | None = None, run_id: str | None = None) -> DataFrame:
    """One row (type, R², date, params, metrics) added to a registry table; the
    reference's file name carries the same three keys, and so does the default run id. A
    run registered again replaces its row."""
    r2, run_date = float(metrics.get("r2", float("nan"))), run_date or _dt.date.today()
    row = (model_type, r2, run_date, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()},
           run_id or f"{model_type}_{r2:.4f}_{run_date.isoformat()}")
    df = spark.createDataFrame([row], REGISTRY_SCHEMA)
    _replace(df, uri, ["run_id"])
    return df


def save_scaler(params: DataFrame, uri: str) -> None:
    """Fitted scaler parameters (a one-row table) saved for scoring."""
    params.coalesce(1).write.mode("overwrite").parquet(uri)


def load_scaler(spark: SparkSession, uri: str) -> DataFrame:
    """A13."""
    return spark.read.parquet(uri)
