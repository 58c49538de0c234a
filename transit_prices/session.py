"""Session helpers: a tuned builder for local runs and checkpoint handling.

On a cluster the session comes from the platform; nothing here overrides an
existing ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: adaptive execution (partition coalescing and
# skew-join splitting), UTC so that month truncation never shifts by a zone.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "transit_prices",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session for tests and the bench.

    ``master`` defaults to ``local[$BENCH_CPUS]`` or ``local[8]``.
    """
    if master is None:
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    for key, value in {**DEFAULT_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's ``spark.checkpoint.dir``; set ``fallback`` only when
    nothing is configured (local tests)."""
    current = checkpoint_dir(spark)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss).

    A session on this very machine gets a folder of its own if none is
    configured; on a cluster a machine-local folder is never chosen.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        folder = checkpoint_dir(spark)
        if not folder:
            master = spark.sparkContext.master
            if not (master == "local" or master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir is not set; cannot cut lineage")
            folder = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="transit-prices-ckpt-"))
        df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=eager)


def spread_rows(df: DataFrame, least_rows: int = 20_000, most_rows: int = 500_000) -> DataFrame:
    """A written-down table that many passes will read, in partitions of at most about ``most_rows`` rows,
    and one for each core if it has rows enough: what adaptive execution had coalesced by bytes
    would keep a few cores busy. Small tables stay as they are."""
    rows = df.count()
    wanted = max(-(-rows // most_rows), min(df.sparkSession.sparkContext.defaultParallelism, rows // least_rows))
    return df.repartition(wanted) if wanted > df.rdd.getNumPartitions() else df


def ship_package(spark: SparkSession) -> None:
    """Give every Python worker this package (once per application), so that
    functions passed to Spark find it wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_transit_prices_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="transit-prices-"), "transit_prices_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._transit_prices_shipped = True
