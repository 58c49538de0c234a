"""Readers for the domain feeds (A1-A7, A14) and the source-header mapping.

Every CSV column is read as text with an explicit schema (no inference, which
would scan the data twice) and cast later with ``try_*`` expressions. Header
names of the original feeds carry spaces and accents; they are mapped once,
here, to ASCII snake_case.
"""

from __future__ import annotations

import csv

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source headers of the property-transaction feed -> internal names.
SALES_HEADERS = {
    "Date mutation": "date_mutation",
    "Nature mutation": "nature_mutation",
    "Type local": "type_local",
    "Nombre pieces principales": "rooms",
    "Surface reelle bati": "surface",
    "Valeur fonciere": "valeur_fonciere",
    "No voie": "no_voie",
    "Type de voie": "type_voie",
    "Voie": "voie",
    "Code postal": "code_postal",
    "Commune": "commune",
    "Code departement": "code_departement",
    "Code commune": "code_commune",
}

# New-station feed headers -> internal names (B8 renames, then lower-case).
NEW_STATION_HEADERS = {
    "Geo Point": "geo_point",
    "LIBELLE": "nom_gare",
    "CONNEX": "interconnexion",
    "LIGNE": "lignes",
    "Date de signature": "date_signature",
    "Date ouverture officielle": "date_ouverture",
}

# Commune-indicator headers -> internal names.
INDICATOR_HEADERS = {
    "Code ville": "code_ville",
    "Département": "departement",
    "Ville": "ville",
    "Revenu médian 2021": "revenu_median_2021",
    "Évol. annuelle moy. de la population 2016-2022": "evo_population_2016_2022",
    "Part proprio en rés. principales 2022": "part_proprio_2022",
    "Part locataires HLM dans les rés. principales 2022": "part_hlm_2022",
    "Part cadres sup. 2022": "part_cadres_2022",
    "Part logements vacants 2022": "part_log_vacants_2022",
    "Taux de chômage annuel moyen 2024": "taux_chomage_2024",
    "Part des élèves du privé parmi les élèves du second degré 2024": "part_eleves_prive_2024",
    "Nombre d'établissements 2023": "nb_etablissements_2023",
}

INDICATOR_COLUMNS = [v for v in INDICATOR_HEADERS.values() if v not in ("code_ville", "departement", "ville")]

REGISTER_COLUMNS = ["numero", "nom_voie", "code_postal", "nom_commune", "lon", "lat"]


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def rename_columns(df: DataFrame, mapping: dict, lower: bool = True) -> DataFrame:
    """Rename by mapping, then lower-case every name."""
    out = df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
    if lower:
        out = out.toDF(*[c.lower() for c in out.columns])
    return out


def require_columns(df: DataFrame, columns, what: str = "input") -> DataFrame:
    """Fail fast (schema check only, no job) when columns are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"Missing columns in {what}: {missing}")
    return df


def read_csv(
    spark: SparkSession,
    path: str,
    columns,
    sep: str = ",",
    on_error: str = "raise",
) -> DataFrame:
    """A1/A2/A3: one delimited file (or glob), header row, all columns text.

    ``on_error='empty'`` reproduces the fail-soft loader: an unreadable path
    gives an empty table with the same schema instead of an exception.
    """
    schema = string_schema(columns)
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .schema(schema)
    )
    try:
        df = reader.csv(path)
        if on_error == "empty":
            df.schema  # resolve the path now, so a missing file is caught here
        return df
    except Exception:
        if on_error == "empty":
            return spark.createDataFrame([], schema)
        raise


def csv_files(spark: SparkSession, folder: str, sep: str = ";") -> DataFrame:
    """Rows (path, header, status) of the ``*.csv`` files under a folder: header names
    in order; status 'ok', 'empty' (no name in the first line) or 'unreadable' (listed, but no task could
    read a line of it). Files of no bytes are not listed.

    Lazy, and one scan for all files, by Spark's own reader, so any store that Spark reads will do: the first line
    is the one with the least row number in the split that starts the file. Tasks keep one line a file
    before the shuffle; the number of jobs does not grow with the files."""
    def scan(form: str) -> DataFrame:
        options = {"pathGlobFilter": "*.csv", "recursiveFileLookup": True, "ignoreCorruptFiles": True, "ignoreMissingFiles": True}
        return spark.read.format(form).options(**options).load(folder)

    # the content column is not read
    listed = scan("binaryFile").where("length > 0").select("path", F.col("_metadata.file_path").alias("_file"))
    lines = scan("text").select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_nth"))
    first = lines.where("_start = 0").groupBy("_file").agg(F.min_by("value", "_nth").alias("_line"))

    @F.pandas_udf("array<string>")
    def names(found: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else next(csv.reader([x.lstrip("\ufeff")], delimiter=sep), []) for x in found], dtype=object)

    status = F.when(F.col("_line").isNull(), "unreadable").when(F.size("header") > 0, "ok").otherwise("empty")
    return listed.join(first, "_file", "left").withColumn("header", names("_line")).select("path", "header", status.alias("status"))


def read_csv_folder(spark: SparkSession, folder: str, columns, sep: str = ";", files: DataFrame | None = None) -> DataFrame:
    """Every ``*.csv`` under a folder, stacked by column name; other files
    are ignored. Files may have more columns, fewer, or another order: each set of files
    with one header is one scan, and what a file lacks is null. Files without a line
    or that cannot be read are left out; ``csv_files`` lists them."""
    columns = list(columns)
    files = files if files is not None else csv_files(spark, folder, sep)
    # one row per distinct header; the paths are the listing that each scan needs on the driver
    groups = files.where("status = 'ok'").groupBy("header").agg(F.array_sort(F.collect_list("path")).alias("paths")).collect()
    out = spark.createDataFrame([], string_schema(columns))
    for header, paths in sorted((list(r["header"]), list(r["paths"])) for r in groups):
        # positions name the columns, so repeated header names do no harm
        names = [f"_{i}" for i in range(len(header))]
        read = spark.read.option("header", True).option("sep", sep).option("enforceSchema", True).schema(string_schema(names)).csv(paths)
        out = out.unionByName(read.select(*(
            F.col(names[header.index(c)]).alias(c) if c in header else F.lit(None).cast("string").alias(c) for c in columns)))
    return out


def read_prepared(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A prepared table (e.g. the enriched sales written once as
    Parquet); the stray pandas index column is dropped if present."""
    df = spark.read.format(fmt).options(**options).load(path)
    return df.drop("Unnamed: 0", "_c0")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver tables: one Parquet file per table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a table whose scan yields fewer splits than the cluster has
    cores (one small file = one row group = one task) before CPU-heavy
    work. Decided at planning time from the scan's split count (no job);
    on large inputs, which already have many splits, it adds nothing."""
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)
