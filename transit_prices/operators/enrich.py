"""Enrichment joins and derived columns.

Dimension sides (rates by month, commune indicators, stations) are bounded
by construction; they are broadcast only after ``bounded_broadcast`` has
counted them, otherwise the join is left to the planner (sort-merge with
AQE skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.readers import INDICATOR_COLUMNS
from .clean import dedupe_first

DEFAULT_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the table is proven small (one count job on a
    dimension table); beyond the bound the planner picks a shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


# ---------------------------------------------------------------------------
# D1 geocoding
# ---------------------------------------------------------------------------

SALES_ADDRESS_COLUMNS = ["no_voie", "type_voie", "voie", "code_postal", "commune", "code_departement", "code_commune"]


def register_key(register: DataFrame, fold: bool = True) -> DataFrame:
    street = tx.fold_accents("nom_voie", strip_first=True, null_as_empty=False) if fold else F.col("nom_voie")
    return register.select(
        tx.address_key(F.col("numero").cast("string"), street, F.col("code_postal").cast("string")).alias("adresse_complete"),
        F.col("lon").cast("double").alias("lon"),
        F.col("lat").cast("double").alias("lat"),
    )


def geocode_sales(
    sales: DataFrame,
    register: DataFrame,
    register_fold: bool = True,
    dedupe_register: bool = False,
    drop_address: bool = True,
) -> DataFrame:
    """Inner equi-join of sales and register on the address key.

    Many-to-many: a key present k times in the register yields k rows per
    sale (``dedupe_register=True`` keeps one point per key instead: the
    smallest (lon, lat)). The join is a shuffle join on the key; AQE splits a
    hot key's partition (an empty street gives keys such as ``' 75011'``)."""
    key = tx.sale_address_key("no_voie", "type_voie", "voie", "code_postal")
    left = sales.withColumn("adresse_complete", key)
    right = register_key(register, fold=register_fold).where(F.col("adresse_complete").isNotNull())
    if dedupe_register:
        right = right.groupBy("adresse_complete").agg(F.min(F.struct("lon", "lat")).alias("p")).select(
            "adresse_complete", "p.lon", "p.lat")
    out = left.join(right, "adresse_complete", "inner")
    drops = ["adresse_complete"] + (SALES_ADDRESS_COLUMNS if drop_address else [])
    return out.drop(*drops)


def address_keys(sales: DataFrame) -> DataFrame:
    """B17-B20 on their own: the sales-side key next to the sale id."""
    return sales.select("sale_id", tx.sale_address_key("no_voie", "type_voie", "voie", "code_postal").alias("adresse_complete"))


# ---------------------------------------------------------------------------
# Rates and indicators
# ---------------------------------------------------------------------------


def add_log_price(df: DataFrame, price_col: str = "prix_m2", out: str = "log_prix_m2") -> DataFrame:
    """B21 (prices are > 1000 after cleaning, so the log is defined)."""
    return df.withColumn(out, F.ln(price_col))


def add_month(df: DataFrame, date_col: str = "date_mutation", out: str = "date") -> DataFrame:
    """First day of the month."""
    return df.withColumn(out, F.trunc(F.col(date_col), "MM"))


def join_rates_month(df: DataFrame, rates: DataFrame, date_col: str = "date_mutation") -> DataFrame:
    """Monthly rate onto rows by month (left join; months are a bounded
    dimension, so the rate table is broadcast after a size check)."""
    with_month = df if "date" in df.columns and date_col == "date" else add_month(df, date_col, "date")
    return with_month.join(bounded_broadcast(rates.select("date", "taux")), "date", "left")


def join_rates_year_month(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Rate and its monthly / yearly changes by (annee, mois), left join."""
    r = rates.select(
        F.col("annee").cast("int").alias("annee"), F.col("mois").cast("int").alias("mois"),
        "taux", "variation_mom", "variation_yoy")
    left = df.withColumns({"annee": F.col("annee").cast("int"), "mois": F.col("mois").cast("int")})
    return left.join(bounded_broadcast(r), ["annee", "mois"], "left")


def join_indicators(df: DataFrame, indicators: DataFrame, dedupe: bool = False, order_col: str = "src_row") -> DataFrame:
    """D6 (``dedupe=False``: right side as is, a repeated code multiplies
    rows) and D7 (``dedupe=True``: first row per code in file order)."""
    right = indicators
    if dedupe:
        order = [order_col] if order_col in right.columns else [c for c in right.columns if c != "code_ville"]
        right = dedupe_first(right, "code_ville", order)
    right = right.select("code_ville", "departement", "ville", *INDICATOR_COLUMNS)
    return df.join(bounded_broadcast(right), "code_ville", "left")


def missing_share(df: DataFrame, columns) -> DataFrame:
    """share of nulls per column (one aggregate), plus their mean."""
    shares = [F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]
    agg = df.agg(*shares)
    mean = sum((F.col(c) for c in columns), F.lit(0.0)) / F.lit(float(len(columns)))
    return agg.withColumn("mean_missing", mean)


# ---------------------------------------------------------------------------
# Stations
# ---------------------------------------------------------------------------


def prepare_new_stations(stations: DataFrame, indicators: DataFrame) -> DataFrame:
    """D8 + B27 (+ B31): station -> city code and department via the folded
    city name (indicators de-duplicated on code first, so one name can still
    match several codes); the station's own department wins when present."""
    city = dedupe_first(clean_city(indicators), "code_ville", ["src_row"] if "src_row" in indicators.columns else ["ville_norm"])
    city = city.select("code_ville", F.col("ville_norm").alias("_vn"), F.col("departement").alias("_dept_ind"))
    g = stations.withColumn("ville_norm", tx.fold_accents("ville", strip_first=False, null_as_empty=False))
    g = g.join(bounded_broadcast(city), g.ville_norm == city._vn, "left")
    dept = F.coalesce(F.col("departement"), F.col("_dept_ind")) if "departement" in stations.columns else F.col("_dept_ind")
    return g.select(
        (F.col("id_gare") - F.lit(100000)).cast("int").alias("station_id"),
        "nom_gare", "latitude", "longitude", "ligne_clean",
        dept.cast("string").alias("departement"),
        "date_signature", "date_ouverture", "code_ville",
    )


def clean_city(indicators: DataFrame) -> DataFrame:
    return indicators.withColumn("ville_norm", tx.fold_accents("ville", strip_first=False, null_as_empty=False))


def existing_only(all_stations: DataFrame, new_stations: DataFrame, name_col: str = "nom_gare") -> DataFrame:
    """All stations minus the new ones, by name (left anti join)."""
    return all_stations.join(new_stations.select(name_col).distinct(), name_col, "left_anti")


# ---------------------------------------------------------------------------
# Derived columns
# ---------------------------------------------------------------------------


def relative_years(df: DataFrame, date_col: str = "date_mutation") -> DataFrame:
    """Sale year minus signature / opening year (null-propagating)."""
    return df.withColumns({
        "relative_signature": F.year(date_col) - F.year("date_signature"),
        "relative_opening": F.year(date_col) - F.year("date_ouverture"),
    })


def proximity_flags(df: DataFrame, radius_km: float = 1.0, new_col: str = "distance_gp_km",
                    hist_col: str = "distance_hist_km") -> DataFrame:
    """Null-safe ``distance <= radius`` flags, plus the 0/1 treatment."""
    out = df
    if new_col in df.columns:
        out = out.withColumn("is_gp", F.coalesce(F.col(new_col) <= radius_km, F.lit(False)))
        out = out.withColumn("d_gp", F.col("is_gp").cast("int"))
    if hist_col in df.columns:
        out = out.withColumn("is_hist", F.coalesce(F.col(hist_col) <= radius_km, F.lit(False)))
    return out


def new_station_flag(df: DataFrame, max_years: int = 5, radius_km: float = 1.0,
                     min_years: int | None = None) -> DataFrame:
    """``relative_opening <= 5`` and ``distance < 1``, only if both
    columns exist; null -> 0. ``min_years`` adds an optional lower bound."""
    if not {"relative_opening", "distance_gare_km"}.issubset(df.columns):
        return df
    cond = (F.col("relative_opening") <= max_years) & (F.col("distance_gare_km") < radius_km)
    if min_years is not None:
        cond = cond & (F.col("relative_opening") >= min_years)
    return df.withColumn("is_new_gare", F.coalesce(cond, F.lit(False)).cast("int"))
