"""Cleaning operators.

Each is a narrow transformation (projection + filter), so it pipelines into
the scan in one whole-stage-codegen span and never shuffles, except the two
dimension-table steps that need an order (station ids, first-per-key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numeric import safe_ratio
from ..sources.readers import REGISTER_COLUMNS
from .splits import global_positions

# Fixed values of the reference's filters.
RESIDENTIAL_TYPES = ["Appartement", "Maison"]
ORDINARY_SALES = ["Vente", "Vente en l'état futur d'achèvement"]
EXCLUDED_MODES_PATTERN = "VAL|TRAM|TRAMWAY|TRAIN"
EXISTING_DROP_COLUMNS = [
    "Geo Shape", "nom_so_gar", "nom_su_gar", "id_ref_ZdC", "id_ref_ZdA",
    "tertrain", "terrer", "termetro", "tertram", "terval", "exploitant",
    "principal", "x", "y", "picto ligne", "nom_long", "nom_ZdC",
    "nom_ZdA", "iderflag", "indice_lig", "mode", "idf", "iderligc",
]
NEW_STATION_ID_BASE = 100000

SALES_CLEAN_COLUMNS = [
    "date_mutation", "annee", "mois", "nature_mutation", "type_local", "valeur_fonciere",
    "surface", "prix_m2", "rooms", "no_voie", "type_voie", "voie", "code_postal",
    "commune", "code_departement", "code_commune", "code_ville",
]


def clean_sales(
    df: DataFrame,
    min_value: float = 1000.0,
    surface_range: tuple = (8.0, 200.0),
    max_rooms: float = 10.0,
    price_range: tuple = (1000.0, 13000.0),
    keep_extra=("sale_id",),
) -> DataFrame:
    """Transaction cleaner: parse numbers and dates (B2-B5), keep residential
    ordinary sales (C1, C2), drop anomalies (C3, C4), price per m² (B11),
    commune codes (B12-B15). Bounds are strict; nulls fail them."""
    value = tx.parse_fr_number("valeur_fonciere")
    surface = tx.parse_fr_number("surface")
    rooms = tx.nan_to_null(F.col("rooms").cast("string").try_cast("double"))
    date = tx.parse_date_strict("date_mutation")
    parsed = df.select(
        *[c for c in keep_extra if c in df.columns],
        date.alias("date_mutation"),
        F.col("nature_mutation"),
        F.col("type_local"),
        value.alias("valeur_fonciere"),
        surface.alias("surface"),
        rooms.alias("rooms"),
        "no_voie", "type_voie", "voie", "code_postal", "commune", "code_departement", "code_commune",
    )
    price = safe_ratio("valeur_fonciere", "surface")
    kept = parsed.where(
        F.col("type_local").isin(RESIDENTIAL_TYPES)
        & F.col("nature_mutation").isin(ORDINARY_SALES)
        & (F.col("valeur_fonciere") > min_value)
        & (F.col("surface") > surface_range[0])
        & (F.col("surface") < surface_range[1])
        & (F.col("rooms") < max_rooms)
        & (price > price_range[0])
        & (price < price_range[1])
    )
    commune = tx.lower_trim("commune")
    dept = tx.zero_pad("code_departement", 2)
    code_commune = tx.zero_pad(tx.paris_commune_code(commune, F.col("code_commune")), 3)
    out = kept.select(
        *[c for c in keep_extra if c in df.columns],
        "date_mutation",
        F.year("date_mutation").alias("annee"),
        F.month("date_mutation").alias("mois"),
        "nature_mutation", "type_local", "valeur_fonciere", "surface",
        price.alias("prix_m2"),
        "rooms", "no_voie", "type_voie", "voie", "code_postal",
        commune.alias("commune"),
        dept.alias("code_departement"),
        code_commune.alias("code_commune"),
    )
    return out.withColumn("code_ville", F.concat("code_departement", "code_commune"))


def residential_only(df: DataFrame, col: str = "type_local") -> DataFrame:
    """C1 on its own (the refined cleaner)."""
    return df.where(F.col(col).isin(RESIDENTIAL_TYPES))


def drop_null_rows(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a null (or NaN) in ``subset`` (all columns if None)."""
    return df.na.drop(how="any", subset=subset)


def clean_register(df: DataFrame) -> DataFrame:
    """B1: the register keeps number, street, postcode, commune, lon, lat."""
    return df.select(*REGISTER_COLUMNS)


def clean_new_stations(df: DataFrame, id_base: int = NEW_STATION_ID_BASE) -> DataFrame:
    """New stations: geo point -> lat/lon (B7), yes/no (B9), dates (B6),
    line code (B10), ids from ``id_base`` in (name, lat, lon) order (B31),
    constant flag (B32), signature year (B5).

    Ids come from ``global_positions``: ranges of the order, numbered side by side.
    """
    lat, lon = tx.split_lat_lon("geo_point")
    base = df.select(
        F.col("nom_gare"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        tx.yes_no("interconnexion").alias("interconnexion"),
        tx.remove_spaces("lignes").alias("ligne_clean"),
        tx.parse_date_lenient("date_signature").alias("date_signature"),
        tx.parse_date_lenient("date_ouverture").alias("date_ouverture"),
    )
    order = [F.col(c).asc_nulls_last() for c in ("nom_gare", "latitude", "longitude", "ligne_clean", "date_signature")]
    return global_positions(base, order).select(
        *base.columns,
        (F.col("_pos") + id_base).cast("int").alias("id_gare"),
        F.lit(1).alias("is_grand_paris"),
        F.year("date_signature").alias("annee_signature"),
    )


def clean_existing_stations(df: DataFrame) -> DataFrame:
    """Existing stations: drop modes matching VAL/TRAM/TRAMWAY/TRAIN (null
    mode kept, C5), keep the region (C6), drop the listed columns if present
    (B29), order id, name, ..., geo point last (B30)."""
    excluded = F.coalesce(F.upper("mode").rlike(EXCLUDED_MODES_PATTERN), F.lit(False))
    kept = df.where(~excluded & (F.col("idf") == 1))
    kept = kept.drop(*[c for c in EXISTING_DROP_COLUMNS if c in kept.columns])
    middle = [c for c in kept.columns if c not in ("gares_id", "nom_iv", "geo_point")]
    return kept.select("gares_id", "nom_iv", *middle, "geo_point")


def existing_for_union(df: DataFrame) -> DataFrame:
    """Existing stations in the shared layout (rename + B7)."""
    lat, lon = tx.split_lat_lon("geo_point")
    return df.select(
        F.col("gares_id").cast("int").alias("id_gare"),
        F.col("nom_iv").alias("nom_gare"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.lit(0).alias("is_grand_paris"),
    )


STATION_UNION_COLUMNS = ["id_gare", "nom_gare", "latitude", "longitude", "is_grand_paris", "annee_signature"]


def merge_all_stations(new_stations: DataFrame, existing_stations: DataFrame) -> DataFrame:
    """New + existing stations, six shared columns; existing stations get
    a null signature year. Duplicates are kept."""
    new = new_stations.select(*STATION_UNION_COLUMNS)
    old = existing_stations.select(
        "id_gare", "nom_gare", "latitude", "longitude", "is_grand_paris",
        F.lit(None).cast("int").alias("annee_signature"),
    )
    return new.unionByName(old)


def assemble_frames(df1: DataFrame, df2: DataFrame, date_cols=()) -> DataFrame:
    """E2 + B28: listed date columns present on a side become plain dates
    (zone and time dropped), then a union by name where a column missing on
    one side is null."""

    def dates(df):
        present = {c: F.to_date(F.col(c)) for c in date_cols if c in df.columns}
        return df.withColumns(present) if present else df

    return dates(df1).unionByName(dates(df2), allowMissingColumns=True)


def dedupe_first(df: DataFrame, keys, order_cols) -> DataFrame:
    """one row per key, the first in the declared order.

    Written as an aggregate (``min_by`` over the order struct) rather than a
    ``row_number`` window, so rows are combined map-side before the shuffle
    and a hot key never lands whole in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    others = [c for c in df.columns if c not in keys]
    packed = F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(c) for c in order_cols]))
    out = df.groupBy(*keys).agg(packed.alias("_first"))
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in others]).select(*df.columns)


def clean_rates(df: DataFrame, date_col: str = "date", rate_col: str = "taux") -> DataFrame:
    """month floor, keep (date, rate), first row per month by the
    original date."""
    d = tx.parse_date_lenient(date_col)
    staged = df.select(d.alias("_orig"), F.trunc(d, "MM").alias("date"), F.col(rate_col).alias("taux"))
    staged = staged.where(F.col("date").isNotNull())
    return dedupe_first(staged, "date", ["_orig", "taux"]).select("date", "taux")


def clean_indicators(df: DataFrame) -> DataFrame:
    """B37 + B16b: code as text, folded commune name (fold, then strip)."""
    return df.withColumns({
        "code_ville": F.col("code_ville").cast("string"),
        "ville_norm": tx.fold_accents("ville", strip_first=False, null_as_empty=False),
    })


def station_subset(stations: DataFrame, id_col: str = "id_gare") -> DataFrame:
    """Id, name, latitude, longitude; when the id column is absent it is
    made from the declared order (name, latitude, longitude), 0-based, by ranges."""
    if id_col not in stations.columns:
        order = [F.col(c).asc_nulls_last() for c in ("nom_gare", "latitude", "longitude")]
        stations = global_positions(stations, order).withColumn(id_col, F.col("_pos").cast("int"))
    return stations.select(id_col, "nom_gare", "latitude", "longitude")
