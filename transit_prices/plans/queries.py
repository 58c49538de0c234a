"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of SURVEY §2 / §7.3, each run over the whole driver tables.

Double outputs are rounded to ``DIGITS`` places (sums run in a different
order in the oracle engine); the oracle SQL in ``checks.oracle_sql`` rounds
the same columns.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..operators import clean, did, enrich, geo, panel, report
from ..sources import adapters
from ..sources.readers import read_table
from . import causal

DIGITS = 6

# Year window of the dashboard on the driver data (the reference shows
# 2014-2025 on real data; driver sales span 1995-2001).
DASHBOARD_YEARS = (1996, 2000)


def round_binary(col, digits: int = DIGITS):
    """Round half away from zero on the binary value of ``x * 10^d`` (the
    rule of most SQL engines); Spark's ``round(x, d)`` rounds the printed
    decimal instead, which differs on exact ties such as 131847.3 / 64."""
    scale = float(10 ** digits)
    return F.round(col * F.lit(scale)) / F.lit(scale)


def rounded(df: DataFrame, digits: int = DIGITS, per_column: dict | None = None) -> DataFrame:
    """Round every double column (float noise differs between engines);
    ``per_column`` overrides the places for wide-range columns."""
    per_column = per_column or {}
    return df.select(*[
        round_binary(F.col(f.name), per_column.get(f.name, digits)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def _inputs(spark: SparkSession, sf_dir: str) -> causal.Inputs:
    return causal.load_inputs(spark, sf_dir)


# ---------------------------------------------------------------------------
# Dashboard (minimum slice)
# ---------------------------------------------------------------------------


def q_commune_year_prices(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return rounded(report.commune_year_prices(inp.sales, inp.communes, DASHBOARD_YEARS))


def q_price_quantiles(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    table = report.commune_year_prices(inp.sales, inp.communes, DASHBOARD_YEARS)
    return rounded(report.price_quantiles(table))


def q_mean_by_dimension(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return rounded(report.mean_by_dimension(inp.sales, "commune"))


# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------


def q_clean_sales(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return rounded(inp.sales.drop("order_key"))


def q_clean_new_stations(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return rounded(inp.new_stations)


def q_clean_existing_stations(spark, sf_dir):
    return clean.clean_existing_stations(adapters.existing_stations_raw(spark, sf_dir))


def q_station_union(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return rounded(causal.all_stations(inp))


def q_fold_accents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.fold_accents("text", strip_first=True).alias("folded"))


def q_rates_month(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return rounded(inp.rates)


# ---------------------------------------------------------------------------
# Geocoding and nearest joins
# ---------------------------------------------------------------------------


def q_address_key(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return enrich.address_keys(inp.sales)


def q_geocode_sales(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    g = enrich.geocode_sales(inp.sales, inp.register)
    return rounded(g.select("sale_id", "code_ville", "prix_m2", "lon", "lat"))


def q_nearest_station(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    stations = causal.prepared_new_stations(inp)
    g = enrich.geocode_sales(inp.sales, inp.register).select("sale_id", "lat", "lon")
    out = geo.attach_nearest(g, "lat", "lon", stations, "latitude", "longitude", "station_id", "gp")
    return rounded(out)


def q_nearest_station_attrs(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    stations = causal.prepared_new_stations(inp)
    g = enrich.geocode_sales(inp.sales, inp.register).select("sale_id", "lat", "lon")
    out = geo.nearest_station_with_attrs(g, stations, id_col="station_id")
    return rounded(out)


def q_nearest_address(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    out = geo.nearest_address(inp.new_stations, inp.register)
    return rounded(out.select("id_gare", "nom_gare", "code_postal", "ville", "departement", "address_distance_km"))


def q_station_city_codes(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return rounded(causal.prepared_new_stations(inp))


# ---------------------------------------------------------------------------
# Enrichment joins
# ---------------------------------------------------------------------------


def q_join_rates(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return rounded(enrich.join_rates_month(inp.sales, inp.rates).select("sale_id", "date", "taux"))


def q_join_rates_ym(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    out = enrich.join_rates_year_month(inp.sales, inp.rates_ym)
    return rounded(out.select("sale_id", "annee", "mois", "taux", "variation_mom", "variation_yoy"))


_IND_OUT = ["sale_id", "code_ville", "departement", "ville", "revenu_median_2021", "part_hlm_2022", "nb_etablissements_2023"]


def q_join_indicators(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return rounded(enrich.join_indicators(inp.sales, inp.indicators, dedupe=False).select(*_IND_OUT))


def q_join_indicators_dedup(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return rounded(enrich.join_indicators(inp.sales, inp.indicators, dedupe=True).select(*_IND_OUT))


def q_proximity_flags(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    e = causal.enriched_sales(inp)
    return rounded(e.select("sale_id", "lat", "lon", "station_id", "distance_gp_km", "hist_id",
                            "distance_hist_km", "is_gp", "is_hist", "d_gp"))


def q_relative_years(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    f = causal.price_features(inp)
    return rounded(f.select("sale_id", "lat", "lon", "nearest_gare", "distance_gare_km", "relative_signature",
                            "relative_opening", "is_new_gare", "taux", "variation_yoy", "revenu_median_2021"))


# ---------------------------------------------------------------------------
# Panels and diff-in-diff
# ---------------------------------------------------------------------------


def q_treated_panel(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    stations = causal.prepared_new_stations(inp)
    e = causal.enriched_sales(inp, stations=stations)
    treated, _, _ = panel.treatment_subsets(e)
    return rounded(panel.build_treated_monthly(treated, stations))


def q_control_series_hist(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    _, hist, _ = panel.treatment_subsets(causal.enriched_sales(inp))
    return rounded(panel.build_control_series(hist, "control_hist"))


def q_control_series_rest(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    _, _, rest = panel.treatment_subsets(causal.enriched_sales(inp))
    return rounded(panel.build_control_series(rest, "control_rest"))


def q_full_panel(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    p = causal.full_panel(inp)
    return rounded(p.select("station_id", "date", "prix_m2_mean", "n_transactions", "taux", "prix_control_hist",
                            "n_control_hist", "prix_control_rest", "n_control_rest", "relative_signature_year"))


def q_did_by_group(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    p = causal.full_panel(inp)
    return rounded(did.did_by_group(p, "prix_control_rest", "station_id"))


QUERIES = {
    "commune_year_prices": q_commune_year_prices,
    "price_quantiles": q_price_quantiles,
    "mean_by_dimension": q_mean_by_dimension,
    "clean_sales": q_clean_sales,
    "clean_new_stations": q_clean_new_stations,
    "clean_existing_stations": q_clean_existing_stations,
    "station_union": q_station_union,
    "fold_accents": q_fold_accents,
    "rates_month": q_rates_month,
    "address_key": q_address_key,
    "geocode_sales": q_geocode_sales,
    "nearest_station": q_nearest_station,
    "nearest_station_attrs": q_nearest_station_attrs,
    "nearest_address": q_nearest_address,
    "station_city_codes": q_station_city_codes,
    "join_rates": q_join_rates,
    "join_rates_ym": q_join_rates_ym,
    "join_indicators": q_join_indicators,
    "join_indicators_dedup": q_join_indicators_dedup,
    "proximity_flags": q_proximity_flags,
    "relative_years": q_relative_years,
    "treated_panel": q_treated_panel,
    "control_series_hist": q_control_series_hist,
    "control_series_rest": q_control_series_rest,
    "full_panel": q_full_panel,
    "did_by_group": q_did_by_group,
}
