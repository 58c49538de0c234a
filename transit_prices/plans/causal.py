"""The causal pipeline as one lazy plan: clean -> stations -> reverse geocode
-> geocode sales -> nearest new / existing station -> indicators -> flags
-> rate -> panel. Each function returns a DataFrame; nothing is collected
except the (size-checked) station coordinates used by the nearest join.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, enrich, geo, panel
from ..sources import adapters

# Treatment radius on the driver data (the reference uses 1 km on real
# data; the synthetic points are sparser, see FIXTURES.md).
DRIVER_RADIUS_KM = 3.0


class Inputs:
    """The cleaned domain feeds, each built on first use (a query that only
    needs the sales never plans the station or rate feeds)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def sales(self) -> DataFrame:
        return clean.clean_sales(adapters.sales_raw(self.spark, self.sf_dir), keep_extra=("sale_id", "order_key"))

    @cached_property
    def register(self) -> DataFrame:
        return clean.clean_register(adapters.register_raw(self.spark, self.sf_dir))

    @cached_property
    def new_stations(self) -> DataFrame:
        return clean.clean_new_stations(adapters.new_stations_raw(self.spark, self.sf_dir))

    @cached_property
    def existing_stations(self) -> DataFrame:
        return clean.clean_existing_stations(adapters.existing_stations_raw(self.spark, self.sf_dir))

    @cached_property
    def rates(self) -> DataFrame:
        return clean.clean_rates(adapters.rates_daily_raw(self.spark, self.sf_dir))

    @cached_property
    def rates_ym(self) -> DataFrame:
        return adapters.rates_monthly(self.spark, self.sf_dir)

    @cached_property
    def indicators(self) -> DataFrame:
        return clean.clean_indicators(adapters.indicators_raw(self.spark, self.sf_dir))

    @cached_property
    def communes(self) -> DataFrame:
        return adapters.communes(self.spark, self.sf_dir)


def load_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Raw feeds (adapters) through their cleaners, lazily."""
    return Inputs(spark, sf_dir)


def all_stations(inp: Inputs) -> DataFrame:
    """New + existing stations in the shared layout."""
    return clean.merge_all_stations(inp.new_stations, clean.existing_for_union(inp.existing_stations))


def prepared_new_stations(inp: Inputs) -> DataFrame:
    """D15 then D8: the new stations with city, postcode, department and
    city code (reverse geocoding against the register, no web calls)."""
    located = geo.nearest_address(inp.new_stations, inp.register)
    # a small dimension read by several jobs (size check, broadcast arrays,
    # panel attributes): keep it rather than recompute the reverse lookup
    return enrich.prepare_new_stations(located, inp.indicators).persist()


def historic_stations(inp: Inputs) -> DataFrame:
    """C14: all stations whose name is not a new station's name."""
    return enrich.existing_only(all_stations(inp), inp.new_stations)


def enriched_sales(inp: Inputs, radius_km: float = DRIVER_RADIUS_KM, dedupe_indicators: bool = False,
                   stations: DataFrame | None = None, hist: DataFrame | None = None) -> DataFrame:
    """Sales with coordinates, nearest new and existing station, commune
    indicators, proximity flags, month and rate."""
    stations = stations if stations is not None else prepared_new_stations(inp)
    hist = hist if hist is not None else historic_stations(inp)
    s = enrich.add_log_price(inp.sales)
    s = enrich.geocode_sales(s, inp.register)
    s = geo.attach_nearest(s, "lat", "lon", stations, "latitude", "longitude", "station_id", "gp")
    s = s.withColumnRenamed("gp_id", "station_id").withColumnRenamed("gp_distance_km", "distance_gp_km")
    s = geo.attach_nearest(s, "lat", "lon", hist, "latitude", "longitude", "id_gare", "hist")
    s = s.withColumnRenamed("hist_distance_km", "distance_hist_km")
    s = enrich.join_indicators(s, inp.indicators, dedupe=dedupe_indicators)
    s = enrich.proximity_flags(s, radius_km)
    return enrich.join_rates_month(s, inp.rates)


def full_panel(inp: Inputs, enriched: DataFrame | None = None, stations: DataFrame | None = None) -> DataFrame:
    """Treated panel + rate + two control series (the input of F8)."""
    stations = stations if stations is not None else prepared_new_stations(inp)
    enriched = enriched if enriched is not None else enriched_sales(inp, stations=stations)
    return panel.build_full_panel(enriched, stations, inp.rates)


def price_features(inp: Inputs, stations: DataFrame | None = None) -> DataFrame:
    """The price-regression enrichment chain (D1, D3, B23, B25, D5, D7):
    geocode, nearest station with attributes, relative years, new-station
    flag, rate by (year, month), de-duplicated indicators; the multicollinear
    columns are dropped but ``date`` is kept (2.M #24)."""
    stations = stations if stations is not None else prepared_new_stations(inp)
    s = enrich.geocode_sales(inp.sales, inp.register)
    s = geo.nearest_station_with_attrs(s, stations, id_col="station_id")
    s = enrich.relative_years(s)
    s = enrich.new_station_flag(s)
    s = enrich.join_rates_year_month(s, inp.rates_ym)
    s = enrich.join_indicators(s, inp.indicators, dedupe=True)
    s = s.withColumn("date", F.col("date_mutation"))
    return s.drop("date_mutation", "valeur_fonciere", "departement", "ville", "code_ville")
