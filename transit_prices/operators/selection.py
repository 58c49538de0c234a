"""Choosing what to analyse (C10-C12) and station codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .splits import global_positions


def select_sales(df: DataFrame, mode: str | None = None, max_distance_km: float | None = None, station=None,
                 new_col: str = "is_new_gare", distance_col: str = "distance_gare_km", station_col: str = "nom_gare") -> DataFrame:
    """Each filter applies only when given: ``mode`` "new" or "old" (C10; None or
    "all" keeps both), largest distance (C11), one station (C12). Rows with a
    null in a filtered column go."""
    if mode not in (None, "all", "new", "old"):
        raise ValueError(f"unknown mode {mode}")
    if mode in ("new", "old"):
        df = df.where(F.col(new_col) == int(mode == "new"))
    if max_distance_km is not None:
        df = df.where(F.col(distance_col) <= float(max_distance_km))
    if station is not None:
        df = df.where(F.col(station_col) == F.lit(station))
    return df


def min_transactions(panel: DataFrame, least: float | None, count_col: str = "n_transactions") -> DataFrame:
    """C11: months with at least ``least`` sales."""
    return panel if least is None else panel.where(F.col(count_col) >= float(least))


def station_codes(panel: DataFrame, station_col: str, date_col: str) -> DataFrame:
    """Rows (station, gare_id), codes from 0 in the order in which stations are
    first seen (first date, then the station itself). The table serves both
    directions: join on either column. No single-task window."""
    first = panel.where(F.col(station_col).isNotNull()).groupBy(station_col).agg(F.min(date_col).alias("_first"))
    return global_positions(first, ["_first", station_col], out="gare_id").select(station_col, "gare_id")
