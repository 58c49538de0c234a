"""Numeric expressions: great-circle distance, safe ratios, percent effects."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km (degrees in), as a built-in expression."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def haversine_km_np(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM):
    """Same formula on numpy arrays (broadcasting), used inside Arrow batches."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    dphi = p2 - p1
    dlmb = np.radians(lon2) - np.radians(lon1)
    a = np.sin(dphi / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(dlmb / 2) ** 2
    return 2.0 * radius_km * np.arcsin(np.sqrt(np.minimum(a, 1.0)))


def pct_gap(value, control) -> Column:
    """(value / control - 1) * 100; zero control -> null."""
    return (F.try_divide(_c(value), _c(control)) - F.lit(1.0)) * F.lit(100.0)


def log_to_pct(col) -> Column:
    """(exp(t) - 1) * 100."""
    return F.expm1(_c(col)) * F.lit(100.0)


def safe_ratio(num, den) -> Column:
    """Num / den, null when den is 0 or null."""
    return F.try_divide(_c(num), _c(den))


def exact_sum(col) -> Column:
    """Sum as DECIMAL(38, 9): independent of partitioning and summation order, and
    with values taken to 9 decimals. Values of 1e19 and more do not fit and fail the cast."""
    return F.sum(_c(col).cast("decimal(28,9)"))


def exact_avg(col) -> Column:
    """Mean from the exact sum: reproducible to the last bit across runs and
    cluster sizes (a plain double ``avg`` depends on task order)."""
    return exact_sum(col).cast("double") / F.count(_c(col))
