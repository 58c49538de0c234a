"""Dashboard tables.

Commune x year means come from one aggregate over the sales; the period
figures are derived from that small aggregate with a window partitioned by
commune (sum of sums / sum of counts), so the sales table is scanned once.
The number of distinct years is a one-row aggregate joined back as a
broadcast constant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import exact_avg, exact_sum
from ..functions.text import zero_pad
from .features import exact_quantiles


def commune_year_prices(
    sales: DataFrame,
    communes: DataFrame | None = None,
    year_range=(2014, 2025),
    code_col: str = "code_ville",
    name_col: str = "commune",
    year_col: str = "annee",
    price_col: str = "prix_m2",
) -> DataFrame:
    """B14 + C9 + F9 + F10 + D14 + C15: per (commune code, name, year) the
    mean price and count; per (code, name) over the period the mean price,
    count and count per year (distinct years of all sales in the range,
    before the commune list applies); only codes in the commune list."""
    s = sales.select(
        zero_pad(F.col(code_col), 5).alias("code_insee"),
        F.col(name_col).alias("commune"),
        F.col(year_col).alias("annee"),
        F.col(price_col).alias("p"),
    ).where(F.col("annee").between(year_range[0], year_range[1]))
    per_year = s.groupBy("code_insee", "commune", "annee").agg(
        exact_sum("p").alias("_sum"), F.count(F.lit(1)).alias("nb_tx_annee"))
    # years of all sales of the period, whether their commune is listed or not;
    # both readers share the aggregate's exchange
    n_years = per_year.agg(F.countDistinct("annee").alias("_n_years"))
    if communes is not None:
        # the planner broadcasts the commune list from its size estimate
        per_year = per_year.join(communes.select("code_insee").distinct(), "code_insee", "left_semi")
    w = Window.partitionBy("code_insee", "commune")
    out = per_year.crossJoin(F.broadcast(n_years)).select(
        "code_insee", "commune", "annee",
        (F.col("_sum").cast("double") / F.col("nb_tx_annee")).alias("prix_m2_moyen"),
        "nb_tx_annee",
        (F.sum("_sum").over(w).cast("double") / F.sum("nb_tx_annee").over(w)).alias("prix_m2_moyen_periode"),
        F.sum("nb_tx_annee").over(w).alias("nb_tx_periode"),
        (F.sum("nb_tx_annee").over(w) / F.col("_n_years")).alias("nb_tx_moyen_par_an"),
    )
    return out


def price_quantiles(table: DataFrame, col: str = "prix_m2_moyen", probs=(0.05, 0.95), exact: bool = True,
                    accuracy: int = 100000) -> DataFrame:
    """colour range of the map (linear interpolation, as pandas).
    ``exact=False`` uses the mergeable sketch for very large inputs."""
    names = [f"q{int(round(p * 100)):02d}" for p in probs]
    if exact:
        values = exact_quantiles(table, col, probs)
        return table.sparkSession.createDataFrame([tuple(values)], ", ".join(f"{n} double" for n in names))
    q = F.percentile_approx(F.col(col), F.array(*[F.lit(p) for p in probs]), accuracy)
    return table.agg(q.alias("_q")).select(*[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def select_year(table: DataFrame, year: int, year_col: str = "annee") -> DataFrame:
    """C18."""
    return table.where(F.col(year_col) == year)


def mean_by_dimension(df: DataFrame, dim: str, value_col: str = "prix_m2", out: str = "prix_moyen_agg") -> DataFrame:
    """F12 + H2: mean by a chosen dimension, highest first."""
    return df.groupBy(dim).agg(exact_avg(value_col).alias(out)).orderBy(F.col(out).desc(), F.col(dim))
