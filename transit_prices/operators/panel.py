"""Monthly panels.

All group-bys are hash aggregates with a map-side partial step, so a hot
station or month is pre-combined in every task before the shuffle. Filters
that need a global number (months in the data, the global mode) take it
from a one-row aggregate joined back as a broadcast constant, never through
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_avg, exact_sum
from ..session import cut_lineage
from .enrich import bounded_broadcast

# Panel names of the indicator means (output name -> enriched column).
PANEL_INDICATORS = {
    "revenu_median_2021": "revenu_median_2021",
    "taux_chomage_2024": "taux_chomage_2024",
    "evo_population_2016_2022": "evo_population_2016_2022",
    "part_hlm_2022": "part_hlm_2022",
    "part_cadres_2022": "part_cadres_2022",
    "part_log_vacants_2022": "part_log_vacants_2022",
    "part_diplomes_2024": "part_eleves_prive_2024",
    "nb_entreprises_2023": "nb_etablissements_2023",
}


def treatment_subsets(df: DataFrame):
    """Treated (near a new station), control near an existing station
    only, and the rest (all not treated; contains the second)."""
    treated = df.where(F.col("is_gp"))
    control_hist = df.where(~F.col("is_gp") & F.col("is_hist"))
    control_rest = df.where(~F.col("is_gp"))
    return treated, control_hist, control_rest


def build_treated_monthly(treated: DataFrame, stations: DataFrame, date_col: str = "date_mutation",
                          station_col: str = "station_id") -> DataFrame:
    """F1 + D11: (station, month) -> mean price, count, indicator means;
    station attributes attached (stations de-duplicated on id); relative
    signature year."""
    month = F.trunc(F.col(date_col), "MM").alias("date")
    present = {k: v for k, v in PANEL_INDICATORS.items() if v in treated.columns}
    agg = treated.groupBy(F.col(station_col).alias("station_id"), month).agg(
        exact_avg("prix_m2").alias("prix_m2_mean"),
        F.count(F.lit(1)).alias("n_transactions"),
        *[F.avg(v).alias(k) for k, v in present.items()],
    )
    g = stations.select("station_id", "nom_gare", "ligne_clean", "departement", "date_signature", "date_ouverture")
    g = g.groupBy("station_id").agg(F.min(F.struct(*[c for c in g.columns if c != "station_id"])).alias("s")) \
        .select("station_id", "s.*")
    out = agg.join(bounded_broadcast(g), "station_id", "left")
    return out.withColumn("relative_signature_year", F.year("date") - F.year("date_signature"))


def build_control_series(control: DataFrame, name: str, date_col: str = "date_mutation") -> DataFrame:
    """month -> mean price and count, names suffixed with ``name``. Few
    keys (months): the partial aggregate leaves one row per month per task."""
    return control.groupBy(F.trunc(F.col(date_col), "MM").alias("date")).agg(
        exact_avg("prix_m2").alias(f"prix_{name}"),
        F.count(F.lit(1)).alias(f"n_{name}"),
    )


def monthly_cube(enriched: DataFrame, date_col: str = "date_mutation", station_col: str = "station_id") -> DataFrame:
    """One pass over the enriched sales: additive sums per (station, month,
    is_gp, is_hist) - row count, exact price sum, and sum / non-null
    count of each panel indicator. Every panel and control series below is a
    re-aggregation of this small table, so the sales are read once."""
    present = {k: v for k, v in PANEL_INDICATORS.items() if v in enriched.columns}
    aggs = [F.count(F.lit(1)).alias("_n"), exact_sum("prix_m2").alias("_psum"), F.count("prix_m2").alias("_pn")]
    for k, v in present.items():
        aggs += [F.sum(v).alias(f"_s_{k}"), F.count(v).alias(f"_c_{k}")]
    return enriched.groupBy(F.col(station_col).alias("station_id"), F.trunc(F.col(date_col), "MM").alias("date"),
                            "is_gp", "is_hist").agg(*aggs)


def _cube_aggs(cube: DataFrame, cond, price_name: str, n_name: str, indicators: bool):
    """Conditional re-aggregation of the cube. Conditions sit inside the
    aggregates, not in filters, so that Catalyst cannot push them below the
    shared cube and every consumer reads the same (reused) exchange."""
    pick = lambda c: F.when(cond, F.col(c))
    aggs = [F.sum(pick("_n")).alias(n_name), (F.sum(pick("_psum")).cast("double") / F.sum(pick("_pn"))).alias(price_name)]
    if indicators:
        for k in PANEL_INDICATORS:
            if f"_s_{k}" in cube.columns:
                aggs.append((F.sum(pick(f"_s_{k}")) / F.sum(pick(f"_c_{k}"))).alias(k))
    return aggs


def build_full_panel(enriched: DataFrame, stations: DataFrame, rates: DataFrame | None = None,
                     date_col: str = "date_mutation") -> DataFrame:
    """C16 + F1 + F2 + D4 + D12: treated panel with rate and two control
    series by month, all derived from one ``monthly_cube`` pass over the
    sales (the treated and control subsets never rescan them)."""
    # small (stations x months x 4 flags) and read by two consumers: kept,
    # so the sales are scanned exactly once
    cube = monthly_cube(enriched, date_col).persist()
    is_gp, is_hist = F.col("is_gp"), F.col("is_hist")
    treated = cube.groupBy("station_id", "date").agg(
        *_cube_aggs(cube, is_gp, "prix_m2_mean", "n_transactions", True)).where(F.col("n_transactions") > 0)
    controls = cube.groupBy("date").agg(
        *_cube_aggs(cube, ~is_gp & is_hist, "prix_control_hist", "n_control_hist", False),
        *_cube_aggs(cube, ~is_gp, "prix_control_rest", "n_control_rest", False))
    g = stations.select("station_id", "nom_gare", "ligne_clean", "departement", "date_signature", "date_ouverture")
    g = g.groupBy("station_id").agg(F.min(F.struct(*[c for c in g.columns if c != "station_id"])).alias("s")) \
        .select("station_id", "s.*")
    panel = treated.join(bounded_broadcast(g), "station_id", "left").withColumn(
        "relative_signature_year", F.year("date") - F.year("date_signature"))
    if rates is not None:
        panel = panel.join(bounded_broadcast(rates.select("date", "taux")), "date", "left")
    # months are a bounded dimension: the control table is broadcast
    return panel.join(F.broadcast(controls), "date", "left")


# ---------------------------------------------------------------------------
# Station x month feature panels for the forecasting part
# ---------------------------------------------------------------------------


def _complete_only(agg: DataFrame, station_col: str) -> DataFrame:
    """keep stations present in every month seen in the (aggregated)
    data. The panel is written down first: it is read three times here, and again by
    its users, and each reading would join and aggregate all sales anew."""
    agg = cut_lineage(agg)
    total = agg.agg(F.countDistinct("date").alias("_months_total"))
    per = agg.groupBy(station_col).agg(F.countDistinct("date").alias("_months"))
    complete = per.crossJoin(F.broadcast(total)).where(F.col("_months") == F.col("_months_total")).select(station_col)
    return agg.join(complete, station_col, "left_semi")


def station_month_features(
    df: DataFrame,
    date_col: str,
    station_col: str,
    numeric_cols,
    shares: dict | None = None,
    complete_only: bool = True,
    target_col: str | None = None,
    drop_nulls: bool = True,
) -> DataFrame:
    """(month, station) -> count, mean of each numeric column, and
    for each ``{out_name: (column, value)}`` the share of rows equal to
    value (null counts as not equal). F6 filter when ``complete_only``."""
    shares = shares if shares is not None else {
        "share_appartement": ("type_local", "Appartement"),
        "share_vente": ("nature_mutation", "Vente"),
    }
    keyed = df.where(F.col(station_col).isNotNull() & F.col(date_col).isNotNull())
    aggs = [F.count(F.lit(1)).alias("n_transactions")]
    if target_col:
        aggs.append(exact_avg(target_col).alias(target_col))
    aggs += [exact_avg(c).alias(c) for c in numeric_cols if c != target_col]
    aggs += [F.avg(F.col(c).eqNullSafe(v).cast("double")).alias(name) for name, (c, v) in shares.items()]
    agg = keyed.groupBy(F.trunc(F.col(date_col), "MM").alias("date"), F.col(station_col)).agg(*aggs)
    if complete_only:
        agg = _complete_only(agg, station_col)
    keep = [station_col, "date", "n_transactions"] + ([target_col] if target_col else []) \
        + [c for c in numeric_cols if c != target_col] + list(shares)
    out = agg.select(*keep)
    return out.na.drop(how="any") if drop_nulls else out


def global_modes(df: DataFrame, cols) -> DataFrame:
    """One row ``_mode_{col}``: each column's most frequent value as text (ties -> smallest,
    nulls ignored), from one (column, value) count table; no buffer holds a column's values."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)]))
    counts = df.select(pairs.alias("_p")).select("_p.*").where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].alias("v"))
    return best.agg(*[F.max(F.when(F.col("c") == i, F.col("v"))).alias(f"_mode_{c}") for i, c in enumerate(cols)])


def station_month_features_mode(
    df: DataFrame,
    date_col: str,
    station_col: str,
    numeric_cols,
    categorical_cols,
    complete_only: bool = True,
) -> DataFrame:
    """as F3, with shares measured against each categorical column's
    global mode (ties -> smallest value). The modes come from one global
    aggregate joined back as constants."""
    keyed = df.where(F.col(station_col).isNotNull() & F.col(date_col).isNotNull())
    modes = global_modes(keyed, list(categorical_cols))
    with_mode = keyed.crossJoin(F.broadcast(modes))
    aggs = [F.count(F.lit(1)).alias("n_transactions")]
    aggs += [exact_avg(c).alias(c) for c in numeric_cols]
    aggs += [F.avg(F.col(c).cast("string").eqNullSafe(F.col(f"_mode_{c}")).cast("double")).alias(f"{c}_share") for c in categorical_cols]
    agg = with_mode.groupBy(F.trunc(F.col(date_col), "MM").alias("date"), F.col(station_col)).agg(*aggs)
    if complete_only:
        agg = _complete_only(agg, station_col)
    keep = [station_col, "date", "n_transactions"] + list(numeric_cols) + [f"{c}_share" for c in categorical_cols]
    return agg.select(*keep).na.drop(how="any")


def station_month_modes(df: DataFrame, date_col: str, station_col: str, numeric_cols, categorical_cols) -> DataFrame:
    """(month, station) -> numeric means and the group mode of each text
    column (ties -> smallest; all-null -> null); rows with a null dropped."""
    keyed = df.where(F.col(station_col).isNotNull() & F.col(date_col).isNotNull())
    agg = keyed.groupBy(F.trunc(F.col(date_col), "MM").alias("date"), F.col(station_col)).agg(
        *[exact_avg(c).alias(c) for c in numeric_cols],
        *[F.mode(c, True).alias(c) for c in categorical_cols],
    )
    return agg.select(station_col, "date", *numeric_cols, *categorical_cols).na.drop(how="any")
