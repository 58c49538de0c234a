"""Diff-in-diff by group (C17, B33, E4, F8) as one conditional aggregate.

Each usable panel row is tagged with the window(s) it falls in; a row in
both windows (overlapping windows) is emitted twice through ``explode``, as
the reference's concatenation does. One ``groupBy`` then yields the pre and
post means, counts, transaction sums and the spread of the sign-flipped gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pct_gap

DID_COLUMNS = [
    "pre_mean", "n_pre", "n_tx_pre", "post_mean", "n_post", "n_tx_post",
    "ate_pct", "n_obs", "n_transactions", "ci_low_pct", "ci_high_pct",
]


def did_by_group(
    panel: DataFrame,
    control_col: str,
    group_col: str,
    pre_window=(-5, -1),
    post_window=(0, 10),
    price_col: str = "prix_m2_mean",
    rel_col: str = "relative_signature_year",
    tx_col: str = "n_transactions",
    z: float = 1.96,
) -> DataFrame:
    """F8: per group, mean gap to control (in %) before and after, effect =
    post - pre, 95% bounds from the pooled sign-flipped gaps (ddof 1);
    only groups with both windows; 12 columns in fixed order. A zero control
    gives a null gap (pandas would give inf)."""
    usable = panel.where(F.col(price_col).isNotNull() & F.col(control_col).isNotNull() & F.col(rel_col).isNotNull())
    gap = pct_gap(price_col, control_col)
    rel = F.col(rel_col)
    in_pre = rel.between(pre_window[0], pre_window[1])
    in_post = rel.between(post_window[0], post_window[1])
    tags = F.array(F.when(in_pre, F.lit("pre")), F.when(in_post, F.lit("post")))
    rows = usable.select(F.col(group_col), gap.alias("_g"), F.col(tx_col).alias("_t"), F.explode(tags).alias("_side")) \
        .where(F.col("_side").isNotNull())
    pre = F.col("_side") == "pre"
    post = F.col("_side") == "post"
    signed = F.when(pre, -F.col("_g")).otherwise(F.col("_g"))
    agg = rows.groupBy(group_col).agg(
        F.avg(F.when(pre, F.col("_g"))).alias("pre_mean"),
        F.count_if(pre).alias("n_pre"),
        F.sum(F.when(pre, F.col("_t"))).alias("n_tx_pre"),
        F.avg(F.when(post, F.col("_g"))).alias("post_mean"),
        F.count_if(post).alias("n_post"),
        F.sum(F.when(post, F.col("_t"))).alias("n_tx_post"),
        F.stddev_samp(signed).alias("_std"),
        F.count(F.lit(1)).alias("n_obs"),
    ).where((F.col("n_pre") > 0) & (F.col("n_post") > 0))
    ate = F.col("post_mean") - F.col("pre_mean")
    half = F.lit(z) * F.col("_std") / F.sqrt(F.col("n_obs"))
    return agg.select(
        group_col, "pre_mean", "n_pre", "n_tx_pre", "post_mean", "n_post", "n_tx_post",
        ate.alias("ate_pct"), "n_obs",
        (F.col("n_tx_pre") + F.col("n_tx_post")).alias("n_transactions"),
        (ate - half).alias("ci_low_pct"), (ate + half).alias("ci_high_pct"),
    )
