"""Feature preparation (I1-I5): exact scalers, encoders, design matrix.

Spark ML's scalers differ from the reference's (ddof 1 standard deviation,
constant column -> 0.5, frequency-ordered indexes),
so fitting is one aggregate that returns a one-row parameter table; applying
is a projection against that table (broadcast, one row), inverting is the
inverse projection. Parameters can be fitted on the train rows only and
saved as a table (I5, A13).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .enrich import bounded_broadcast
from .splits import global_positions

def exact_quantiles(df: DataFrame, cols, probs):
    """Quantiles with linear interpolation, exact at any size, of one column (a list) or of
    several (a list per column) in one pass: one histogram (column, value, count) is
    range-partitioned by both and written down, and each needed rank is looked up in the
    one partition of its column whose running count holds it. Null without a value."""
    names = [cols] if isinstance(cols, str) else list(cols)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(names)]))
    counts = df.select(pairs.alias("_p")).select("_p.*").where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    ranged = cut_lineage(counts.repartitionByRange("c", "v").withColumn("part", F.spark_partition_id()))
    sums = sorted((r["c"], r["part"], r["n"]) for r in ranged.groupBy("c", "part").agg(F.sum("n").alias("n")).collect())
    totals = {i: sum(n for c, _, n in sums if c == i) for i in range(len(names))}
    at = {i: [p * (t - 1) for p in probs] for i, t in totals.items() if t}
    ranks = {i: sorted({int(k) for k in ks} | {min(int(k) + 1, totals[i] - 1) for k in ks}) for i, ks in at.items()}
    before, needed = {i: 0 for i in totals}, []
    for c, part, n in sums:
        needed += [(c, part, k, k - before[c]) for k in ranks[c] if before[c] <= k < before[c] + n]
        before[c] += n
    value = {}
    if needed:
        upto = F.sum("n").over(Window.partitionBy("c", "part").orderBy("v"))
        # two ranks per quantile and column
        wanted = F.broadcast(df.sparkSession.createDataFrame(needed, "c int, part int, rank long, place long"))
        hit = (F.col("upto") > F.col("place")) & (F.col("upto") - F.col("n") <= F.col("place"))
        inside = ranged.withColumn("upto", upto).join(wanted, ["c", "part"]).where(hit)
        value = {(r["c"], r["rank"]): r["v"] for r in inside.select("c", "rank", "v").collect()}
    out = {}
    for i, c in enumerate(names):
        out[c] = [None] * len(probs)
        for j, k in enumerate(at.get(i, [])):
            lo, hi = value[i, int(k)], value[i, min(int(k) + 1, totals[i] - 1)]
            out[c][j] = lo if lo == hi else lo + (hi - lo) * (k - int(k))
    return out[cols] if isinstance(cols, str) else out


def fit_scaler(df: DataFrame, cols, kind: str = "standard") -> DataFrame:
    """One-row table ``{col}__center``, ``{col}__scale`` per column.

    standard: mean, population std (ddof 0); robust: median, IQR (linear
    interpolation, as the reference), exact at any size; minmax: min, max - min. Zero
    spread -> scale 1."""
    if kind == "robust":
        values, found = [], exact_quantiles(df, list(cols), (0.25, 0.5, 0.75))
        for c in cols:
            low, middle, high = found[c]
            spread = None if low is None else high - low
            values += [middle, 1.0 if not spread else spread]
        names = [f"{c}__{p}" for c in cols for p in ("center", "scale")]
        return df.sparkSession.createDataFrame([tuple(values)], ", ".join(f"`{n}` double" for n in names))
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        if kind == "standard":
            center, scale = F.avg(x), F.stddev_pop(x)
        elif kind == "minmax":
            center, scale = F.min(x), F.max(x) - F.min(x)
        else:
            raise ValueError(f"unknown scaler kind {kind}")
        aggs += [center.alias(f"{c}__center"), scale.alias(f"{c}__scale")]
    params = df.agg(*aggs)
    fixed = []
    for c in cols:
        s = F.col(f"{c}__scale")
        fixed += [F.col(f"{c}__center"), F.when(s.isNull() | (s == 0), F.lit(1.0)).otherwise(s).alias(f"{c}__scale")]
    return params.select(*fixed)


def apply_scaler(df: DataFrame, params: DataFrame, cols, suffix: str = "") -> DataFrame:
    """(x - center) / scale, against the one-row parameter table."""
    j = df.crossJoin(F.broadcast(params))
    out = j.withColumns({f"{c}{suffix}": (F.col(c) - F.col(f"{c}__center")) / F.col(f"{c}__scale") for c in cols})
    return out.drop(*[f"{c}__{p}" for c in cols for p in ("center", "scale")])


def invert_scaler(df: DataFrame, params: DataFrame, cols, suffix: str = "") -> DataFrame:
    """x * scale + center (predictions back to euros)."""
    j = df.crossJoin(F.broadcast(params))
    out = j.withColumns({f"{c}{suffix}": F.col(c) * F.col(f"{c}__scale") + F.col(f"{c}__center") for c in cols})
    return out.drop(*[f"{c}__{p}" for c in cols for p in ("center", "scale")])


def fit_ordinal(df: DataFrame, col: str) -> DataFrame:
    """Category -> index in alphabetical order (as the reference encoder);
    a small table (distinct values of one column)."""
    cats = df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct()
    # positions in a range-partitioned order: no one-task window, however many categories
    return global_positions(cats, ["value"], out="index").select("value", F.col("index").cast("double").alias("index"))


def apply_ordinal(df: DataFrame, mapping: DataFrame, col: str, unknown: float = -1.0, out: str | None = None) -> DataFrame:
    """Unknown (or null) -> -1. A mapping of few categories is broadcast, or all rows of a
    category would meet in one task; the join of a longer one is left to the planner."""
    m = bounded_broadcast(mapping).select(F.col("value").alias("_v"), F.col("index").alias("_i"))
    j = df.join(m, F.col(col) == F.col("_v"), "left")
    return j.withColumn(out or col, F.coalesce(F.col("_i"), F.lit(unknown))).drop("_v", "_i")


def categories(df: DataFrame, col: str) -> list:
    """Distinct values of a column, sorted; they name the columns of ``one_hot``."""
    return sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())


def one_hot(df: DataFrame, col: str, cats=None, drop_if_binary: bool = False, prefix: str | None = None) -> DataFrame:
    """0/1 column per category (``{col}_{value}``); unknown -> all zeros;
    ``drop_if_binary`` keeps a single column for a two-valued feature."""
    cats = list(cats) if cats is not None else categories(df, col)
    if drop_if_binary and len(cats) == 2:
        cats = cats[1:]
    p = prefix if prefix is not None else col
    return df.withColumns({f"{p}_{v}": F.coalesce((F.col(col) == F.lit(v)).cast("double"), F.lit(0.0)) for v in cats})


def design_matrix(df: DataFrame, outcome_col: str, treatment_col: str, feature_cols, categorical_cols,
                  out: str = "features"):
    """Standardised numeric features + one-hot categorical ones (unknown
    -> zeros) assembled into one vector; returns (frame with y, d, vector;
    feature names)."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler

    feature_cols, categorical_cols = list(feature_cols), list(categorical_cols)
    numeric = [c for c in feature_cols if c not in categorical_cols]
    frame = df
    names = []
    if numeric:
        params = fit_scaler(frame, numeric, "standard")
        frame = apply_scaler(frame, params, numeric, suffix="__std")
        names += [f"num__{c}" for c in numeric]
    encoded = []
    for c in categorical_cols:
        # sparse, as wide as it needs to be: the index comes from a joined table
        mapping = fit_ordinal(frame, c)
        values = [r["value"] for r in mapping.orderBy("index").collect()]
        names += [f"cat__{c}_{v}" for v in values]
        frame = apply_ordinal(frame, mapping, c, unknown=float(len(values)), out=f"{c}__idx")
        # an index beyond the fitted ones is the dropped last place: all zeros
        encoder = OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__oh", handleInvalid="keep", dropLast=True)
        frame = encoder.fit(mapping.select(F.col("index").alias(f"{c}__idx"))).transform(frame)
        encoded.append(f"{c}__oh")
    inputs = [f"{c}__std" for c in numeric] + encoded
    assembled = VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep").transform(frame)
    return assembled.select(F.col(outcome_col).cast("double").alias("y"), F.col(treatment_col).cast("double").alias("d"), out), names


@dataclass
class Preprocessor:
    """Fitted tables of an ordinal, a robust and a min-max part."""

    mappings: dict = field(default_factory=dict)
    scalers: list = field(default_factory=list)  # (one-row parameter table, columns)

    def transform(self, df: DataFrame) -> DataFrame:
        """Same columns, same names; categories not seen in the fit -> -1."""
        order = df.columns
        for c, mapping in self.mappings.items():
            df = apply_ordinal(df, mapping, c)
        for params, cols in self.scalers:
            df = apply_scaler(df, params, cols)
        return df.select(*order)


def fit_preprocessor(train: DataFrame, ordinal_cols=(), robust_cols=(), minmax_cols=()) -> Preprocessor:
    """Fit each part on the train rows only."""
    scalers = [(fit_scaler(train, list(cols), kind), list(cols))
               for kind, cols in (("robust", robust_cols), ("minmax", minmax_cols)) if cols]
    return Preprocessor({c: fit_ordinal(train, c) for c in ordinal_cols}, scalers)


def station_inputs(train: DataFrame, test: DataFrame, numeric_cols, target_col: str, categorical_cols=()):
    """Min-max features, one-hot categories (a two-valued one gives one column,
    unknown ones zeros) and a target scaler of its own, all fitted on ``train``.
    Returns (train, test, feature parameters, target parameters)."""
    numeric_cols = list(numeric_cols)
    inputs, target = fit_scaler(train, numeric_cols, "minmax"), fit_scaler(train, [target_col], "minmax")
    values = {c: categories(train, c) for c in categorical_cols}

    def prepared(df):
        df = apply_scaler(apply_scaler(df, inputs, numeric_cols), target, [target_col])
        for c, cats in values.items():
            df = one_hot(df, c, cats, drop_if_binary=True).drop(c)
        return df

    return prepared(train), prepared(test), inputs, target


def encode_table(df: DataFrame, label_cols, station_col: str, numeric_cols) -> DataFrame:
    """I4: alphabetical integer labels, one-hot stations (one column if there are
    two), then min-max of all numeric columns, labels and 0/1 columns included."""
    label_cols, numeric_cols = list(label_cols), list(numeric_cols)
    for c in label_cols:
        df = apply_ordinal(df, fit_ordinal(df, c), c)
    cats = categories(df, station_col)
    df = one_hot(df, station_col, cats, drop_if_binary=True)
    # two or more stations: the 0/1 columns span 0 to 1 already; a lone constant one becomes 0
    if len(cats) == 1:
        numeric_cols.append(f"{station_col}_{cats[0]}")
    cols = label_cols + numeric_cols
    return apply_scaler(df, fit_scaler(df, cols, "minmax"), cols)
