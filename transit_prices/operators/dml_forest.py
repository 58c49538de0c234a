"""Double ML per station with forest nuisances (J2), one forest per fold for all stations.

The reference copies the table and fits two forests for each station and fold. Here E[Y|X] is
one forest per fold, and so are all E[D_s|X]: the trees split on the treatment as such, and each
leaf holds a sparse vector, the share of its training rows that are treated at each station (the
table (tree, leaf, station, share)). A row's m_s is the mean of its leaves' vectors, so an
effect needs only sums over rows: counts, sums of residuals, of m_s and of m_s squared.

Values are binned by exact quantiles (32 bins, as Spark ML does by default).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ship_package
from . import dml, trees

#: Entries of leaf vectors that are broadcast at once; more stations go in further passes.
ENTRIES = 20_000_000
#: Counts of (tree, leaf, station) that a task gathers before it passes them on.
HELD = 4_000_000


def leaves(forest: list[trees.Tree], x: np.ndarray) -> np.ndarray:
    """The leaf of each row in each tree (rows x trees)."""
    out = np.zeros((len(x), len(forest)), dtype=np.int64)
    for t, tree in enumerate(forest):
        out[:, t] = trees._end(*tree[:3], x)
    return out


_held = trees.held_trees


def _x(batch: pd.DataFrame) -> np.ndarray:
    return np.array(batch["x"].tolist(), dtype=np.int64).reshape(len(batch), -1)


def leaf_vectors(train: DataFrame, forest: list[trees.Tree]) -> DataFrame:
    """Rows (tree, leaf, station, share) over the treated rows' stations of (x, station);
    station is null for rows not treated."""
    shared = train.sparkSession.sparkContext.broadcast(forest)
    kind = train.schema["station"].dataType.simpleString()

    wide = max(len(f[0]) for f in forest)

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, number, held = shared.value, {}, []

        def merged():
            key, nth = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return [(key, np.bincount(nth, np.concatenate([n for _, n in held])).astype(np.int64))]

        def table(key, n):
            names = np.array([None, *number], dtype=object)
            at = key >> 32
            return pd.DataFrame({"tree": at // wide, "leaf": at % wide, "station": names[key & 0xFFFFFFFF], "n": n})

        for batch in batches:
            codes, found = pd.factorize(batch["station"].astype(object))
            code = np.array([0, *(number.setdefault(s, len(number) + 1) for s in found)], dtype=np.int64)[codes + 1]
            at = leaves(forest, _x(batch))
            for t in range(len(forest)):
                held.append(np.unique((at[:, t] + t * wide << 32) + code, return_counts=True))
            if sum(len(k) for k, _ in held) > HELD:
                held = merged()
                if len(held[0][0]) > HELD // 2:
                    yield table(*held[0])
                    held = []
        if held:
            yield table(*merged()[0])

    found = train.mapInPandas(counts, f"tree int, leaf int, station {kind}, n long").groupBy("tree", "leaf", "station").agg(F.sum("n").alias("n"))
    found = cut_lineage(found)
    total = found.groupBy("tree", "leaf").agg(F.sum("n").alias("rows"))
    return found.where("station is not null").join(total, ["tree", "leaf"]).select("tree", "leaf", "station", (F.col("n") / F.col("rows")).alias("share"))


def _station_sums(test: DataFrame, forest_y, forest_d, vectors: DataFrame, stations: list) -> DataFrame:
    """Per station over the rows of ``test`` (y, station, x): treated rows, their residuals
    and m_s, and over all rows m_s squared and m_s times the residual."""
    number = {s: i for i, s in enumerate(stations)}
    wide = max(len(f[0]) for f in forest_d)
    entries = vectors.where(F.col("station").isin(stations)).toPandas()
    key = entries["tree"].to_numpy() * wide + entries["leaf"].to_numpy()
    order = np.argsort(key, kind="stable")
    station = np.array([number[s] for s in entries["station"]], dtype=np.int64)[order]
    share, starts = entries["share"].to_numpy()[order], np.searchsorted(key[order], np.arange(len(forest_d) * wide + 1))
    shared = test.sparkSession.sparkContext.broadcast((forest_y, forest_d, station, share, starts, number, wide))
    k = len(stations)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest_y, forest_d, station, share, starts, number, wide = shared.value
        thin = len(station) * 10 < (len(starts) - 1) * k
        if not thin:  # at most ten times the entries
            table = np.zeros((len(forest_d) * wide, k))
            table[np.repeat(np.arange(len(starts) - 1), np.diff(starts)), station] = share
            table = table.reshape(len(forest_d), wide, k)
        for whole in batches:
            x = _x(whole)
            far = whole["y"].to_numpy() - sum(trees._leaf(t, x) for t in forest_y) / len(forest_y)
            ends = leaves(forest_d, x) + wide * np.arange(len(forest_d))
            for a in range(0, len(whole), 500 if thin else 2000):
                batch, at, residual = (v[a : a + (500 if thin else 2000)] for v in (whole, ends, far))
                if thin:
                    at = at.ravel()
                    sizes = starts[at + 1] - starts[at]
                    spots = np.repeat(starts[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                    cell = np.repeat(np.arange(len(at)) // len(forest_d), sizes) * k + station[spots]
                    m = np.bincount(cell, share[spots], len(batch) * k).reshape(len(batch), k)
                else:  # most leaves know most stations: one row of a table each
                    m = np.zeros((len(batch), k))
                    for t in range(len(forest_d)):
                        m += table[t].take(at[:, t] - t * wide, axis=0)
                m /= len(forest_d)
                own = np.array([number.get(s, -1) for s in batch["station"]], dtype=np.int64)
                treated = np.flatnonzero(own >= 0)
                count = lambda w=None: np.bincount(own[treated], w, k)
                yield pd.DataFrame({
                    "nth": np.arange(k), "c": count().astype(float), "sy": count(residual[treated]), "sm": count(m[treated, own[treated]]),
                    "smm": (m * m).sum(axis=0), "smy": m.T @ residual, "syy": np.full(k, float(residual @ residual)), "n": np.full(k, float(len(batch)))})

    return test.mapInPandas(sums, "nth int, c double, sy double, sm double, smm double, smy double, syy double, n double")


def run_dml_by_station_forest(
    df: DataFrame, y_col: str, base_treat_col: str, station_col: str, x_cols, n_splits: int = 2, random_state: int = 42, min_treated: int = 100,
    fold_col: str | None = None, key_cols=(), n_trees: int = 200, depth: int = 10, least: float = 5.0, entries: int = ENTRIES,
) -> DataFrame:
    """J2 as ``dml.run_dml_by_station``, with the reference's forests as nuisances
    (200 trees, depth 10, leaves of 5 rows or more)."""
    x_cols = list(x_cols)
    ship_package(df.sparkSession)
    extra = [station_col] + ([fold_col] if fold_col else []) + list(key_cols)
    data = df.withColumn(base_treat_col, F.coalesce(F.col(base_treat_col).cast("int"), F.lit(0)))
    data, _ = dml.prepare_dml_frame(data, y_col, base_treat_col, x_cols, dropna=False, extra=extra)
    data = dml.assign_folds(data, n_splits, fold_col, key_cols, random_state)
    known = F.lit(True)
    for c in (y_col, *x_cols):
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    data = data.withColumn("_known", known).withColumn("_at", F.when(F.col(base_treat_col) == 1, F.col(station_col)))
    data = cut_lineage(data)
    complete = data.where("_known")
    id_type = df.schema[station_col].dataType
    per = data.where("_at is not null").groupBy(F.col("_at").alias("station_id")).agg(F.count(F.lit(1)).alias("n_treated"))
    n_rows = data.count()
    # stations with enough treated rows: a table that the result has a row for each of
    per = cut_lineage(per.where((F.col("n_treated") >= min_treated) & (F.col("n_treated") < n_rows)))
    stations = sorted(r["station_id"] for r in per.select("station_id").toLocalIterator())
    out_type = T.StructType([T.StructField("station_id", id_type), *dml.BY_STATION_SCHEMA.fields[1:]])
    if not stations:
        return df.sparkSession.createDataFrame([], out_type)
    edges = trees.bin_edges(complete, x_cols)
    rows = cut_lineage(trees.binned(complete, x_cols, edges, y_col).select("x", "y", F.col(base_treat_col).cast("double").alias("d"), F.col("_at").alias("station"), "_fold"))
    parts = []
    for f in range(n_splits):
        train, test = rows.where(F.col("_fold") != f), rows.where(F.col("_fold") == f).select("x", "y", "station")
        forest_y = _held(trees.grow_forest(train.select("x", "y"), n_trees, depth, random_state, least=least))
        forest_d = _held(trees.grow_forest(train.select("x", F.col("d").alias("y")), n_trees, depth, random_state + 1, least=least))
        vectors = cut_lineage(leaf_vectors(train.select("x", "station"), forest_d))
        sizes = {r["station"]: r["n"] for r in vectors.groupBy("station").agg(F.count(F.lit(1)).alias("n")).collect()}
        for some in _groups(stations, sizes, entries):
            names = df.sparkSession.createDataFrame([(i, s) for i, s in enumerate(some)], T.StructType([T.StructField("nth", T.IntegerType()), T.StructField("station_id", id_type)]))
            parts.append(_station_sums(test, forest_y, forest_d, vectors, some).join(F.broadcast(names), "nth").drop("nth"))
    sums = parts[0]
    for p in parts[1:]:
        sums = sums.unionByName(p)
    names = ("c", "sy", "sm", "smm", "smy", "syy", "n")
    total = sums.groupBy("station_id").agg(*[F.sum(c).alias(c) for c in names]).join(per, "station_id")
    sdd, syd = F.col("c") - 2 * F.col("sm") + F.col("smm"), F.col("sy") - F.col("smy")
    tau = F.try_divide(syd, sdd)
    rss = F.greatest(F.col("syy") - 2 * tau * syd + tau * tau * sdd, F.lit(0.0))
    total = total.withColumn("tau_hat", tau).withColumn("se_tau", F.sqrt(F.try_divide(rss, (F.col("n") - 1) * sdd)))
    low, high = (F.col("tau_hat") + s * dml.Z_95 * F.col("se_tau") for s in (-1, 1))
    percent = lambda c: F.expm1(c) * 100
    return total.select(
        "station_id", "tau_hat", "se_tau", low.alias("ci_low"), high.alias("ci_high"), percent(F.col("tau_hat")).alias("ate_pct"), percent(low).alias("ci_low_pct"),
        percent(high).alias("ci_high_pct"), F.col("n").cast("long").alias("n"), "n_treated")


def _groups(stations: list, sizes: dict, entries: int) -> Iterator[list]:
    """Runs of stations whose leaf vectors have about ``entries`` entries at most; a batch's
    rows x stations table holds at most 2,000 of them."""
    some, total = [], 0
    for s in stations:
        if some and (total + sizes.get(s, 0) > entries or len(some) == 2000):
            yield some
            some, total = [], 0
        some.append(s)
        total += sizes.get(s, 0)
    yield some
