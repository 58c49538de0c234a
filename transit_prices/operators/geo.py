"""Nearest-neighbour joins on the sphere.

Spark has no spatial index, so the nearest station is found in one of two
exact ways, chosen by a size check on the station table:

* ``broadcast`` (stations <= ``max_broadcast``): the station coordinates
  (three numbers each) ship to every task, and an Arrow-batched pandas UDF
  ranks them for each point by 3-D chord length, which orders exactly like
  great-circle distance but needs no trigonometry per pair. Only the two
  coordinate columns cross to Python; the point table is never shuffled and
  keeps its row multiplicity.
* ``grid`` (any size): stations are bucketed into lat/lon cells that wrap around
  the date line; each point looks at its 3x3 block of cells through an equi-join. A
  hit closer than the block's guaranteed radius is final; the rest go down from the coarsest
  cells and keep only those whose bounds allow their nearest station. Joins on cell
  keys; only the cells of the coarse levels, bounded by the globe, are broadcast.

Both give the same rows (tests compare them at the date line, the poles, for NaN, ties
and text ids). Stations at one position count once, with their smallest id.

Ties: the nearest station is the smallest (distance rounded to 1e-9 km,
station id), declared so that results do not depend on float noise.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import EARTH_RADIUS_KM, haversine_km, haversine_km_np
from ..functions.text import department_from_postcode
from ..session import cut_lineage, ship_package

DEFAULT_MAX_BROADCAST_STATIONS = 200_000
TIE_DECIMALS = 9
_CHUNK_PAIRS = 4_000_000
_BAND = 1e-13          # squared-chord band (radians^2) re-ranked exactly


def _unit_vectors(lat_deg, lon_deg):
    lat, lon = np.radians(lat_deg), np.radians(lon_deg)
    cl = np.cos(lat)
    return np.stack([cl * np.cos(lon), cl * np.sin(lon), np.sin(lat)], axis=-1)


def _nearest_numpy(plat, plon, slat, slon, sid):
    """Index of the nearest station for each point (stations sorted by id).

    Returns (index array, distance array); NaN inputs give index -1."""
    n = plat.shape[0]
    best = np.full(n, -1, dtype=np.int64)
    dist = np.full(n, np.nan)
    valid = ~(np.isnan(plat) | np.isnan(plon))
    if n == 0 or slat.shape[0] == 0 or not valid.any():
        return best, dist
    sv = _unit_vectors(slat, slon)
    idx_valid = np.nonzero(valid)[0]
    pv_all = _unit_vectors(plat[idx_valid], plon[idx_valid])
    step = max(1, _CHUNK_PAIRS // max(1, sv.shape[0]))
    for start in range(0, idx_valid.shape[0], step):
        rows = idx_valid[start:start + step]
        pv = pv_all[start:start + step]
        # squared chord = 2 - 2 p.s: one matrix product (BLAS); its rounding
        # error (~1e-15) is far below the re-ranking band used below
        d2 = 2.0 - 2.0 * (pv @ sv.T)
        arg = d2.argmin(axis=1)
        mn = d2[np.arange(rows.shape[0]), arg]
        # every station within the band of the best (about 2 m) is re-ranked
        # by the declared order: haversine rounded to 1e-9 km, then id
        # (stations are sorted by id, so the first minimum is the smallest)
        near = d2 <= (mn + _BAND)[:, None]
        multi = np.nonzero(near.sum(axis=1) > 1)[0]
        if multi.size:
            r, cand = np.nonzero(near[multi])          # candidate pairs only
            pr = rows[multi][r]
            h = np.round(haversine_km_np(plat[pr], plon[pr], slat[cand], slon[cand]), TIE_DECIMALS)
            order = np.lexsort((cand, h, r))           # by row, distance, id
            r_s = r[order]
            first = np.ones(r_s.shape[0], dtype=bool)
            first[1:] = r_s[1:] != r_s[:-1]
            arg[multi[r_s[first]]] = cand[order][first]
        best[rows] = arg
        dist[rows] = haversine_km_np(plat[rows], plon[rows], slat[arg], slon[arg])
    return best, dist


def _known(lat_col, lon_col):
    """Rows whose coordinates are neither null nor NaN."""
    lat, lon = F.col(lat_col).cast("double"), F.col(lon_col).cast("double")
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def _positions(stations: DataFrame, lat_col, lon_col, id_col) -> DataFrame:
    """Rows (i, a, o): the smallest id of each station position. Other stations of
    a position never win a tie, so they need not be compared."""
    valid = stations.where(_known(lat_col, lon_col) & F.col(id_col).isNotNull())
    return valid.groupBy(F.col(lat_col).cast("double").alias("a"), F.col(lon_col).cast("double").alias("o")).agg(
        F.min(id_col).alias("i")).select("i", "a", "o")


def _station_arrays(stations: DataFrame, lat_col, lon_col, id_col, max_rows):
    # one job: at most max_rows + 1 rows come back, so the bound is checked
    # without ever pulling an unbounded table to the driver
    rows = _positions(stations, lat_col, lon_col, id_col).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    rows.sort(key=lambda r: (r["i"], r["a"], r["o"]))
    sid = np.array([r["i"] for r in rows])
    slat = np.array([r["a"] for r in rows], dtype=float)
    slon = np.array([r["o"] for r in rows], dtype=float)
    return sid, slat, slon


def _nearest_udf(sid, slat, slon):
    """Number of the nearest station (in id order) and its distance."""
    out_type = T.StructType([T.StructField("at", T.LongType()), T.StructField("dist", T.DoubleType())])

    @F.pandas_udf(out_type)
    def nearest(lat: pd.Series, lon: pd.Series) -> pd.DataFrame:
        a = lat.to_numpy(dtype=float, na_value=np.nan)
        o = lon.to_numpy(dtype=float, na_value=np.nan)
        idx, dist = _nearest_numpy(a, o, slat, slon, sid)
        ids = pd.array(idx, dtype="Int64")
        ids[idx < 0] = pd.NA
        return pd.DataFrame({"at": ids, "dist": dist})

    return nearest


def _id_of(number, ids: np.ndarray, id_type) -> Column:
    """The id of a station number: one literal array, bounded like the stations."""
    if not len(ids):
        return F.lit(None).cast(id_type)
    if isinstance(id_type, (T.LongType, T.IntegerType, T.ShortType)) and (np.diff(ids.astype(np.int64)) == 1).all():
        return (number + F.lit(int(ids[0]))).cast(id_type)  # consecutive ids need no array

    @F.pandas_udf(id_type)
    def look_up(at: pd.Series) -> pd.Series:
        known = at.notna().to_numpy()
        out = np.full(len(at), None, dtype=object)
        out[known] = ids[at[known].to_numpy(dtype=np.int64)]
        return pd.Series(out, dtype=object)

    return look_up(number)


def attach_nearest(
    points: DataFrame,
    lat_col: str,
    lon_col: str,
    stations: DataFrame,
    station_lat: str,
    station_lon: str,
    id_col: str,
    prefix: str,
    max_broadcast: int = DEFAULT_MAX_BROADCAST_STATIONS,
    strategy: str = "auto",
) -> DataFrame:
    """Add ``{prefix}_distance_km`` and ``{prefix}_id`` of the nearest
    station (great circle, radius 6371 km). Points with a null coordinate
    get nulls. Every point row is kept."""
    id_type = stations.schema[id_col].dataType
    arrays = None
    if strategy in ("auto", "broadcast"):
        arrays = _station_arrays(stations, station_lat, station_lon, id_col, max_broadcast)
        if arrays is None and strategy == "broadcast":
            raise ValueError(f"more than {max_broadcast} stations: broadcast refused")
    if arrays is not None:
        sid, slat, slon = arrays
        ship_package(points.sparkSession)
        udf = _nearest_udf(np.arange(len(sid)), slat, slon)
        res = udf(F.col(lat_col).cast("double"), F.col(lon_col).cast("double"))
        tmp = f"_{prefix}_nearest"
        return (
            points.withColumn(tmp, res)
            .withColumn(f"{prefix}_distance_km", F.col(f"{tmp}.dist"))
            .withColumn(f"{prefix}_id", _id_of(F.col(f"{tmp}.at"), sid, id_type))
            .drop(tmp)
        )
    return _attach_nearest_grid(points, lat_col, lon_col, stations, station_lat, station_lon, id_col, prefix)


def _attach_nearest_grid(points, lat_col, lon_col, stations, station_lat, station_lon, id_col, prefix):
    """Exact grid search at any size. Point rows get a stable
    id from the checkpointed input so that results can be joined back."""
    pid = "_pt_id"
    pts = cut_lineage(points.withColumn(pid, F.monotonically_increasing_id()))
    st = _positions(stations, station_lat, station_lon, id_col).select(
        F.col("i").alias("_sid"), F.col("a").alias("_slat"), F.col("o").alias("_slon"))
    todo = pts.where(_known(lat_col, lon_col)).select(
        pid, F.col(lat_col).cast("double").alias("_plat"), F.col(lon_col).cast("double").alias("_plon"))
    found = nearest_on_grid(todo, st, pid)
    id_type = stations.schema[id_col].dataType
    out = pts.join(found, pid, "left")
    return out.withColumn(f"{prefix}_distance_km", F.col("_d")).withColumn(
        f"{prefix}_id", F.col("_sid").cast(id_type)).drop(pid, "_d", "_sid")


#: Grid levels: level l has 3 * 2^l cells around a circle of latitude; the finest are about 3 m wide.
MAX_LEVEL = 22
#: Stations that an occupied cell of the level searched first holds on average.
CELL_STATIONS = 4
#: Levels between two steps of the search from above: a cell has at most 16 parts in the next step.
LEVEL_STEP = 2
#: Up to this level the earth has at most 19,000 cells, so their table is a bounded broadcast.
BROADCAST_LEVEL = 6
#: Kept beside every bound (km), for rounding and ties.
_SLACK_KM = 1e-3


def _cell(lat, lon, level: int) -> tuple[Column, Column]:
    """Row and column of a position's cell; columns wrap around the date line."""
    across = 3 * 2 ** level
    c = 360.0 / across
    return F.floor((F.col(lat) + 90.0) / c), F.floor(F.pmod(F.col(lon) + 180.0, F.lit(360.0)) / c) % across


def _least(rows: DataFrame, pid: str) -> DataFrame:
    """Nearest station of each point among joined rows (pid, _plat, _plon, _sid, _d)."""
    best = F.min(F.struct(F.round("_d", TIE_DECIMALS).alias("r"), F.col("_sid").alias("s"), F.col("_d").alias("d")))
    return rows.groupBy(pid, "_plat", "_plon").agg(best.alias("_b"))


def _density_level(st: DataFrame, levels: int) -> int | None:
    """The finest level whose occupied cells hold ``CELL_STATIONS`` stations on
    average (one job; None without stations)."""
    cells = [F.approx_count_distinct(F.struct(*_cell("_slat", "_slon", level))).alias(str(level)) for level in range(levels)]
    n, *occupied = st.agg(F.count(F.lit(1)), *cells).first()
    if not n:
        return None
    return max([level for level, k in enumerate(occupied) if n >= CELL_STATIONS * k], default=0)


def nearest_on_grid(todo: DataFrame, st: DataFrame, pid: str, levels: int = MAX_LEVEL + 1) -> DataFrame:
    """Rows (pid, _sid, _d) for points (pid, _plat, _plon) against stations (_sid,
    _slat, _slon); _sid may be a struct, which orders ties.

    First each point looks at the 3x3 block of cells around it, at the level that the stations'
    density gives; a hit within the block's sure radius is final. The others,
    far from any station, search from above (``candidate_cells``)."""
    level = _density_level(st, levels)
    if level is None:
        return todo.join(st.select("_sid"), F.lit(False)).select(pid, "_sid", F.lit(None).cast("double").alias("_d"))
    across = 3 * 2 ** level
    c = 360.0 / across
    si, sj = _cell("_slat", "_slon", level)
    sc = st.select("*", si.alias("_ci"), sj.alias("_cj"))
    pi, pj = _cell("_plat", "_plon", level)
    around = F.array(*map(F.lit, (-1, 0, 1)))
    block = F.array_distinct(F.flatten(F.transform(around, lambda i: F.transform(
        around, lambda j: F.struct((F.col("_pi") + i).alias("i"), F.pmod(F.col("_pj") + j, F.lit(across)).alias("j"))))))
    ex = todo.withColumn("_pi", pi).withColumn("_pj", pj).select(
        pid, "_plat", "_plon", F.explode(block).alias("_o")).select(
        pid, "_plat", "_plon", F.col("_o.i").alias("_ci"), F.col("_o.j").alias("_cj"))
    distance = haversine_km("_plat", "_plon", "_slat", "_slon").alias("_d")
    best = _least(ex.join(sc, ["_ci", "_cj"]).select(pid, "_plat", "_plon", "_sid", distance), pid)
    # radius surely covered by the block; half a metre less, for ties at its edge
    lat_edge = F.least(F.lit(90.0), F.abs(F.col("_plat")) + F.lit(2 * c))
    guard = F.lit(EARTH_RADIUS_KM) * F.least(
        F.lit(math.radians(c)), F.asin(F.cos(F.radians(lat_edge)) * F.lit(math.sin(math.radians(min(c, 90.0)))))) - F.lit(5e-4)
    done = cut_lineage(best.where(F.col("_b.d") <= guard))
    found = done.select(pid, F.col("_b.s").alias("_sid"), F.col("_b.d").alias("_d"))
    far = cut_lineage(todo.join(done.select(pid), pid, "left_anti"))
    if far.isEmpty():
        return found
    cells = candidate_cells(far, st, pid, level)
    best = _least(cells.join(sc, ["_ci", "_cj"]).select(pid, "_plat", "_plon", "_sid", distance), pid)
    return found.unionByName(best.select(pid, F.col("_b.s").alias("_sid"), F.col("_b.d").alias("_d")))


def candidate_cells(todo: DataFrame, st: DataFrame, pid: str, level: int) -> DataFrame:
    """Rows (pid, _plat, _plon, _ci, _cj): the occupied cells of ``level`` that may hold
    a point's nearest station.

    The search goes down from the coarsest cells. An occupied cell has one station as its sample,
    whose distance bounds the nearest one from above, and the box of its stations: the distance to the
    box's middle less the box's reach bounds all of them from below. Cells whose lower bound is beyond
    the point's least upper bound are left out, and only parts of the cells left are looked at next. So a
    point meets few cells a step, however many stations lie together and however far away they are."""
    steps = sorted({level, *range(level % LEVEL_STEP, level, LEVEL_STEP)})
    # every cell of the first step: at most 3 * 2^l columns and half as many rows
    across = 3 * 2 ** steps[0]
    every = [F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i in range(across // 2 + 1) for j in range(across)]
    todo = todo.select(pid, "_plat", "_plon", F.lit(float("inf")).alias("_up"), F.explode(F.array(*every)).alias("_o")).select(
        pid, "_plat", "_plon", "_up", F.col("_o.i").alias("_pi"), F.col("_o.j").alias("_pj"))
    lon = F.pmod(F.col("_slon") + 180.0, F.lit(360.0))
    for above, at in zip([steps[0], *steps], steps):
        si, sj = _cell("_slat", "_slon", at)
        cells = st.groupBy(si.alias("_ci"), sj.alias("_cj")).agg(
            F.min("_slat").alias("_a0"), F.max("_slat").alias("_a1"), F.min(lon).alias("_o0"), F.max(lon).alias("_o1"),
            F.min_by("_slon", "_slat").alias("_so"))
        shrink = 2 ** (at - above)
        middle_lat, middle_lon = (F.col("_a0") + F.col("_a1")) / 2, (F.col("_o0") + F.col("_o1")) / 2 - 180.0
        # along the middle's parallel, then along a meridian: no shorter than the great circle
        reach = EARTH_RADIUS_KM * (
            F.radians((F.col("_o1") - F.col("_o0")) / 2) * F.cos(F.radians(middle_lat)) + F.radians((F.col("_a1") - F.col("_a0")) / 2))
        cells = cells.select(
            "_ci", "_cj", F.floor(F.col("_ci") / shrink).alias("_pi"), F.floor(F.col("_cj") / shrink).alias("_pj"),
            F.col("_a0").alias("_sa"), "_so", middle_lat.alias("_ma"), middle_lon.alias("_mo"), reach.alias("_reach"))
        met = todo.join(F.broadcast(cells) if at <= BROADCAST_LEVEL else cells, ["_pi", "_pj"]).select(
            pid, "_plat", "_plon", "_ci", "_cj",
            F.least("_up", haversine_km("_plat", "_plon", "_sa", "_so")).alias("_up"),
            (haversine_km("_plat", "_plon", "_ma", "_mo") - F.col("_reach")).alias("_low"))
        # a point's cells of one step are few, so a window by point is no hot group
        todo = met.withColumn("_up", F.min("_up").over(Window.partitionBy(pid))).where(
            F.col("_low") <= F.col("_up") + _SLACK_KM).select(
            pid, "_plat", "_plon", "_up", F.col("_ci").alias("_pi"), F.col("_cj").alias("_pj"))
    return todo.select(pid, "_plat", "_plon", F.col("_pi").alias("_ci"), F.col("_pj").alias("_cj"))


def nearest_station_with_attrs(
    points: DataFrame,
    stations: DataFrame,
    lat_col: str = "lat",
    lon_col: str = "lon",
    id_col: str = "id_gare",
    name_col: str = "nom_gare",
    attrs=("date_signature", "date_ouverture"),
    name_join: bool = False,
    max_broadcast: int = DEFAULT_MAX_BROADCAST_STATIONS,
) -> DataFrame:
    """D3: nearest station + distance + its attributes; station lat/lon come
    back as ``lat_gare``/``lon_gare``. ``name_join=True`` re-joins by name
    as the reference does (a repeated name multiplies rows)."""
    with_id = attach_nearest(points, lat_col, lon_col, stations, "latitude", "longitude", id_col, "_near",
                             max_broadcast=max_broadcast)
    with_id = with_id.withColumnRenamed("_near_distance_km", "distance_gare_km")
    attrs = [a for a in attrs if a in stations.columns]
    side = stations.select(
        F.col(id_col).alias("_near_id"), F.col(name_col).alias("nearest_gare"),
        *[F.col(a) for a in attrs],
        F.col("latitude").alias("lat_gare"), F.col("longitude").alias("lon_gare"))
    if name_join:
        names = with_id.join(side.select("_near_id", "nearest_gare"), "_near_id", "left")
        by_name = side.drop("_near_id").withColumnRenamed("nearest_gare", "_n")
        return names.join(by_name, names.nearest_gare == by_name._n, "left").drop("_n", "_near_id")
    # adaptive execution broadcasts the stations if their run-time size allows it
    return with_id.join(side, "_near_id", "left").drop("_near_id")


def nearest_address(
    stations: DataFrame,
    register: DataFrame,
    id_col: str = "id_gare",
    max_km: float | None = None,
) -> DataFrame:
    """D15 (re-aimed reverse geocoding): for each station, the nearest
    register address -> postcode, city, department (B26).

    The grid search with the stations as points: register rows meet stations by cell
    keys, at any size of either side. Ties: (rounded distance, postcode, city, number,
    street)."""
    st = stations.where(_known("latitude", "longitude") & F.col(id_col).isNotNull()).select(
        F.struct(F.col(id_col).alias("id"), F.col("latitude").cast("double").alias("a"), F.col("longitude").cast("double").alias("o")).alias("_sid"),
        F.col("latitude").cast("double").alias("_plat"), F.col("longitude").cast("double").alias("_plon")).distinct()
    address = F.struct("code_postal", "nom_commune", "numero", "nom_voie")
    reg = register.where(_known("lat", "lon")).groupBy(F.col("lat").cast("double").alias("_slat"), F.col("lon").cast("double").alias("_slon")).agg(
        F.min(address).alias("_address"))
    found = nearest_on_grid(
        st.withColumnRenamed("_sid", "_station"), reg.withColumnRenamed("_address", "_sid"), "_station")
    if max_km is not None:
        found = found.where(F.col("_d") <= max_km)
    # an id at several positions: the nearest address of all of them
    found = found.groupBy(F.col("_station.id").alias(id_col)).agg(
        F.min(F.struct(F.round("_d", TIE_DECIMALS).alias("r"), F.col("_sid").alias("x"), F.col("_d").alias("d"))).alias("b"))
    found = found.select(
        id_col,
        F.col("b.x.code_postal").alias("code_postal"),
        F.col("b.x.nom_commune").alias("ville"),
        department_from_postcode(F.col("b.x.code_postal")).alias("departement"),
        F.col("b.d").alias("address_distance_km"),
    )
    return stations.join(found, id_col, "left")
