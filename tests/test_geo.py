import math
import random

from pyspark.sql import functions as F

from transit_prices.functions.numeric import haversine_km_np
from transit_prices.operators import geo


def brute(points, stations):
    out = []
    for pid, a, o in points:
        if a is None or o is None:
            out.append((pid, None, None))
            continue
        best = min(stations, key=lambda s: (round(float(haversine_km_np(a, o, s[1], s[2])), 9), s[0]))
        out.append((pid, best[0], float(haversine_km_np(a, o, best[1], best[2]))))
    return out


def _data(spark, n_points=400, n_stations=40, seed=7):
    rng = random.Random(seed)
    stations = [(i, 48.6 + rng.random() * 0.5, 2.0 + rng.random() * 0.8) for i in range(n_stations)]
    pts = [(i, 48.6 + rng.random() * 0.5, 2.0 + rng.random() * 0.8) for i in range(n_points)]
    pts.append((n_points, None, 2.3))                                  # null latitude
    pts.append((n_points + 1, stations[3][1], stations[3][2]))         # on a station
    # equidistant from stations 0 and 1 placed symmetrically around it
    stations += [(100, 48.70, 2.50), (101, 48.70, 2.52)]
    pts.append((n_points + 2, 48.70, 2.51))
    sdf = spark.createDataFrame(stations, "station_id long, latitude double, longitude double")
    pdf = spark.createDataFrame(pts, "pid long, lat double, lon double")
    return pts, stations, pdf, sdf


def _check(got, want):
    g = {r[0]: (r[1], r[2]) for r in got}
    for pid, sid, d in want:
        assert g[pid][0] == sid, pid
        if d is None:
            assert g[pid][1] is None
        else:
            assert math.isclose(g[pid][1], d, rel_tol=1e-9, abs_tol=1e-9)


def test_nearest_broadcast_equals_brute_force(spark):
    pts, stations, pdf, sdf = _data(spark)
    out = geo.attach_nearest(pdf, "lat", "lon", sdf, "latitude", "longitude", "station_id", "gp")
    got = [(r["pid"], r["gp_id"], r["gp_distance_km"]) for r in out.collect()]
    _check(got, brute(pts, stations))
    tie = [g for g in got if g[0] == 402][0]
    assert tie[1] == 100                         # equal distance -> smaller id


def test_nearest_grid_equals_brute_force(spark):
    pts, stations, pdf, sdf = _data(spark, n_points=150, n_stations=25, seed=11)
    out = geo.attach_nearest(pdf, "lat", "lon", sdf, "latitude", "longitude", "station_id", "gp", strategy="grid")
    got = [(r["pid"], r["gp_id"], r["gp_distance_km"]) for r in out.collect()]
    _check(got, brute(pts, stations))


def test_nearest_keeps_duplicate_rows_and_no_shuffle(spark):
    _, _, pdf, sdf = _data(spark, n_points=50, n_stations=5)
    dup = pdf.unionByName(pdf)
    out = geo.attach_nearest(dup, "lat", "lon", sdf, "latitude", "longitude", "station_id", "gp")
    assert out.count() == 2 * pdf.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_nearest_address(spark):
    st = spark.createDataFrame([(1, 48.70, 2.30), (2, None, None)], "id_gare int, latitude double, longitude double")
    reg = spark.createDataFrame([("1", "RUE A", "75001", "PARIS", 2.3001, 48.7001), ("2", "RUE B", "92100", "BOULOGNE", 2.5, 48.9)],
                                "numero string, nom_voie string, code_postal string, nom_commune string, lon double, lat double")
    out = {r["id_gare"]: r for r in geo.nearest_address(st, reg).collect()}
    assert out[1]["code_postal"] == "75001" and out[1]["departement"] == "75" and out[1]["ville"] == "PARIS"
    assert out[2]["code_postal"] is None


def test_grid_equals_broadcast_at_the_edges(spark):
    rng = random.Random(11)
    stations = [(f"s{i:02d}", rng.choice([-89.9, -60.0, 0.0, 48.0, 89.5]) + rng.random() * 0.4, lon) for i, lon in enumerate(
        [-179.999, 179.985, 179.9, -179.5, 0.0, 2.0, 2.0, 90.0, -90.0, 120.0, 45.0, -10.0])]
    stations += [("zz", stations[0][1], stations[0][2]), ("aa", stations[3][1], stations[3][2]), ("nan", float("nan"), 1.0), ("null", None, 1.0)]
    pts = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(120)]
    pts += [(200, stations[0][1], 179.999), (201, float("nan"), 2.0), (202, None, 2.0), (203, 90.0, 0.0), (204, -90.0, 77.0), (205, 0.0, -180.0), (206, 0.0, 180.0)]
    pts += [(300 + i, a, o) for i, (_, a, o) in enumerate(stations[:12])]
    sdf = spark.createDataFrame(stations, "station_id string, latitude double, longitude double")
    pdf = spark.createDataFrame(pts, "pid long, lat double, lon double")
    good = [s for s in stations if s[1] is not None and not math.isnan(s[1])]
    want = brute([(i, None if a is None or math.isnan(a) else a, o) for i, a, o in pts], good)
    for strategy in ("broadcast", "grid"):
        out = geo.attach_nearest(pdf, "lat", "lon", sdf, "latitude", "longitude", "station_id", "gp", strategy=strategy)
        _check(out.select("pid", "gp_id", "gp_distance_km").collect(), want)


def test_dense_cell_and_ties_on_the_grid(spark):
    # many stations in one cell, many at one position
    stations = [(i, 48.70 + (i % 40) * 1e-5, 2.30) for i in range(400)]
    pts = [(i, 48.70 + i * 1e-5, 2.31) for i in range(40)]
    sdf = spark.createDataFrame(stations, "station_id long, latitude double, longitude double")
    pdf = spark.createDataFrame(pts, "pid long, lat double, lon double")
    out = geo.attach_nearest(pdf, "lat", "lon", sdf, "latitude", "longitude", "station_id", "gp", strategy="grid")
    _check(out.select("pid", "gp_id", "gp_distance_km").collect(), brute(pts, stations))


def test_far_points_meet_few_cells(spark):
    # all stations in one corner, the points far from it or just outside
    rng = random.Random(3)
    stations = [(i, 48.0 + rng.random() * 0.3, 2.0 + rng.random() * 0.3) for i in range(3000)]
    pts = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(60)] + [(100 + i, 48.5 + i * 0.05, 2.1) for i in range(20)]
    sdf = spark.createDataFrame(stations, "_sid long, _slat double, _slon double")
    pdf = spark.createDataFrame(pts, "pid long, _plat double, _plon double")
    level = geo._density_level(sdf, geo.MAX_LEVEL + 1)
    per_cell = sdf.groupBy(*geo._cell("_slat", "_slon", level)).count().agg(F.avg("count"), F.max("count")).first()
    assert per_cell[0] >= 3 and per_cell[1] < 60
    cells = geo.candidate_cells(pdf, sdf, "pid", level).groupBy("pid").count()
    seen = {r["pid"]: r["count"] for r in cells.collect()}
    assert len(seen) == 80 and max(seen.values()) <= 40       # of about 700 occupied cells
    got = geo.nearest_on_grid(pdf, sdf, "pid").collect()
    _check([(r["pid"], r["_sid"], r["_d"]) for r in got], brute(pts, stations))


def test_grid_without_stations_or_points(spark):
    none = spark.createDataFrame([], "station_id long, latitude double, longitude double")
    one = spark.createDataFrame([(7, 48.7, 2.3)], "station_id long, latitude double, longitude double")
    pdf = spark.createDataFrame([(1, 10.0, 20.0), (2, None, 2.0)], "pid long, lat double, lon double")
    near = lambda p, s: geo.attach_nearest(p, "lat", "lon", s, "latitude", "longitude", "station_id", "gp", strategy="grid")
    assert [r["gp_id"] for r in near(pdf, none).orderBy("pid").collect()] == [None, None]
    assert [r["gp_id"] for r in near(pdf, one).orderBy("pid").collect()] == [7, None]
    assert near(pdf.limit(0), one).count() == 0
