import datetime as dt

from transit_prices.operators import did, panel


def test_did_rules(spark):
    rows = [
        # group 1: pre and post
        (1, -2, 110.0, 100.0, 3), (1, -1, 120.0, 100.0, 2), (1, 0, 130.0, 100.0, 4), (1, 1, 150.0, 100.0, 1),
        # group 2: pre only -> dropped
        (2, -3, 100.0, 100.0, 1),
        # group 3: one row each, plus a null control that is ignored
        (3, -1, 100.0, 100.0, 1), (3, 2, 110.0, 100.0, 5), (3, 3, 110.0, None, 9),
    ]
    p = spark.createDataFrame(rows, "g int, relative_signature_year int, prix_m2_mean double, ctrl double, n_transactions long")
    out = {r["g"]: r for r in did.did_by_group(p, "ctrl", "g").collect()}
    assert set(out) == {1, 3}
    r = out[1]
    assert abs(r["pre_mean"] - 15.0) < 1e-9 and abs(r["post_mean"] - 40.0) < 1e-9 and abs(r["ate_pct"] - 25.0) < 1e-9
    assert (r["n_pre"], r["n_post"], r["n_tx_pre"], r["n_tx_post"], r["n_obs"], r["n_transactions"]) == (2, 2, 5, 5, 4, 10)
    import statistics

    sd = statistics.stdev([-10.0, -20.0, 30.0, 50.0])
    assert abs(r["ci_low_pct"] - (25 - 1.96 * sd / 2)) < 1e-9
    assert list(did.did_by_group(p, "ctrl", "g").columns) == ["g"] + did.DID_COLUMNS


def test_did_overlapping_windows_count_twice(spark):
    p = spark.createDataFrame([(1, 0, 110.0, 100.0, 1)], "g int, relative_signature_year int, prix_m2_mean double, ctrl double, n_transactions long")
    r = did.did_by_group(p, "ctrl", "g", pre_window=(-1, 0), post_window=(0, 1)).first()
    assert (r["n_pre"], r["n_post"], r["n_obs"]) == (1, 1, 2)


def test_complete_month_filter(spark):
    d = lambda m: dt.date(2020, m, 5)
    rows = [("a", d(1), "Appartement", "Vente", 1.0), ("a", d(2), "Maison", "Vente", 2.0),
            ("b", d(1), None, "Echange", 3.0)]
    df = spark.createDataFrame(rows, "station string, date date, type_local string, nature_mutation string, x double")
    full = panel.station_month_features(df, "date", "station", ["x"], complete_only=False).collect()
    assert len(full) == 3
    comp = panel.station_month_features(df, "date", "station", ["x"]).collect()
    assert {r["station"] for r in comp} == {"a"}
    b = [r for r in full if r["station"] == "b"][0]
    assert b["share_appartement"] == 0.0 and b["share_vente"] == 0.0   # null counts as not equal


def test_global_modes(spark):
    from transit_prices.operators import panel

    df = spark.createDataFrame([("b", 2, None), ("a", 2, None), ("a", 1, None), ("b", None, None), (None, 1, None)], "p string, q int, r string")
    # ties go to the smallest value, nulls do not count
    assert tuple(panel.global_modes(df, ["p", "q", "r"]).first()) == ("a", "1", None)
