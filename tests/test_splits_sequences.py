import datetime as dt

from pyspark.sql import functions as F

from transit_prices.operators import sequences, splits


def test_global_positions(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    pos = splits.global_positions(df, ["k"]).collect()
    assert sorted(r["_pos"] for r in pos) == list(range(1000))
    assert all(r["_pos"] == r["k"] for r in pos)


def test_chrono_split_properties(spark):
    rows = [(i, 2000 + i % 7, dt.date(2000 + i % 7, 1 + i % 12, 1)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, annee int, d date")
    out = splits.chrono_split(df, "annee", 2001, 2005, 0.2, tie_cols=["d", "id"]).collect()
    kept = [r for r in rows if 2001 <= r[1] <= 2005]
    assert len(out) == len(kept)
    train = [r for r in out if r["split"] == "train"]
    test = [r for r in out if r["split"] == "test"]
    assert len(train) == int(len(kept) * 0.8)
    assert max((r["annee"], r["d"], r["id"]) for r in train) < min((r["annee"], r["d"], r["id"]) for r in test)


def _panel(spark, lengths):
    rows = []
    for s, n in lengths.items():
        for t in range(n):
            y = None if (s == "c" and t == 7) else float(t)
            rows.append((s, dt.date(2000 + t // 12, 1 + t % 12, 1), float(t), y))
    return spark.createDataFrame(rows, "station string, date date, f double, y double")


def test_sequence_counts(spark):
    lengths = {"a": 20, "b": 5, "c": 15}
    p = _panel(spark, lengths)
    single = sequences.sequences(p, "station", "date", ["f"], "y", 6)
    assert single.count() == sum(max(0, n - 6) for n in lengths.values())
    multi = sequences.sequences(p, "station", "date", ["f"], "y", 6, horizon=3, multi=True)
    # station c misses y at t=7: of its windows (t >= 6), those with t in
    # 6..7 have it among their targets and are skipped
    expect = max(0, 20 - 6 - 3 + 1) + max(0, 15 - 6 - 3 + 1) - 2
    assert multi.count() == expect
    for r in multi.collect():
        xs = [s["f"] for s in r["x"]]
        assert len(xs) == 6 and xs == sorted(xs) and r["y"][0] == xs[-1] + 1   # never crosses stations


def test_last_n_and_date_split(spark):
    p = _panel(spark, {"a": 30, "b": 10})
    out = splits.last_n_split(p, "station", "date", 12).groupBy("station", "split").count().collect()
    got = {(r["station"], r["split"]): r["count"] for r in out}
    assert got == {("a", "train"): 18, ("a", "test"): 12, ("b", "reject"): 10}
    ds = splits.date_split(p, "date", "2001-01-01", "2001-06-01")
    assert ds.where("split = 'test'").count() == 6
    import pytest

    with pytest.raises(ValueError):
        splits.date_split(p, "date", "2030-01-01", "2030-06-01")


def test_positions_with_a_payload(spark):
    n = 1_000_000
    df = spark.range(n, numPartitions=8).select(
        ((F.col("id") * 7919) % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"), F.rand(3).alias("x"))
    pos = splits.global_positions(df, ["k"], num_partitions=16)
    r = pos.agg(F.countDistinct("_pos").alias("d"), F.max("_pos").alias("m"), F.sum((F.col("_pos") != F.col("k")).cast("int")).alias("wrong"), F.max("payload")).first()
    assert (r["d"], r["m"], r["wrong"]) == (n, n - 1, 0)


def test_splits_with_a_payload_equal_row_number(spark):
    from pyspark.sql import Window

    n = 20_000
    df = spark.range(n).select("id", (F.lit(2000) + F.col("id") % 3).alias("year"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    df = df.withColumn("s", F.when(F.col("id") % 11 != 0, F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))))
    for share in (0.0, 0.1, 0.37, 0.8, 1.0):
        w = Window.orderBy("s", "id")
        want = df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= int(n * share)).select("id")
        got = splits.positional_split(df, ["s", "id"], share)
        assert got.count() == n
        train = got.where("split = 'train'").select("id")
        assert train.count() == int(n * share) and train.exceptAll(want).isEmpty()
    got = splits.chrono_split(df, "year", 2000, 2001, 0.2, tie_cols=["payload", "id"])
    kept = df.where("year <= 2001")
    want = kept.withColumn("rn", F.row_number().over(Window.orderBy("year", "payload", "id"))).where(F.col("rn") <= int(kept.count() * 0.8))
    assert got.where("split = 'train'").select("id").exceptAll(want.select("id")).isEmpty() and got.count() == kept.count()
