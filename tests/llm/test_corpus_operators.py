"""Operators over whole corpora, against brute force."""

from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from transit_prices.llm import chunks, common, licenses, mixing, simhash, topk
from transit_prices.llm.queries import ORACLE_SQL


def brute_components(fps, max_bits=3):
    label = np.arange(len(fps))
    while True:
        new = np.array([label[np.bitwise_count(fps ^ f) <= max_bits].min() for f in fps])
        new = np.minimum(new, label)
        if (new == label).all():
            return label
        label = new


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(100, 160)] + [(300, j) for j in range(301, 340)] + [tuple(map(int, rng.integers(0, 90, 2))) for _ in range(60)]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_every_near_pair_meets_at_an_anchor():
    rng = np.random.default_rng(1)
    for width, reach in ((32, 1), (31, 1), (21, 1), (32, 2)):
        code = simhash.Covering(width, reach)
        x = rng.integers(0, 1 << width, 400, dtype=np.uint64)
        flips = np.zeros(400, dtype=np.uint64)
        for _ in range(reach):
            flips |= np.uint64(1) << rng.integers(0, width, 400).astype(np.uint64)
        row, anchor, home = code.anchors(x)
        at_home = dict(zip(row[home].tolist(), anchor[home].tolist()))
        assert len(at_home) == 400
        row2, anchor2, _ = code.anchors(x ^ flips)
        met = defaultdict(set)
        for r, a in zip(row2.tolist(), anchor2.tolist()):
            met[r].add(a)
        assert all(at_home[i] in met[i] for i in range(400))


@pytest.mark.parametrize("split", [10, 8192])
def test_links(spark, split):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63, 8, dtype=np.uint64)
    fps = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for c in centre for _ in range(60)]
    fps = np.unique(np.array(fps, dtype=np.uint64))
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = simhash.links(frame, split_rows=split).collect()
    a = np.array([r["a"] for r in got], dtype=np.int64).view(np.uint64)
    b = np.array([r["b"] for r in got], dtype=np.int64).view(np.uint64)
    assert (np.bitwise_count(a ^ b) <= 3).all() and (a != b).all()
    # as many components as with all pairs
    label = {int(f): i for i, f in enumerate(fps)}
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, y in zip(a.tolist(), b.tolist()):
        i, j = find(label[x]), find(label[y])
        parent[max(i, j)] = min(i, j)
    want = brute_components(fps)
    assert [find(i) for i in range(len(fps))] == want.tolist()


def test_near_duplicates(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    rows = [r for r in odd_docs.collect()]
    assert len(got) == len(rows)
    fps = np.array([simhash.fingerprint((r["text"] or "").encode()) for r in rows], dtype=np.uint64)
    label = brute_components(fps)
    least = {}
    for r, c in zip(rows, label):
        ids = [x for x in (least.get(c), r["doc_id"]) if x is not None]
        least[c] = min(ids) if ids else None
    want = Counter((r["doc_id"], f"{int(f):016x}", least[c]) for r, f, c in zip(rows, fps, label))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    kept = simhash.keep_representatives(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted({(v is None, v or 0) for v in least.values()})
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_representatives(no_docs).count() == 0


def test_one_row_of_each_component_stays(spark):
    rng = np.random.default_rng(5)
    text = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10**6, 80))
    a, b, c, d, e = (text() for _ in range(5))
    near = f"{e} tail"
    assert 0 < (simhash.fingerprint(e.encode()) ^ simhash.fingerprint(near.encode())).bit_count() <= 12
    # three groups without ids, two groups under one id, a near copy whose id names another group
    rows = [(None, a), (None, a), (None, b), (None, c), (7, d), (7, text()), (7, d), (3, e), (7, near), (3, e)]
    kept = simhash.keep_representatives(spark.createDataFrame(rows, "doc_id long, text string"), max_bits=12, pieces=6).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted({(None, a), (None, b), (None, c), (7, d), (7, rows[5][1]), (3, e)}, key=repr)


def test_fingerprint_by_definition():
    import xxhash

    words = [b"b", b"a", b"c", b"a", b"c", b"b"]
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(4)]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > 4)
    assert simhash.fingerprint(b" B a\nC  a c\x0bb ") == want
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0
    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest(b"one two", 42)


def test_chunks_resist_shifts():
    rng = np.random.default_rng(3)
    gear = chunks.gear_table()
    passage = bytes(rng.integers(97, 123, 2000, dtype=np.uint8))
    cut = lambda t: chunks.cut_points([t], gear, chunks.MIN_CHUNK, chunks.MAX_CHUNK, chunks.BOUNDARY_BITS)[0]
    pieces = lambda t: [t[a:b] for a, b in zip([0, *cut(t)], cut(t))]
    for shift in range(1, 60, 7):
        moved = bytes(rng.integers(97, 123, shift, dtype=np.uint8)) + passage
        assert b"".join(pieces(moved)) == moved
        assert len(set(pieces(moved)) & set(pieces(passage))) > 0.8 * len(pieces(passage))
    # the rolling hash by its definition
    data = np.frombuffer(passage, dtype=np.uint8)
    h = chunks.gear_hash(data, gear)
    for i in (0, 3, 15, 16, 500):
        assert h[i] == sum(int(gear[data[i - j]]) << j for j in range(min(i + 1, 16))) % 65536
    # several texts in one go are cut as each alone, and never inside a character
    texts = ["é" * 700, "", "x", "日本" * 400, "abc " * 300]
    raw = [t.encode() for t in texts]
    together = chunks.cut_points(raw, gear, chunks.MIN_CHUNK, chunks.MAX_CHUNK, chunks.BOUNDARY_BITS)
    assert together == [cut(t) for t in raw]
    for t, ends in zip(raw, together):
        for a, b in zip([0, *ends], ends):
            t[a:b].decode()


def brute_dedup(rows):
    """Texts after removal, by (id, text): sequential over ids and positions."""
    gear = chunks.gear_table()
    docs = sorted({(r["doc_id"], r["text"]) for r in rows if r["text"]}, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    seen, out = {}, {}
    cut = {d: chunks.cut_points([d[1].encode()], gear, chunks.MIN_CHUNK, chunks.MAX_CHUNK, chunks.BOUNDARY_BITS)[0] for d in docs}
    for d in docs:
        for n, (a, b) in enumerate(zip([0, *cut[d]], cut[d])):
            seen.setdefault(d[1].encode()[a:b], (d, n))
    for d in docs:
        raw, spans = d[1].encode(), []
        for n, (a, b) in enumerate(zip([0, *cut[d]], cut[d])):
            if seen[raw[a:b]] != (d, n):
                if spans and spans[-1][1] == a:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
        keep, at = b"", 0
        for a, b in spans:
            if b - a >= chunks.MIN_RUN:
                keep, at = keep + raw[at:a], b
        out[d] = (keep + raw[at:]).decode()
    return out


def test_chunk_dedup(spark, odd_docs, no_docs):
    got = chunks.without_repeats(odd_docs)
    rows = odd_docs.collect()
    want = brute_dedup(rows)
    have = Counter((r["doc_id"], r["text"]) for r in got.collect())
    assert have == Counter((r["doc_id"], want.get((r["doc_id"], r["text"]), r["text"])) for r in rows)
    assert any(r["text"] != want.get((r["doc_id"], r["text"]), r["text"]) for r in rows)
    assert chunks.without_repeats(no_docs).count() == 0


def test_passages_of_fifty_words_are_found(spark):
    import random

    rng = random.Random(5)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passages = [fresh(55) for _ in range(30)]
    docs = [(i, fresh(80) + " " + passages[i // 2] + " " + fresh(70)) for i in range(60)] + [(100 + i, fresh(200)) for i in range(40)]
    got = {r["row"]["doc_id"]: r for r in chunks.cut_rows(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    hit = [i for i in range(1, 60, 2) if got[i]["cut"]]
    assert len(hit) >= 28 and all(got[i]["cut"]["first_doc_ids"] == [i - 1] for i in hit)
    assert not any(got[i]["cut"] for i in [*range(0, 60, 2), *range(100, 140)])
    plain = chunks.without_repeats(spark.createDataFrame([(i, t, "mine") for i, t in docs], "doc_id long, text string, cut string")).collect()
    assert {(r["doc_id"], r["text"], r["cut"]) for r in plain} == {(i, r["text"], "mine") for i, r in got.items()}


def test_mix_equals_sql(spark, odd_docs, no_docs):
    con = duckdb.connect()
    documents = odd_docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con.register("documents", documents)
    want = con.execute(ORACLE_SQL["op9_mix"]).fetchall()
    got = mixing.mix(odd_docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2], r[3], round(r[4], 6), r[5], r[6])
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert sorted(map(key, mixing.mix(odd_docs.repartition(7)).collect())) == sorted(map(key, got))
    assert mixing.mix(no_docs).count() == 0


def test_targets_by_filling_up(spark):
    rng = np.random.default_rng(7)
    for _ in range(3):
        sizes = [int(x) for x in rng.integers(0, 10_000, 9) ** rng.integers(1, 3)]
        frame = spark.createDataFrame([(None if i == 8 else f"s{i}", s) for i, s in enumerate(sizes)], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
        weight = [mixing.WEIGHTS[i % 3] for i in range(9)]
        target, full, left = [0.0] * 9, set(), 1.5 * sum(sizes)
        while left > 1e-6 and len(full) < 9:  # deal out by weight, cut at the caps, deal the excess again
            free = [i for i in range(9) if i not in full]
            total = sum(weight[i] for i in free)
            for i in free:
                target[i] += left * weight[i] / total
            left = 0.0
            for i in free:
                if target[i] >= 2 * sizes[i]:
                    left += target[i] - 2 * sizes[i]
                    target[i] = 2.0 * sizes[i]
                    full.add(i)
        for i in range(9):
            assert got[None if i == 8 else f"s{i}"] == pytest.approx(target[i], rel=1e-9, abs=1e-6)


def test_mix_meets_targets_and_weights(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.repeat(F.lit("w "), F.lit(20)).alias("text"), (F.col("id") % 2 + 1).alias("odds"))
    for options in ({}, {"weight_col": "odds"}):
        got = mixing.mix(docs, **options)
        for r in got.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("x"), F.max("copies").alias("m")).collect():
            assert abs(r["x"] - r["t"]) <= 10 and r["m"] <= 2
    share = {r["odd"]: r["x"] for r in got.where("source = 'b'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg("copies").alias("x")).collect()}
    assert share[1] > 1.5 * share[0]
    assert mixing.repeated(docs.drop("odds")).count() == mixing.mix(docs).agg(F.sum("copies")).first()[0]


def vectors(spark, rng, n=400, d=10):
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[5] = x[50]
    rows = [(int(i), [float(v) for v in x[i]]) for i in range(n)]
    rows += [(1001, None), (1002, [1.0, None]), (1003, [float("nan")] * d), (1050, [float("inf")] * d), (None, [1.0] * d), (1004, []), (1005, [1.0, 2.0]), (7, rows[7][1])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.mark.parametrize("lists,block", [(1, 2048), (2, 3), (3, 2048)])
def test_top_k(spark, lists, block):
    rows, frame = vectors(spark, np.random.default_rng(4))
    got = topk.top_k(frame, F.col("id") % 50 == 0, lists=lists, block=block).collect()
    good = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in good:
        if q % 50 == 0:
            scored = sorted(((-int(v[: len(w)] @ w[: len(v)]), i) for i, w in good if i != q))[:5]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_of_few_and_none(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, F.col("id") % 50 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-3.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(few, F.col("id") % 50 == 0).collect())) == [(0, 1, 1, 256 * 512), (0, 2, 2, -256 * 768)]
    large = spark.createDataFrame([(0, [1e10, 1.0]), (1, [1e3, 2.0]), (2, [1e3, 3.0])], "vec_id long, embedding array<double>")
    got = topk.top_k(large, F.col("id") % 50 == 0).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(2, 256 * 10**10 * 256_000 + 256 * 768), (1, 256 * 10**10 * 256_000 + 256 * 512)]


def test_licenses_wrapped_inside_and_whole(spark):
    prose = "a quiet river under the bridge in winter morning light"
    rare = " ".join(f"zw{i}" for i in range(80))
    texts = dict(licenses.FILES[:-1])
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    want = [
        (f"{prose}\n\n{gpl}\n\n{rare}", "GPL-3.0", False), ("\n".join(f"# {x}" for x in gpl.split("\n")) + f"\n{rare}", "GPL-3.0", False),
        (f"{prose}\n{bsd}\n{rare}", "BSD-3-Clause", False), (f"{prose}. Released under the MIT License. {rare}.", "MIT", False),
        (f"{prose}\n{prose}", None, False), *((f"Copyright (c) 2020 Jane Doe\n\n{t}", name, True) for name, t in texts.items()),
    ]
    docs = [(i, f"{i}/x", t) for i, (t, _, _) in enumerate(want)] + [(i, f"{i}/x", f"{prose} {i}") for i in range(100, 160)]
    got = {r["doc_id"]: (r["license"], r["is_license_file"]) for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, path string, text string")).collect()}
    assert [got[i] for i in range(len(want))] == [(name, file) for _, name, file in want]
    assert set(texts) == {"MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0"}


def test_licenses(spark, no_docs):
    prose = "a quiet river under the bridge in winter morning light"
    rows = [
        (0, "r/LICENSE", "Released under the MIT License."), (1, "r/a/x.txt", prose), (2, "r/a/b/y.txt", f"{prose}\nLicensed under the Apache License, Version 2.0.\n{prose}"),
        (3, "r/a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."), (4, "r/a/b/c/d/z.txt", prose), (5, "other/x.txt", prose),
        (6, None, "Licensed under CC BY-NC 4.0."), (7, "r/empty", ""), (8, "r/null", None), (8, "r/null", None), (9, "top.txt", f"{prose}, licensed driver, public version of the general terms"),
        (None, "q/LICENSE", "Released under the MIT License."), (11, "q/w.txt", prose),
    ]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, path string, text string, license string, twin string")
    got = [(r["doc_id"], r["license"], r["inherited_license"], r["inherited_from"], r["is_license_file"]) for r in licenses.scan(docs).collect()]
    want = [
        (0, "MIT", None, None, True), (1, None, "MIT", "r", False), (2, "Apache-2.0", None, None, False), (3, "GPL-3.0", None, None, True),
        (4, None, "GPL-3.0", "r/a/b", False), (5, None, None, None, False), (6, "CC-BY-NC-4.0", None, None, True), (7, None, "MIT", "r", False),
        (8, None, "MIT", "r", False), (8, None, "MIT", "r", False), (9, None, None, None, False), (None, "MIT", None, None, True), (11, None, "MIT", "q", False),
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert licenses.scan(no_docs.withColumn("path", F.lit("p"))).count() == 0


def test_mix_with_null_and_repeated_ids_meets_targets(spark):
    """Rows without an id, and rows alike in everything, are drawn each on its own."""
    words = " ".join(["word"] * 20)
    for texts in ([f"{words} {i}" for i in range(100)], [words] * 100):
        rows = [(None if s in "abcd" else 7, s, t, "x") for s in "abcd" for t in texts]
        docs = spark.createDataFrame(rows, "doc_id long, source string, text string, copies string").repartition(3)
        got = mixing.mix(docs).collect()
        assert len(got) == 400
        out = mixing.repeated(docs).collect()
        for s in "abcd":
            target = next(r["target"] for r in got if r["source"] == s)
            taken = sum(r["taken"] for r in got if r["source"] == s)
            assert abs(taken - target) <= 21
            assert sum(len(r["text"].split()) for r in out if r["source"] == s) == taken
        assert {r["copies"] for r in out} == {"x"}
