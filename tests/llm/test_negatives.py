import random

import duckdb
import numpy as np
import pytest

from transit_prices.llm import negatives
from transit_prices.llm.queries import ORACLE_SQL, op13_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, slab int, kind string, id string, score string, v string"


def brute(rows, step, k=5):
    ok = [(i, lab, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, v, lab in rows
          if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {(i, lab, tuple(v)) for i, lab, v in ok if i % step == 0}
    out = []
    for a, lab, v in anchors:
        others = [(-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in ok if i != a]
        for p, pid, _ in sorted(o for o in others if o[2] == lab)[:k]:
            fit = sorted(o for o in others if o[2] != lab and 80 * -p <= 100 * -o[0] <= 100 * -p)[:k]
            out += [(a, pid, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(fit)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "x", "y", None, "z") for i, v, lab in rows], SCHEMA).repartition(3)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def clustered(rng, n, width=6):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    return [(i, [x + rng.gauss(0, 0.3) for x in centres[i % 5]], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("slab", [40, 32_768])
def test_equals_brute_force(spark, slab):
    """Ties, a vector that a third of the rows share, nulls, other dimensions, ids and rows twice."""
    rng = random.Random(slab)
    rows = clustered(rng, 300)
    rows += [(1000 + i, [0.5, 0.25, 0.0, 0.0, 0.5, 1.0], i % 2) for i in range(150)]
    rows += [(2000, None, 1), (2001, [0.1, None], 1), (2002, [float("nan")] * 6, 1), (2003, [float("inf")] * 6, 0), (2004, [0.1] * 6, None), (None, [0.1] * 6, 1)]
    rows += [(2010, [], 0), (2020, [1.0, 2.0], 1), (2030, [1.0] * 8, 2), (2040, [0.0] * 6, 0), rows[10], rows[10], (20, [0.3] * 6, 1), (7, [0.2] * 6, 2)]
    assert found(negatives.mine(frame(spark, rows), negatives.F.col("id") % 10 == 0, slab=slab)) == brute(rows, 10)


def test_large_components(spark):
    """Beyond the whole numbers that floating point holds."""
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) * 3e4, rng.gauss(0, 1) * 3e4, 1e-3 * i], i % 2) for i in range(60)]
    rows += [(i + 100, [2.0**22 + i, -(2.0**22), 3.0], i % 3) for i in range(40)]
    assert found(negatives.mine(frame(spark, rows), negatives.F.col("id") % 5 == 0)) == brute(rows, 5)


def test_empty(spark):
    assert negatives.mine(frame(spark, []), negatives.F.col("id") % 5 == 0).collect() == []


def test_tree_prunes_and_boxes_hold_their_rows():
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(20, 1, 8)) * 400 + rng.normal(size=(20, 500, 8)) * 20).astype(np.int64).reshape(-1, 8)
    ids = np.arange(len(vectors))
    tree = negatives.Tree(ids, np.zeros(len(ids)), vectors, True)
    assert sorted(tree.ids.tolist()) == ids.tolist()
    first, boxes = tree.levels[0]
    for i in range(boxes):
        part = tree.vectors[i * negatives.LEAF : (i + 1) * negatives.LEAF]
        assert (part >= tree.low[i]).all() and (part <= tree.high[i]).all()
    least, most = tree.bounds(vectors[:50])
    opened = []
    for i in range(50):
        goal = negatives.Goal(0, -np.inf, np.inf, np.ones(len(ids), dtype=bool), 5)
        opened.append(tree.search(tree.numbers(vectors[i]), least[i], most[i], [goal]))
        scores = vectors @ vectors[i]
        best = sorted(zip((-scores).tolist(), ids.tolist()))[:5]
        assert [(int(a), b) for a, b in goal.held] == best
    assert np.mean(opened) < boxes / 3


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert found(op13_negatives(spark, folder)) == sorted(duckdb.sql(ORACLE_SQL["op13_negatives"]).fetchall())
