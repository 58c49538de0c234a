"""Hard-negative mining with an STR-packed R-tree.

Vectors are dealt into slabs of their first coordinate (range partitions, the id keeps equal
vectors apart); each slab is packed by sort-tile-recursive slicing along its widest
coordinates into leaves of neighbouring rows, with a minimum bounding box for each leaf and for
each ``FAN`` boxes above. With an anchor, a box gives an interval for each coordinate's part
of the inner product, and their sums bound the scores of all its rows. A best-first queue
opens boxes by upper bound, prunes those outside all score windows and those strictly
below the k-th score found (an equal one may hold a smaller id), and adds up scores in
leaves. The search is exact, so its recall is 1.

The same search runs twice: for the positives (same label, no window), then for the
negatives of each positive (other labels, its window). All anchors meet all slabs: a slab
lies in one task, and the anchors stream past it in Arrow batches, so a task holds one
slab and one batch. Only k rows per anchor, goal and slab are shuffled.

Defined results: rows with a null id, label or vector, or with a null or non-finite
component, take no part; a missing dimension counts as zero; rows that share the anchor's id are
its own and left out; an anchor row that is repeated exactly counts once; repeated candidates
count each; ties go to the smaller id; products are exact, and scores beyond 64 bits are cut
to 64 bits in the result; a negative positive score leaves an empty window; an empty
table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

#: Rows of a leaf, boxes of an inner box, coordinates that are sliced.
LEAF, FAN, SLICED = 128, 16, 3
#: Rows of a slab, about.
SLAB = 32_768
#: Anchors whose bounds are worked out at once.
ANCHORS = 256
BIG = 1 << 63


class Tree:
    """The R-tree of one slab. ``exact``: float64 holds every product; else Python integers."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, exact: bool):
        self.exact = exact
        spread = vectors.astype(np.float64).var(axis=0) if len(vectors) else np.zeros(0)
        order = self._packed(vectors, np.arange(len(ids)), np.argsort(-spread, kind="stable")[:SLICED])
        self.ids, self.labels = ids[order], labels[order]
        self.vectors = self.numbers(vectors[order])
        # boxes level by level, leaves first; children of box i of a level: FAN * i up to FAN * (i + 1)
        low, high = self.vectors, self.vectors
        self.levels: list[tuple[int, int]] = []  # (first box, boxes)
        lows, highs, step, first = [], [], LEAF, 0
        while True:
            cuts = np.arange(0, len(low), step)
            low, high = np.minimum.reduceat(low, cuts, axis=0), np.maximum.reduceat(high, cuts, axis=0)
            lows.append(low)
            highs.append(high)
            self.levels.append((first, len(low)))
            first, step = first + len(low), FAN
            if len(low) == 1:
                break
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)

    def numbers(self, x: np.ndarray) -> np.ndarray:
        return x.astype(np.float64) if self.exact else x.astype(object)

    def _packed(self, vectors: np.ndarray, rows: np.ndarray, by: np.ndarray) -> np.ndarray:
        """Sort-tile-recursive: sorted by one coordinate and cut into slices, each slice
        packed by the next; the last one's order is cut into leaves."""
        if len(rows) <= LEAF or not len(by):
            return rows
        rows = rows[np.argsort(vectors[rows, by[0]], kind="stable")]
        if len(by) == 1:
            return rows
        leaves = -(-len(rows) // LEAF)
        slices = math.ceil(leaves ** (1 / len(by)))
        size = -(-leaves // slices) * LEAF
        return np.concatenate([self._packed(vectors, rows[i : i + size], by[1:]) for i in range(0, len(rows), size)])

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each box allows, per anchor: each coordinate's
        interval is between its products with the box's ends."""
        anchors = self.numbers(anchors)
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def search(self, anchor: np.ndarray, least: np.ndarray, most: np.ndarray, goals: list[Goal]) -> int:
        """Fill the goals; returns the number of boxes opened."""
        top = len(self.levels) - 1
        queue = [(-most[self.levels[top][0]], top, 0)]
        opened = 0
        while queue:
            bound, level, box = heapq.heappop(queue)
            at = self.levels[level][0] + box
            wanted = [g for g in goals if -bound >= g.floor and least[at] <= g.high]
            if not wanted:
                if all(-bound < g.floor for g in goals):
                    break  # no box left reaches any goal
                continue
            opened += 1
            if level == 0:
                a = box * LEAF
                scores = self.vectors[a : a + LEAF] @ anchor
                for g in wanted:
                    g.offer(scores, self.ids, a)
                continue
            first, boxes = self.levels[level - 1]
            for child in range(box * FAN, min((box + 1) * FAN, boxes)):
                bound, low = most[first + child], least[first + child]
                if any(bound >= g.floor and low <= g.high for g in wanted):
                    heapq.heappush(queue, (-bound, level - 1, child))
        return opened


class Goal:
    """The k best rows (greatest score, then smallest id) of a mask with a score from
    ``floor`` to ``high``; the floor rises to the k-th score found."""

    def __init__(self, nth: int, floor: float, high: float, rows: np.ndarray, k: int):
        self.nth, self.floor, self.high, self.rows, self.k = nth, floor, high, rows, k
        self.held: list[tuple] = []

    def offer(self, scores: np.ndarray, ids: np.ndarray, at: int) -> None:
        hits = np.flatnonzero((scores >= self.floor) & (scores <= self.high) & self.rows[at : at + len(scores)])
        if len(hits):
            self.held += zip((-scores[hits]).tolist(), ids[at + hits].tolist())
            self.held.sort()
            del self.held[self.k :]
            if len(self.held) == self.k:
                self.floor = max(self.floor, -self.held[-1][0])


# ------------------------------------------------------------------ on Spark


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: float = 256.0, slab: int = SLAB,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for each anchor (a condition on ``id``) and each of its best ``positives`` rows of the same
    label the best ``negatives`` rows of other labels whose score is ``low`` to ``high`` per
    cent of the positive's."""
    rows = pick(vectors, id=id_col, label=label_col, x=vector_col)
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(~bad)
    rows = rows.select("id", "label", F.transform("x", lambda c: F.floor(c.cast("double") * F.lit(scale)).cast("long")).alias("v"))
    facts = rows.agg(F.count("*"), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    n, width = facts[0], facts[1] or 0
    largest = max(abs(facts[2] or 0), abs(facts[3] or 0))
    exact = largest * largest * max(width, 1) < 1 << 52
    count = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // slab))
    # slabs of the first coordinate
    dealt = rows.repartitionByRange(count, F.try_element_at("v", F.lit(1)), "id")
    placed = written(dealt.withColumn("slab", F.spark_partition_id()))
    slabs = placed.agg(F.max("slab")).first()[0] or 0
    twin = F.xxhash64("label", "v").alias("twin")
    asked = placed.where(is_anchor).select("id", twin, "label", "v").distinct()
    kind = rows.schema["id"].dataType.simpleString()

    def found(goals: DataFrame, k: int, same: bool) -> DataFrame:
        """Rows (anchor, twin, nth, id, score, rank) over all slabs."""
        every = goals.withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs))))
        both = placed.select("slab", F.lit(0).alias("kind"), "id", F.lit(0).cast("long").alias("twin"), "label", "v", F.lit(None).cast("array<long>").alias("scores")).unionByName(
            every.select("slab", F.lit(1).alias("kind"), "id", "twin", "label", "v", "scores"))
        streams = both.repartitionByRange(slabs + 1, "slab").sortWithinPartitions("slab", "kind")
        hits = streams.mapInArrow(_search(width, exact, k, same, low, high), f"anchor {kind}, twin long, nth int, id {kind}, score long")
        order = Window.partitionBy("anchor", "twin", "nth").orderBy(F.desc("score"), "id")
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = written(found(asked.withColumn("scores", F.lit(None).cast("array<long>")), positives, True))
    by_rank = F.array_sort(F.collect_list(F.struct("rank", "score")))  # at most ``positives`` of them
    windows = near.groupBy("anchor", "twin").agg(by_rank["score"].alias("scores")).withColumnRenamed("anchor", "id")
    far = written(found(asked.join(windows, ["id", "twin"]), negatives, False))
    pairs = near.select("anchor", "twin", F.col("rank").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(pairs, ["anchor", "twin", "nth"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _search(width: int, exact: bool, k: int, same: bool, low: int, high: int):
    """For sorted partitions: each slab's rows, then its anchors."""

    def goals(tree: Tree, own, label, scores: list[int] | None) -> list[Goal]:
        rows = ((tree.labels == label) if same else (tree.labels != label)) & (tree.ids != own)
        if scores is None:
            return [Goal(0, -math.inf, math.inf, rows, k)]
        # whole numbers s with low * p <= 100 * s <= high * p
        windows = [(i + 1, -(-low * p // 100), high * p // 100) for i, p in enumerate(scores)]
        return [Goal(i, a, b, rows, k) for i, a, b in windows if a <= b]

    def answers(tree: Tree, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        ids, twins, labels = (part.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
        anchors = _matrix(part.column(5), width)
        least, most = tree.bounds(anchors)
        anchors = tree.numbers(anchors)
        for i, scores in enumerate(part.column(6).to_pylist()):
            wanted = goals(tree, ids[i], labels[i], scores)
            if wanted:
                tree.search(anchors[i], least[i], most[i], wanted)
            out += [(ids[i], twins[i], g.nth, row, min(max(int(-score), -BIG), BIG - 1)) for g in wanted for score, row in g.held]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (part.schema.field(2).type, pa.int64(), pa.int32(), part.schema.field(2).type, pa.int64()))],
                names=["anchor", "twin", "nth", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, held, tree = None, [], None
        for batch in batches:
            slabs, kinds = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cuts = [0, *(np.flatnonzero((slabs[1:] != slabs[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if slabs[a] != slab:
                    slab, held, tree = slabs[a], [], None
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    held.append(tuple(part.column(i).to_numpy(zero_copy_only=False) for i in (2, 4)) + (_matrix(part.column(5), width),))
                    continue
                if tree is None and held:
                    tree = Tree(*(np.concatenate(x) for x in zip(*held)), exact)
                    held = []
                for i in range(0, part.num_rows if tree else 0, ANCHORS):
                    yield from answers(tree, part.slice(i, ANCHORS))

    return run
