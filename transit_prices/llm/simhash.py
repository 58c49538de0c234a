"""SimHash near-duplicates, found with anchor points of a covering code.

Fingerprint: lower-case A-Z, words, shingles of ``shingle`` words (repeats count,
fewer words: the whole sequence, no word: fingerprint zero); each shingle's
XXH64 (seed 42) votes per bit, and a bit is set if over half the votes set it.

Search: the 64 bits are cut into ``pieces`` halves. Two fingerprints within
``max_bits`` differ in at most t = max_bits // pieces bits on one of them. Each
piece is covered by a Hamming code (radius 1; bits beyond 2^r - 1 are kept as they
are): every value has a code word, its home anchor, within one bit. A fingerprint
is sent to every anchor within 1 + t bits of its piece, so it meets every partner
at the partner's home. At an anchor, fingerprints at home are compared with all
(XOR and bit count). Equal fingerprints are merged before, and an anchor with more
than ``split_rows`` rows is cut into blocks, one group per pair of blocks, so no
task holds a hot anchor whole. A group returns a spanning forest of its links, not all of
its pairs; linked fingerprints then become components.

Defined results: null text counts as empty; a null id keeps its row and is
never a component's name unless all ids are null; repeated rows stay; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import ship_package
from .common import components, packed, pick, slices, unpacked, written

SEED = 42
#: Rows at one anchor from which it is cut into blocks.
SPLIT_ROWS = 8192
#: Groups up to this size are compared pair by pair in one vector step.
SMALL = 48


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of one whole text."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    count = n - shingle + 1
    votes = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), dtype=np.uint64, count=count)
    for i in range(0, count, 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, ``extra`` columns, fp): fp is the fingerprint's bits as a signed long."""
    rows = pick(docs, doc_id=id_col, **{c: c for c in extra}, text=text_col)
    kept = ["doc_id", *extra]
    schema = StructType([*(StructField(c, rows.schema[c].dataType) for c in kept), StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, len(kept)):
            fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], pa.array(fps)], names=[*kept, "fp"])

    return rows.mapInArrow(run, schema)


class Covering:
    """Anchors of one piece of ``width`` bits: a Hamming code on its low
    2^r - 1 bits, the other bits free; ``reach`` = threshold of the piece."""

    def __init__(self, width: int, reach: int):
        r = (width + 1).bit_length() - 1
        coded = (1 << r) - 1
        place = np.array([*range(1, coded + 1), *[0] * (width - coded)], dtype=np.int64)
        by_syndrome: list[list[tuple[int, int]]] = [[] for _ in range(coded + 1)]
        for weight in range(1 + reach + 1):
            for bits in combinations(range(width), weight):
                s = 0
                for b in bits:
                    s ^= int(place[b])
                by_syndrome[s].append((weight, sum(1 << b for b in bits)))
        most = max(map(len, by_syndrome))
        # the first mask of each syndrome is the nearest code word: the home
        self.masks = np.zeros((coded + 1, most), dtype=np.uint64)
        self.counts = np.array([len(x) for x in by_syndrome])
        for s, found in enumerate(by_syndrome):
            self.masks[s, : len(found)] = [m for _, m in sorted(found)]
        self.width = width
        self.tables = np.zeros(((width + 7) // 8, 256), dtype=np.int64)
        for b in range(width):
            on = (np.arange(256) >> (b % 8)) & 1
            self.tables[b // 8] ^= on * place[b]

    def anchors(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, home) for each anchor in reach of each value."""
        syndrome = np.zeros(len(values), dtype=np.int64)
        for i, table in enumerate(self.tables):
            syndrome ^= table[((values >> np.uint64(8 * i)) & np.uint64(255)).astype(np.int64)]
        n = self.counts[syndrome]
        row = np.repeat(np.arange(len(values)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return row, values[row] ^ self.masks[syndrome[row], nth], nth == 0


def _piece_widths(pieces: int) -> list[int]:
    return [64 // pieces + (i < 64 % pieces) for i in range(pieces)]


def _links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among the fingerprints of one group, by
    breadth-first search over the not yet reached ones (n - 1 links at most)."""
    near = np.uint8(max_bits)
    left = np.arange(len(fps))
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    while len(left) > 1:
        queue, left = [left[:1]], left[1:]
        while queue and len(left):
            block = queue.pop()
            for x in block:
                ok = np.bitwise_count(fps[left] ^ fps[x]) <= near
                if ok.any():
                    found, left = left[ok], left[~ok]
                    ends.append((np.full(len(found), x), found))
                    queue.append(found)
                    if not len(left):
                        break
    if not ends:
        none = np.array([], dtype=np.int64)
        return none, none
    return np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends])


def _compare_sorted(fps: np.ndarray, home: np.ndarray, starts: np.ndarray, ends: np.ndarray, max_bits: int):
    """Links of the groups [starts, ends) of a sorted block of rows."""
    sizes = ends - starts
    out_a, out_b = [], []
    # small groups: home x member pairs of many groups in one vector step
    small = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
    for size in np.unique(sizes[small]):
        these = starts[small[sizes[small] == size]]
        for i in range(0, len(these), max(1, 400_000 // int(size * size))):
            at = these[i : i + max(1, 400_000 // int(size * size)), None] + np.arange(size)
            f, h = fps[at], home[at]
            d = np.bitwise_count(f[:, :, None] ^ f[:, None, :]) <= max_bits
            d &= h[:, :, None] & (f[:, :, None] != f[:, None, :])
            g, x, y = np.nonzero(d)
            out_a.append(f[g, x])
            out_b.append(f[g, y])
    for k in np.flatnonzero(sizes > SMALL):
        f = np.unique(fps[starts[k] : ends[k]])
        a, b = _links(f, max_bits)
        out_a.append(f[a])
        out_b.append(f[b])
    if not out_a:
        none = np.array([], dtype=np.uint64)
        return none, none
    return np.concatenate(out_a), np.concatenate(out_b)


def links(distinct: DataFrame, max_bits: int = 3, pieces: int = 2, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) of at most
    ``max_bits`` differing bits: not every pair, but enough to join every
    linked pair by a path of true links."""
    ship_package(distinct.sparkSession)
    widths = _piece_widths(pieces)
    reach = max_bits // pieces

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = [Covering(w, reach) for w in widths]
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(every), 20_000):
                fps, shift = every[i : i + 20_000], 0
                for piece, (code, width) in enumerate(zip(codes, widths)):
                    values = (fps >> np.uint64(shift)) & np.uint64((1 << width) - 1 if width < 64 else 2**64 - 1)
                    shift += width
                    row, anchor, home = code.anchors(values)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), piece, dtype=np.int32)), pa.array(anchor.view(np.int64)), pa.array(fps[row].view(np.int64)), pa.array(home)],
                        names=["piece", "anchor", "fp", "home"],
                    )

    met = distinct.select("fp").mapInArrow(anchors, "piece int, anchor long, fp long, home boolean")
    # anchors with many rows are cut into blocks; a group per pair of blocks
    hot = (
        met.groupBy("piece", "anchor").agg(F.count("*").alias("n")).where(F.col("n") > split_rows)
        .select("piece", "anchor", F.ceil(F.col("n") / (split_rows // 2)).cast("int").alias("blocks"))
    )
    marked = met.join(written(hot), ["piece", "anchor"], "left")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.least(j, block) * F.col("blocks") + F.greatest(j, block),
    )
    dealt = marked.withColumn("cell", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(pairs)))
    dealt = dealt.select(F.xxhash64("piece", "anchor", "cell").alias("k"), "piece", "anchor", "cell", "fp", "home")
    sort = ["k", "piece", "anchor", "cell"]
    # as many partitions as the session shuffles with, each sorted by its keys
    dealt = dealt.repartition(*sort).sortWithinPartitions(*sort)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in _with_end(batches):
            if batch is not None:
                new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
                cols = new if kept is None else [np.concatenate(p) for p in zip(kept, new)]
            elif kept is None:
                return
            else:
                cols = kept
            n = len(cols[0])
            if not n:
                continue
            change = np.zeros(n, dtype=bool)
            change[0] = True
            for c in cols[:4]:
                change[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(change)
            ends = np.append(starts[1:], n)
            if batch is not None:  # the last group may go on in the next batch
                kept = [c[starts[-1] :] for c in cols]
                starts, ends = starts[:-1], ends[:-1]
            a, b = _compare_sorted(cols[4].view(np.uint64), cols[5].astype(bool), starts, ends, max_bits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    found = dealt.mapInArrow(compare, "a long, b long")
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, pieces: int = 2
) -> DataFrame:
    """Rows (doc_id, fp, fingerprint as 16 hex digits, component_id): one per row
    of ``docs``; component_id is the smallest id reachable over links."""
    # the fingerprints are read several times: computed once, kept as a small table
    fps = written(fingerprints(docs, id_col, text_col, shingle))
    named_fp = _rooted(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), max_bits, pieces)
    smallest = named_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named_fp.join(smallest, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _rooted(distinct: DataFrame, max_bits: int, pieces: int) -> DataFrame:
    """Rows (fp, least, root): the component of each distinct fingerprint."""
    roots = components(links(distinct, max_bits, pieces)).select(F.col("node").alias("fp"), "root")
    return written(distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))


def keep_representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, pieces: int = 2
) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the smallest id (null
    ids last), then the smallest digest of the text. Which row stays depends on its component
    alone, so rows of other components may share its id or have none as well. Of rows
    that repeat both id and text one stays."""
    digest = ["digest", "check"]
    marked = packed(docs, doc_id=id_col, text=text_col).withColumn("digest", F.xxhash64("text")).withColumn("check", F.hash("text"))
    fps = written(fingerprints(marked, "doc_id", "text", shingle, tuple(digest)))
    rows = fps.groupBy("fp", "doc_id", *digest).agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", *digest, "rows"))
    named_fp = _rooted(rows.groupBy("fp").agg(first.alias("least")), max_bits, pieces)
    chosen = named_fp.groupBy("root").agg(F.min("least").alias("k"))
    keep = written(chosen.select(F.col("k.doc_id").alias("keep_id"), *(F.col(f"k.{c}").alias(f"keep_{c}") for c in digest), F.col("k.rows").alias("rows")))
    match = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    for c in digest:
        match = match & (F.col(c) == F.col(f"keep_{c}"))
    marked = marked.drop("text")
    repeated = keep.where("rows > 1")
    # the ids grow with the table: the same shuffle at every size, never a broadcast
    once = marked.join(keep.where("rows = 1").hint("merge"), match, "left_semi")
    if not repeated.isEmpty():  # the usual case needs no second pass over the texts
        once = once.unionByName(marked.join(repeated.hint("merge"), match, "left_semi").dropDuplicates(["doc_id", *digest]))
    return unpacked(once, docs.columns)
