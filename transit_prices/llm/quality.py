"""Quality rules on repetition inside a text, from a suffix array of its words.

A slice of documents gets one suffix array: words become ranks of (document,
word), every document ends in its own sentinel, and prefix doubling sorts the
suffixes that are not yet told apart. Equal classes of each doubling step give
the longest common prefix of neighbours in the array. The deepest LCP interval
around a suffix has the larger of its two neighbouring LCPs as its length; where it
cannot be extended to the left it is an occurrence of a maximal repeated
substring. Occurrences of ``min_repeat`` words or more form spans; a text fails if
the union of its spans covers too large a share of its words, or if its longest
repeat is too long.

The base rules (word count, share of words in repeated 3-word windows, counts of
symbols and repeated lines) come from the same arrays.

Defined results: a null or wordless text has zero counts and fails the base rule;
repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ..session import ship_package
from .common import named, pick, slices

#: A repeat counts from so many words on.
MIN_REPEAT = 10
#: Most of a text's words that repeats may cover, and most words of one repeat.
MAX_COVERED = 0.45
MAX_LONGEST = 200

BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"


def longest_repeats(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word position, the length of the longest substring that starts
    there and occurs again in the same document.

    ``codes`` holds the words' numbers; ``first`` the positions where documents
    start (ascending, 0 first; documents may be empty)."""
    n_docs, n_words = len(first), len(codes)
    if not n_words:
        return np.zeros(0, dtype=np.int64)
    doc = np.repeat(np.arange(n_docs), np.diff(np.append(first, n_words)))
    place = np.arange(n_words) + doc  # a sentinel follows each document
    n = n_words + n_docs
    key = np.full(n, -1, dtype=np.int64)
    key[place] = doc * (int(codes.max()) + 1) + codes
    ends = np.append(first[1:], n_words) + np.arange(n_docs)
    key[ends] = int(key.max()) + 1 + np.arange(len(ends))

    order = np.argsort(key)
    rank = _ranks(key[order], order, np.zeros(n, dtype=np.int64), 0)
    # levels[k]: the class of each suffix by its first 2^k symbols
    levels, step = [], 1
    while True:
        size = np.bincount(rank, minlength=n)
        levels.append(rank)
        active = np.flatnonzero(size[rank] > 1)
        if not len(active):
            break
        nxt = rank.copy()
        key = rank[active] * n + rank[active + step]
        by = np.argsort(key)
        where, sorted_key = active[by], key[by]
        # new rank: the group's old rank plus the place within the group
        group = sorted_key // n
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        base = np.repeat(start, np.diff(np.append(start, len(group))))
        fresh = np.append(True, sorted_key[1:] != sorted_key[:-1])
        leader = np.maximum.accumulate(np.where(fresh, np.arange(len(group)), 0))
        nxt[where] = group + leader - base
        rank, step = nxt, step * 2

    array = np.empty(n, dtype=np.int64)
    array[rank] = np.arange(n)
    # LCP of neighbours, from the longest known classes down
    lcp = np.zeros(n + 1, dtype=np.int64)  # lcp[j]: of array[j - 1] and array[j]
    at = np.flatnonzero(levels[0][array[:-1]] == levels[0][array[1:]])
    x, y, common = array[at].copy(), array[at + 1].copy(), np.zeros(len(at), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][x] == levels[k][y]
        common += same * (1 << k)
        x += same * (1 << k)
        y += same * (1 << k)
    lcp[at + 1] = common
    deepest = np.maximum(lcp[:-1], lcp[1:])
    out = np.empty(n, dtype=np.int64)
    out[array] = deepest
    return out[place]


def _ranks(sorted_key: np.ndarray, order: np.ndarray, rank: np.ndarray, base: int) -> np.ndarray:
    fresh = np.append(True, sorted_key[1:] != sorted_key[:-1])
    rank[order] = base + np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    return rank


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """True at each position that some span [start, start + length) holds."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0


def _line_repeats(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long, spans array<struct<start:int,end:int>>"
)


def measure(texts: list[bytes | None], min_repeat: int = MIN_REPEAT) -> list[list]:
    """The columns of SCHEMA for a list of whole texts."""
    numbers: dict = defaultdict(count().__next__)
    words = [(t or b"").split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    codes = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=n)
    longest = longest_repeats(codes, first)
    three = np.flatnonzero(longest >= 3)
    in_three = covered(three, np.full(len(three), 3), n)
    # maximal: the occurrence one to the left is not the same repeat, longer by one
    long_ones = longest >= min_repeat
    extends = np.zeros(n, dtype=bool)
    extends[1:] = longest[:-1] == longest[1:] + 1
    extends[first[(sizes > 0)]] = False
    spans_at = np.flatnonzero(long_ones & ~extends)
    in_long = covered(spans_at, longest[spans_at], n)
    total = lambda x: np.add.reduceat(np.append(x, 0), first) * (sizes > 0) if n else np.zeros(len(sizes), dtype=np.int64)
    n_three, n_long = total(in_three.astype(np.int64)), total(in_long.astype(np.int64))
    most = np.zeros(len(sizes), dtype=np.int64)
    some = np.flatnonzero(sizes > 0)
    if len(some):
        most[some] = np.maximum.reduceat(longest, first[some])
    columns: list[list] = [[] for _ in range(8)]
    edges = np.diff(np.concatenate([[0], in_long.astype(np.int8), [0]]))
    # a span ends with its document: cut runs at document starts
    begins, finishes = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    for i, t in enumerate(texts):
        s = (t or b"").decode("utf-8", "replace")
        lo, hi = int(first[i]), int(first[i] + sizes[i])
        spans = []
        if n_long[i]:
            for k in range(np.searchsorted(finishes, lo, "right"), np.searchsorted(begins, hi, "left")):
                spans.append({"start": max(int(begins[k]), lo) - lo, "end": min(int(finishes[k]), hi) - lo})
        row = (
            int(sizes[i]), len(s) - sum(map(s.count, BLANKS)), sum(map(s.count, SYMBOLS)), _line_repeats(s),
            int(n_three[i]), int(n_long[i]), int(most[i]), spans,
        )
        for c, v in zip(columns, row):
            c.append(v)
    return columns


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT) -> DataFrame:
    """Rows (doc_id, columns of SCHEMA): one per row of ``docs``. Spans are in
    words, merged, and only of repeats of ``min_repeat`` words or more."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    return rows.mapInArrow(*_mapper(rows, 1, min_repeat, drop_text=True))


def _mapper(rows: DataFrame, text: int, min_repeat: int, drop_text: bool):
    ship_package(rows.sparkSession)
    kept = [f for i, f in enumerate(rows.schema.fields) if not (drop_text and i == text)]
    at = [i for i in range(len(rows.schema.fields)) if not (drop_text and i == text)]
    schema = StructType([*kept, *_parse_datatype_string(SCHEMA).fields])
    names = [f.name for f in schema.fields]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text):
            new = measure(texts, min_repeat)
            arrays = [part.column(i) for i in at] + [pa.array(c, pa.int64()) for c in new[:7]] + [pa.array(new[7], span)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run, schema


def verdict(measured: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Adds base_failed and kept to the columns of ``repetition``."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    good = (F.col("covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & good)


def keep_good(
    docs: DataFrame, text_col: str = "text", min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns unchanged; the
    texts pass through the measuring task, so nothing is joined or shuffled."""
    rows = docs.select(*(named(c).alias(f"c{i}") for i, c in enumerate(docs.columns)))
    run, schema = _mapper(rows, docs.columns.index(text_col), min_repeat, drop_text=False)
    judged = verdict(rows.mapInArrow(run, schema), max_covered, max_longest)
    return judged.where("kept").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
