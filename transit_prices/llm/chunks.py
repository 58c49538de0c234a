"""Substring deduplication by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of every whole text: each byte adds its
gear value to the hash shifted by one, so the 16-bit hash depends on the last
16 bytes only, and where its top bits are zero a chunk ends. Boundaries follow
the content: text inserted before a passage moves its chunks but does not change them. Chunks
are compared by a 128-bit digest. The first occurrence of a chunk in the corpus (smallest
document id, then position) stays; later ones are removed if the run of
neighbouring repeated chunks is ``min_run`` bytes or longer, so that short
common phrases stay.

Plan: chunks are cut where the texts are read, twice, instead of kept. The first
pass counts digests (with a map-side part) and keeps the repeated ones. The second joins
them back, an equi-join whose hot digests adaptive execution may split. Only the
documents that lose text carry a list of spans to the rewriting step.

Defined results: a null text stays null and has no chunk; an empty one stays empty;
null ids order first; rows that agree in id and text count as one document and lose the
same spans; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ..session import ship_package
from .common import packed, pick, slices, unpacked, written

WINDOW = 16
MIN_CHUNK = 24
MAX_CHUNK = 512
#: Zero bits at a boundary: 32 bytes on average between candidates.
BOUNDARY_BITS = 5
#: Bytes of neighbouring repeated chunks from which they are removed.
MIN_RUN = 64


def gear_table() -> np.ndarray:
    """One pseudo-random 16-bit value for each byte."""
    return np.array([xxhash.xxh64_intdigest(bytes([b]), 8) & 0xFFFF for b in range(256)], dtype=np.uint16)


def gear_hash(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """h[i] = sum over the last 16 bytes of gear[data[i - j]] << j, modulo 2^16,
    by doubling the window four times."""
    h = gear[data]
    for width in (1, 2, 4, 8):
        if len(h) > width:
            shifted = h[:-width] << np.uint16(width)
            h = h.copy()
            h[width:] += shifted
    return h


def cut_points(texts: list[bytes], gear: np.ndarray, min_chunk: int, max_chunk: int, bits: int) -> list[list[int]]:
    """For each text the ends of its chunks, as byte offsets; never inside a character."""
    joined = b"".join(texts)
    data = np.frombuffer(joined, dtype=np.uint8)
    zero = (gear_hash(data, gear) >> np.uint16(16 - bits)) == 0
    starts_character = np.append((data[1:] & 0xC0) != 0x80, True)
    candidates = (np.flatnonzero(zero & starts_character) + 1).tolist()
    candidates.append(len(joined) + min_chunk + 1)
    out, k, offset = [], 0, 0
    for text in texts:
        end, last, cuts = offset + len(text), offset, []
        while last < end:
            # min_chunk is at least the window, so the hash is the text's own
            low, high = last + min_chunk, min(last + max_chunk, end)
            while candidates[k] < low:
                k += 1
            cut = candidates[k]
            if cut > high:
                cut = high
                while cut < end and data[cut] & 0xC0 == 0x80:
                    cut += 1
            elif end - cut < min_chunk:
                cut = end  # a short rest joins the last chunk
            cuts.append(cut - offset)
            last = cut
        out.append(cuts)
        offset = end
    return out


def chunks(docs: DataFrame, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK, bits: int = BOUNDARY_BITS) -> DataFrame:
    """Rows (doc, twin, n, lo, hi, h1, h2) of ``docs`` (doc, twin, text): the n-th
    chunk of a document, its bytes [lo, hi) and its digest."""
    if min_chunk < WINDOW:
        raise ValueError(f"min_chunk must be {WINDOW} or more")
    ship_package(docs.sparkSession)
    kinds = [docs.schema["doc"], docs.schema["twin"]]
    schema = StructType([*kinds, *_parse_datatype_string("n int, lo int, hi int, h1 long, h2 long").fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = gear_table()
        for part, texts in slices(batches, 2):
            texts = [t or b"" for t in texts]
            cuts = cut_points(texts, gear, min_chunk, max_chunk, bits)
            digests, lo, hi = [], [], []
            for text, ends in zip(texts, cuts):
                begins = [0, *ends[:-1]] if ends else []
                lo += begins
                hi += ends
                digests += [xxhash.xxh3_128_digest(text[a:b]) for a, b in zip(begins, ends)]
            sizes = np.fromiter(map(len, cuts), dtype=np.int64, count=len(cuts))
            row = np.repeat(np.arange(len(cuts)), sizes)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(at), part.column(1).take(at), pa.array(nth.astype(np.int32)), pa.array(lo, pa.int32()),
                    pa.array(hi, pa.int32()), pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1])),
                ],
                names=names,
            )

    return docs.mapInArrow(run, schema)


def repeated_spans(rows: DataFrame, min_run: int = MIN_RUN, **cut) -> DataFrame:
    """Rows (doc, twin, spans, removed_chunks, first_doc_ids) for the documents of
    ``rows`` (doc, twin, text) that lose text: spans [lo, hi) in bytes, merged."""
    occurrences = chunks(rows, **cut)
    place = F.struct("doc", "twin", "n")
    known = written(
        occurrences.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.min(place).alias("first")).where("times > 1").drop("times")
    )
    again = occurrences.join(known.hint("merge"), ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    again = again.select("doc", "twin", F.struct("n", "lo", "hi", F.col("first.doc").alias("from")).alias("chunk"))
    # a document's own chunks only, so a list is bounded by its text; rows that repeat a document merge
    lists = again.groupBy("doc", "twin").agg(F.sort_array(F.collect_set("chunk")).alias("found"))
    kind = rows.schema["doc"].dataType
    schema = StructType(
        [rows.schema["doc"], rows.schema["twin"], *_parse_datatype_string("spans array<struct<lo:int,hi:int>>, removed_chunks long").fields]
        + [StructField("first_doc_ids", _array(kind))]
    )
    names = [f.name for f in schema.fields]
    span = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, spans, counts, firsts = [], [], [], []
            for i, found in enumerate(batch.column(2).to_pylist()):
                merged: list[list] = []  # [lo, hi, chunks, first documents, last n]
                for c in found:
                    if merged and merged[-1][4] + 1 == c["n"]:
                        merged[-1][1], merged[-1][4] = c["hi"], c["n"]
                        merged[-1][2] += 1
                        merged[-1][3].add(c["from"])
                    else:
                        merged.append([c["lo"], c["hi"], 1, {c["from"]}, c["n"]])
                merged = [m for m in merged if m[1] - m[0] >= min_run]
                if merged:
                    keep.append(i)
                    spans.append([{"lo": m[0], "hi": m[1]} for m in merged])
                    counts.append(sum(m[2] for m in merged))
                    firsts.append(sorted(set().union(*(m[3] for m in merged)) - {None}))
            at = pa.array(keep, pa.int64())
            kinds = [batch.column(0).take(at), batch.column(1).take(at), pa.array(spans, span), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*kinds, pa.array(firsts, pa.list_(batch.schema.field(0).type))], names=names)

    return lists.mapInArrow(run, schema)


def _array(kind):
    from pyspark.sql.types import ArrayType

    return ArrayType(kind)


def cut_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN, **cut) -> DataFrame:
    """Rows (row, text, cut): the caller's row, its text without the repeated chunks, and
    a struct of removed_chunks, removed spans and first_doc_ids, the documents that hold the
    first copies (null if nothing was removed)."""
    twin = F.xxhash64("doc", "text").alias("twin")
    own = packed(docs, doc=id_col, text=text_col).select("row", "doc", "text", twin)
    spans = written(repeated_spans(own.select("doc", "twin", "text"), min_run, **cut))
    spans = spans.select(F.col("doc").alias("at_doc"), F.col("twin").alias("at_twin"), F.struct("spans", "removed_chunks", "first_doc_ids").alias("cut"))
    # the text travels once, inside the row
    rows = own.drop("text")
    # the spans grow with the table: the same shuffle at every size, never a broadcast
    joined = rows.join(spans.hint("merge"), F.col("doc").eqNullSafe(F.col("at_doc")) & (F.col("twin") == F.col("at_twin")), "left")
    text = F.col("row").getField(text_col)
    raw = text.cast("binary")
    # what lies between the spans: from each span's end to the next one's start
    begins = F.concat(F.array(F.lit(0)), F.col("cut.spans.hi"))
    ends = F.concat(F.col("cut.spans.lo"), F.array(F.octet_length(raw)))
    pieces = F.zip_with(begins, ends, lambda a, b: F.substring(raw, a + 1, b - a).cast("string"))
    return joined.select("row", F.when(F.col("cut").isNull(), text).otherwise(F.array_join(pieces, "")).alias("text"), "cut")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN, **cut) -> DataFrame:
    """``docs`` with the repeated chunks cut out of the text column."""
    return unpacked(cut_rows(docs, id_col, text_col, min_run, **cut), docs.columns, **{text_col: F.col("text")})
