"""Language identification by compression.

For each language a dictionary of raw text is built from a bounded sample of the
labelled documents. A text is cut into blocks; each block is compressed with each
dictionary, and the language whose dictionary gives the fewest bytes in total is
the best guess. The guess is rejected if the runner-up comes too close.

The sample: at most ``samples`` texts a language (smallest hashes of the
text, so copies count once), one slice of ``slice_chars`` characters of each, taken
at a place its hash names. Texts are hashed where they are read; only
candidates below a cutoff, set from the number of distinct texts, travel. Everything else covers all rows.

Defined results: a text that is null or has no letter is ``und`` with score 0; a
table without labelled text makes every text ``und``; repeated rows get equal results;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .common import pick, slices

SAMPLES = 512
SLICE_CHARS = 200
#: From this level on the compressor looks for matches at every place, short ones too.
LEVEL = 7
BLOCK = 8192
#: Texts under so many bytes are compressed in word windows, too: whole bytes are
#: too coarse a measure for them.
SHORT = 300
#: Share of the best size by which the second best must be larger.
MIN_MARGIN = 0.01
UNKNOWN = "und"


def sample_texts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", samples: int = SAMPLES, slice_chars: int = SLICE_CHARS) -> dict[str, bytes]:
    """Raw dictionary text of each language, at most samples * slice_chars
    characters each. Languages come from the column; their number bounds the result."""
    rows = pick(docs, text=text_col, lang=lang_col).where("lang is not null and length(text) > 0")
    rows = rows.withColumn("h", F.xxhash64("text"))
    # hashes are even over [-2^63, 2^63): this cutoff lets about 2 * samples pass
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()
    if not counts:
        return {}
    cutoff = F.lit(None).cast("double")
    for r in counts:
        cutoff = F.when(F.col("lang") == r["lang"], F.lit(-(2.0**63) + 2.0**64 * min(1.0, 2.0 * samples / max(r["n"], 1)))).otherwise(cutoff)
    start = F.pmod(F.col("h"), F.greatest(F.length("text") - slice_chars, F.lit(0)) + 1) + 1
    chosen = (
        rows.where(F.col("h").cast("double") <= cutoff)
        .select("lang", "h", F.substring(F.col("text"), start, F.lit(slice_chars)).alias("piece"))
        .groupBy("lang", "h").agg(F.min("piece").alias("piece"))
    )
    found: dict[str, list] = {}
    for r in chosen.toLocalIterator():
        found.setdefault(r["lang"], []).append((r["h"], r["piece"]))
    # the last bytes of a raw dictionary are the nearest: order does not matter here, but is fixed
    return {k: "\n".join(p for _, p in sorted(v)[:samples]).lower().encode() for k, v in sorted(found.items())}


def classify(texts: list[str], compressors: list[tuple[str, object]]) -> list[tuple[str | None, float, float]]:
    """(best language, score, margin) of each text with a letter; None otherwise."""
    import regex

    letter = regex.compile(r"\p{L}").search
    out = []
    for text in texts:
        if not text or not compressors or not letter(text):
            out.append((None, 0.0, 0.0))
            continue
        data = text.lower().encode()
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        if len(data) < SHORT:
            words = data.split()
            blocks += [b" ".join(words[i : i + n]) for n in (1, 2, 3, 4) for i in range(len(words) - n + 1)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in compressors)
        best, lang = sizes[0]
        second = sizes[1][0] if len(sizes) > 1 else best + 2 * len(data)
        margin = (second - best) / best
        # sizes n bytes apart: odds of 2 to the power of n / 2
        out.append((lang, 1.0 / (1.0 + 2.0 ** -min(60.0, (second - best) / 2.0)), margin))
    return out


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", min_margin: float = MIN_MARGIN, level: int = LEVEL
) -> DataFrame:
    """Rows (doc_id, best, score, margin, lang), one per row of ``docs``: ``best``
    is the smallest size's language (und without a letter), ``lang`` the same
    unless the margin is under ``min_margin`` (then und). The dictionaries are broadcast: at
    most samples * slice_chars characters a language."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    schema = StructType([rows.schema["doc_id"], *_parse_datatype_string("best string, score double, margin double, lang string").fields])
    schema = StructType([StructField(f.name, f.dataType) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressors = []
        for lang, raw in shared.value.items():
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            compressors.append((lang, zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)))
        for part, texts in slices(batches, 1):
            found = classify([(t or b"").decode("utf-8", "replace") for t in texts], compressors)
            best = [x[0] or UNKNOWN for x in found]
            lang = [b if x[2] >= min_margin else UNKNOWN for b, x in zip(best, found)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(best), pa.array([x[1] for x in found]), pa.array([x[2] for x in found]), pa.array(lang)],
                names=["doc_id", "best", "score", "margin", "lang"],
            )

    return rows.mapInArrow(run, schema)
