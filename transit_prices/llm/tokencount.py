"""Token counts per document from flat token files without an index.

A flat file holds token ids of fixed width, documents one after the other, each
closed by the end-of-document id. Counting reads it in blocks: each block is one
vectorised search for the separator; a prefix scan over the blocks (running number of
separators, last separator before the block) stitches the documents that cross
block borders. The scan moves two numbers a block, never the separators' places. So blocks are read in any order by any task, and a very long
document is no problem.

Files are reached through pyarrow's file systems, by the URI of the folder (the
shared folder of the session in the query). Writers name each file anew and report it with
the order of its documents; only reported files are read, so a task that ran twice
or was lost leaves at most an unused file.

Defined results: a null text has no tokens but a separator of its own; tokens after the last
separator of a file make a document that is not complete; an empty file or folder gives no rows.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import ship_package
from .common import pick, slices, written

#: Tokens of a block: one task holds one block at a time.
BLOCK_TOKENS = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Mergeable ranks of a ``.tiktoken`` vocabulary file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def write_flat(docs: DataFrame, folder: str, ranks: dict[bytes, int], pattern: str, separator: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and append it with the separator to its task's flat
    file of little-endian uint16 in ``folder``. Returns the files' order of documents, rows
    (file, nth, doc_id); running the result writes the files, so write it down once."""
    if max(separator, *ranks.values()) > 0xFFFF:
        raise ValueError("ids must fit 16 bits")
    rows = pick(docs, doc_id=id_col, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = StructType([*_parse_datatype_string("file string, nth long").fields, rows.schema["doc_id"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from pyarrow import fs

        encode = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={}).encode_ordinary
        system, place = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        system.create_dir(place, recursive=True)
        name, nth, out = f"{uuid.uuid4().hex}.bin", 0, None
        for part, texts in slices(batches, 1, 1 << 20):
            out = out or system.open_output_stream(f"{place}/{name}")
            for t in texts:
                ids = encode(t.decode("utf-8", "replace")) if t else []
                ids.append(separator)
                out.write(np.array(ids, dtype="<u2").tobytes())
            n = len(texts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(np.arange(nth, nth + n)), part.column(0)], names=["file", "nth", "doc_id"])
            nth += n
        if out:
            out.close()

    return rows.mapInArrow(run, schema)


def flat_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (file, bytes) of the flat files in a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))


def count_tokens(files: DataFrame, folder: str, separator: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows (file, nth, n_tokens, complete) for each document of the files (file,
    bytes), separators not counted."""
    ship_package(files.sparkSession)
    total = F.floor(F.col("bytes") / width)
    blocks = files.where(total > 0).select(
        "file", total.alias("total"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((total - 1) / block_tokens))).alias("block")
    )
    # every block is a row of its own that any task may read
    blocks = blocks.repartition("file", "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        for batch in batches:
            for row in batch.to_pylist():
                first = row["block"] * block_tokens
                n = min(block_tokens, row["total"] - first)
                with system.open_input_file(f"{place}/{row['file']}") as f:
                    f.seek(first * width)
                    ids = np.frombuffer(f.read(n * width), dtype=f"<u{width}")
                at = first + np.flatnonzero(ids == separator)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]]), pa.array([row["total"]]), pa.array([row["block"]]), pa.array([at], pa.list_(pa.int64()))],
                    names=["file", "total", "block", "at"],
                )

    # written down once: the scan reads two numbers of each block, the rest comes by a join
    found = written(blocks.mapInArrow(search, "file string, total long, block long, at array<long>"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("at") > 0, F.element_at("at", -1))
    scan = found.select("file", "block", F.size("at").alias("n"), last.alias("last")).select(
        "file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("carry")
    )
    stitched = found.join(scan.hint("merge"), ["file", "block"])
    final = (F.col("block") + 1) * block_tokens >= F.col("total")
    # the file's end closes the last document, if its separator is missing
    end = F.coalesce(last, F.col("carry")) + 1
    open_end = final & (end < F.col("total"))
    marks = F.when(open_end, F.concat("at", F.array("total"))).otherwise(F.col("at"))
    each = stitched.select("file", "total", "before", "carry", marks.alias("at"), F.posexplode(marks).alias("pos", "mark"))
    previous = F.when(F.col("pos") == 0, F.col("carry")).otherwise(F.element_at("at", F.greatest("pos", F.lit(1))))
    return each.select(
        "file", (F.col("before") + F.col("pos")).cast("long").alias("nth"), (F.col("mark") - previous - 1).alias("n_tokens"), (F.col("mark") < F.col("total")).alias("complete")
    )
