"""Helpers shared by the corpus operators.

* ``pick`` projects the operator's own columns under internal names, so extra
  or clashing columns of the caller's table never matter.
* ``written`` cuts lineage with a Parquet table in the shared folder that the
  session names in ``spark.checkpoint.dir``; it survives lost executors and,
  unlike a cached frame, costs no executor memory.
* ``components`` finds connected components with joins and aggregates only.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ensure_checkpoint_dir, ship_package

# Words of the contracts: runs of anything but space and \t \n \v \f \r. This is
# exactly what bytes.split() splits on, and bytes.lower() lowers A-Z only.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of text handled at once inside a task, in bytes of text.
SLICE_BYTES = 4 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def named(name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names; the Python workers get the
    package that the operator's functions come from."""
    ship_package(df.sparkSession)
    return df.select(*(named(src).alias(dst) for dst, src in columns.items()))


def packed(docs: DataFrame, **columns: str) -> DataFrame:
    """The caller's rows as one struct column ``row``, beside the named columns: whatever
    the caller's columns are called, the operator's own names are free."""
    ship_package(docs.sparkSession)
    row = F.struct(*(named(c).alias(c) for c in docs.columns)).alias("row")
    return docs.select(row, *(named(src).alias(dst) for dst, src in columns.items()))


def unpacked(rows: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The caller's columns again, some of them replaced (by the caller's name)."""
    return rows.select(*(replaced.get(c, F.col("row").getField(c)).alias(c) for c in columns))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null ids count as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a session on this very
    machine gets one of its own when none is configured."""
    folder = checkpoint_dir(spark)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="llm-shared-"))
    return f"{folder.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, schema: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (lineage ends here)."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(schema or df.schema).parquet(folder)


def most_frequent(counts: DataFrame, word: str, n: str, limit: int) -> DataFrame:
    """The ``limit`` rows of a written table with the largest ``n`` (ties by ``word``).

    Rows are counted by eighths of an octave of ``n`` first (a few hundred numbers), so
    tasks pass on only what lies in the limit's own bin or above, not ``limit`` rows each."""
    octave = F.floor(F.log2(n) * 8)
    total = 0
    for r in sorted(counts.groupBy(octave.alias("bin")).agg(F.count("*").alias("rows")).collect(), reverse=True):
        total += r["rows"]
        if total >= limit:
            counts = counts.where(octave >= r["bin"])
            break
    return counts.orderBy(F.desc(n), word).limit(limit)


def slices(batches: Iterator[pa.RecordBatch], text: int, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut Arrow batches into pieces of about ``limit`` bytes of text (one row at
    least) and give each with its texts as UTF-8 bytes (None for null)."""
    for batch in batches:
        n, start = batch.num_rows, 0
        if not n:
            continue
        column = batch.column(text)
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
        total = 0
        for i in range(n):
            total += int(sizes[i])
            if total >= limit or i == n - 1:
                yield batch.slice(start, i + 1 - start), column.slice(start, i + 1 - start).to_pylist()
                start, total = i + 1, 0


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: rows (node, root), root the smallest
    node reachable. Nodes without an edge do not appear; an empty list gives none.

    Large-star and small-star rounds: each node's smallest neighbour is an
    aggregate with a map-side part, and joining it back is a plain equi-join, so
    a node with a third of all edges never meets in one task. Every round ends in a
    written table; the edge list never reaches the driver (only its size and a
    checksum, to see that nothing changed).
    """

    def oriented(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())

    pairs = written(oriented(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    before = state(pairs)
    while before[0]:
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour moves to the smallest one
        pairs_large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs_large = oriented(pairs_large)
        # small star: every smaller neighbour, and the node itself, moves to the smallest one
        least = pairs_large.groupBy("u").agg(F.min("v").alias("m"))
        moved = pairs_large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = written(oriented(moved.union(least.select("u", F.col("m").alias("v")))))
        after = state(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
