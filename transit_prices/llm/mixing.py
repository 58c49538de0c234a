"""Mixing sources to target weights by Pareto order sampling (native functions only).

Targets: every source gets a weight; the wanted total (``share`` of all sizes) is
dealt out by weight, no source above ``most_copies`` times its size, the excess
dealt again by weight until none is above (water filling, in closed form from the order of
caps over weights).

Documents: with expected copies e = target / source size (times the document's own weight,
if a column names one), floor(e) copies are certain. What is left of the target
is an order sample: with inclusion probability p = e - floor(e) and a uniform
number u hashed from id and text, documents are ranked by (u / (1 - u)) / (p / (1 - p)),
smallest first, and taken while the words fit: the document at the end is taken if that
brings the sum nearer. Reruns agree, because u depends on id, text and seed only, and rows
alike in all of them are numbered: being alike, it does not matter which gets which number.

Scale: ranks are mapped to (0, 1) and counted in bins (an aggregate with a map-side
part); running sums over the bins' small table find the bin at which a source's words
run out, and the same once more within that bin. Only rows of that last bin, about
one in a million of a source, are ordered one by one. So a source with a third of all rows
never meets in one task, and the order is exact.

Defined results: a null text has size 0; rows of size 0 take nothing; a null source
is a source of its own, last in order; rows that share an id, or have none, are drawn each
on its own; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, named, packed, unpacked, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0
BINS = 1024
#: Alike rows that are numbered in one go.
RUN = 10_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most_copies: float = MOST_COPIES) -> DataFrame:
    """Rows (source, source_size, weight, target) from rows (source, size). The
    windows run over one row per source."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    nth = (F.row_number().over(order) - 1) % len(weights)
    ranked = per_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), nth + 1))
    ranked = ranked.withColumn("cap", most_copies * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    # sources by cap / weight: the first ones are capped. level: what a unit of weight
    # would get if all before this source were capped and the rest shared by weight
    every = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), F.col("source"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    capped_before = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    total = share * F.sum("source_size").over(every)
    ranked = ranked.withColumn("level", (total - capped_before) / weight_left)
    ranked = ranked.withColumn("place", F.row_number().over(by_ratio))
    # the water level is that of the first source that is not above its cap
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(every)["level"]
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def uniform(doc_id: Column, digest: Column, nth: Column, seed: int) -> Column:
    """A number in (0, 1) from id, text and number: 13 hex digits of an MD5, plus a half."""
    name = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), digest, nth.cast("string"), F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_copies: float = MOST_COPIES,
    weight_col: str | None = None,
    seed: int = 9,
) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, copies, taken), one per row
    of ``docs``. ``weight_col``: relative inclusion odds of a document within its source
    (none: all alike)."""
    return _planned(docs, id_col, source_col, text_col, weights, share, most_copies, weight_col, seed).drop("digest")


def _planned(docs, id_col, source_col, text_col, weights=WEIGHTS, share=SHARE, most_copies=MOST_COPIES, weight_col=None, seed=9) -> DataFrame:
    """``mix`` with the text's digest."""
    own = named(weight_col).cast("double") if weight_col else F.lit(1.0)
    text = named(text_col)
    rows = docs.select(named(id_col).alias("doc_id"), named(source_col).alias("source"), words_in(text).alias("size"), F.coalesce(own, F.lit(0.0)).alias("w"), _digest(text).alias("digest"))
    # rows that are alike are counted and numbered anew, in runs that are dealt out again, so
    # that very many of them are no one task's work
    alike = rows.groupBy(*rows.columns).agg(F.count("*").alias("rows"))
    runs = alike.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(RUN).cast("long"))))
    runs = runs.repartition("digest", "start")
    rows = written(runs.withColumn("nth", F.explode(F.sequence("start", F.least(F.col("start") + RUN, F.col("rows")) - 1))).drop("start", "rows"))
    per_source = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("w")).alias("weighted"))
    targets = source_targets(rows, weights, share, most_copies).alias("t").join(
        per_source.alias("p"), F.col("t.source").eqNullSafe(F.col("p.source"))
    ).select(F.col("t.source").alias("s"), "source_size", "target", "weighted")
    expected = F.when(F.col("weighted") > 0, F.col("target") * F.col("w") / F.col("weighted")).otherwise(0.0)
    e = F.least(expected, F.lit(most_copies))
    u = uniform(F.col("doc_id"), F.col("digest"), F.col("nth"), seed)
    p = F.col("e") - F.floor("e")
    odds = (F.col("u") / (1 - F.col("u"))) * ((1 - p) / p)
    drawn = (
        rows.join(targets, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("e", e).withColumn("u", u)
        .withColumn("q", F.when((p > 0) & (F.col("size") > 0), odds / (1 + odds)))
        .withColumn("whole", F.floor("e"))
        .select("doc_id", "source", "digest", "size", "source_size", "target", "whole", "q")
    )
    drawn = written(drawn)
    left = drawn.groupBy("source").agg((F.max("target") - F.sum(F.col("size") * F.col("whole"))).alias("rest"))

    def crossing(candidates: DataFrame, budgets: DataFrame, bin_of: Column) -> DataFrame:
        """(source, bin, rest within it) of the bin where each source's budget ends."""
        sums = candidates.withColumn("bin", bin_of).groupBy("source", "bin").agg(F.sum("size").alias("words"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
        upto = sums.withColumn("upto", running).alias("b").join(budgets.alias("r"), F.col("b.source").eqNullSafe(F.col("r.source")))
        # budgets that all candidates fit into end in the last bin
        first = upto.groupBy(F.col("b.source").alias("source")).agg(
            F.min(F.when(F.col("upto") >= F.col("rest"), F.struct("bin", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest")))).alias("hit"),
            F.max(F.struct("bin", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"))).alias("end"),
        )
        return first.select("source", F.coalesce("hit", "end").alias("x")).select("source", "x.bin", "x.rest")

    with_q = drawn.where("q is not null").select("doc_id", "source", "size", "q")
    bin1 = F.floor(F.col("q") * BINS)
    first = written(crossing(with_q, left, bin1))
    in_first = with_q.alias("c").join(first.alias("f"), F.col("c.source").eqNullSafe(F.col("f.source")) & (bin1 == F.col("f.bin"))).select("c.*")
    bin2 = F.floor(F.col("q") * BINS * BINS)
    second = written(crossing(in_first, first.select("source", "rest"), bin2))
    in_second = in_first.alias("c").join(second.alias("f"), F.col("c.source").eqNullSafe(F.col("f.source")) & (bin2 == F.col("f.bin"))).select("c.*", "f.rest")
    # equal ranks go together: range frames
    order = Window.partitionBy("source").orderBy("q")
    upto = F.sum("size").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.sum("size").over(Window.partitionBy("source", "q"))
    last = in_second.withColumn("fits", upto - same / 2.0 <= F.col("rest"))
    limit = last.groupBy("source").agg(F.max(F.when(F.col("fits"), F.col("q"))).alias("q_last"))
    ends = second.alias("s").join(limit.alias("l"), F.col("s.source").eqNullSafe(F.col("l.source")), "left").select(
        F.col("s.source").alias("end_source"), F.col("s.bin").alias("end_bin"), "q_last"
    )
    # taken: everything in bins before the last one, and the last one up to its end
    before = F.floor(F.col("q") * BINS * BINS) < F.col("end_bin")
    extra = F.coalesce((before | (F.col("q") <= F.col("q_last"))).cast("int"), F.lit(0))
    extra = F.when(F.col("q").isNull(), F.lit(0)).otherwise(extra)
    # one row per source: small enough to be joined as the session sees fit
    out = drawn.join(written(ends), F.col("source").eqNullSafe(F.col("end_source")), "left")
    copies = (F.col("whole") + extra).cast("int")
    return out.select("doc_id", "source", "digest", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def repeated(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (none, once, twice). Rows
    alike in id, source and text are numbered, and the first ones get the most copies."""
    plan = _planned(docs, id_col, source_col, text_col, **options).where("size > 0")
    keys = ["plan_id", "plan_source", "plan_digest"]
    plan = plan.select(F.col("doc_id").alias(keys[0]), F.col("source").alias(keys[1]), F.col("digest").alias(keys[2]), "copies")
    once = [F.count(F.when(F.col("copies") >= c, 1)).alias(f"least{c}") for c in (1, 2)]
    groups = written(plan.groupBy(*keys).agg(F.count("*").alias("rows"), F.max("copies").alias("most"), F.min("copies").alias("least"), *once).where("most > 0"))
    rows = packed(docs, id=id_col, source=source_col, text=text_col).withColumn("digest", _digest(F.col("text"))).drop("text")
    match = F.col("id").eqNullSafe(F.col(keys[0])) & F.col("source").eqNullSafe(F.col(keys[1])) & (F.col("digest") == F.col(keys[2]))
    # the plan grows with the table: the same shuffle at every size, never a broadcast
    taken = rows.join(groups.where("most = least").hint("merge"), match).select("row", F.col("most").alias("copies"))
    mixed = groups.where("most > least")
    if not mixed.isEmpty():  # rows of one group with unlike numbers of copies
        some = written(rows.join(mixed.hint("merge"), match).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
        # numbered within the partitions they lie in, which start where those before end
        per = some.groupBy(*keys, "part").agg(F.count("*").alias("n"))
        start = F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        per = per.select(*(F.col(k).alias(f"of_{k}") for k in keys), F.col("part").alias("of_part"), start.alias("start"))
        same = F.col("part") == F.col("of_part")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
        nth = F.col("start") + F.row_number().over(Window.partitionBy(*keys, "part").orderBy("at")) - 1
        some = some.join(per, same).withColumn("nth", nth)
        copies = (F.col("nth") < F.col("least1")).cast("int") + (F.col("nth") < F.col("least2")).cast("int")
        taken = taken.unionByName(some.select("row", copies.alias("copies")).where("copies > 0"))
    return unpacked(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs.columns)
