"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a schedule w(t) of it over training time t in [0, 1]. Its target is the share of all
words that the weights give it, held at REPEATS times its own words, the excess shared anew. The integral of its
schedule, scaled to the target, is its cumulative demand of words; a document that covers words c to c + size of its
source's shuffled, repeated stream stands where that demand reaches c: the demand is inverted in closed form. Documents
are then range-sorted by position. All steps are DataFrame expressions.

Running sums over a source are made in two levels: a document's hash deals it to one of about sqrt(n) buckets,
sums per bucket are accumulated over the buckets, and only a bucket's own rows are accumulated row by row. So a source
with a third of all rows is spread over all buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexflume.llm.common import SPACE, freed, kept, table

#: Weights by rank of the source, repeating, and how often a source may be repeated.
WEIGHTS, REPEATS = (1, 2, 3), 3
#: The schedule is w(t) = 1 - s + 2 s t, s by rank, repeating: some sources fade out, some come in later.
SLOPES = (-0.5, 0.0, 0.5)
SEED = 20240229


def sized(docs: DataFrame) -> DataFrame:
    """docs with size: the number of words of the text, 0 if null."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long"))


def ranked(sources: DataFrame) -> DataFrame:
    """sources (a row per source) with rank, from 0, by code point, null last.

    The rank is a running count over range partitions plus the partitions' offsets: no task gets all sources.
    """
    order = [F.col("source").isNull(), F.col("source")]
    parts = kept(sources.repartitionByRange(32, *order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over a row per partition
    before = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    w = Window.partitionBy("_part").orderBy(*order)
    return parts.join(F.broadcast(before), "_part").withColumn("rank", F.col("before") + F.row_number().over(w) - 1).drop("_part", "before")


def targets(sources: DataFrame) -> DataFrame:
    """sources (source, source_size) with rank, weight, slope and target.

    The capped sources are those whose cap is below the level times their weight; the level rises as each is taken
    out, until none is above its cap. Each round is one aggregate over sources; there are at most as many rounds as
    sources, in practice a few.
    """
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod("rank", F.lit(len(values))) + 1).cast("int"))
    s = kept(ranked(sources).withColumn("weight", pick([float(w) for w in WEIGHTS])).withColumn("slope", pick(SLOPES)).withColumn("cap", F.col("source_size").cast("double") * REPEATS))
    total = s.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (float(total[0]) / total[1] if total[1] else 0.0), -1
    while True:
        at = F.col("cap") <= F.lit(level) * F.col("weight")
        n, used, left = s.agg(F.count(F.when(at, 1)), F.sum(F.when(at, F.col("cap"))), F.sum(F.when(~at, F.col("weight")))).first()
        if n == capped or not left:
            break
        capped, level = n, (float(total[0]) - (used or 0.0)) / left
    return s.withColumn("target", F.least(F.col("cap"), F.lit(level) * F.col("weight"))).drop("cap")


def placed(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """rows (keys, source, size) with source_size, target, taken, full (whole copies), part (words of the copy that the
    target cuts, 0 if none) and position (of the first copy, null if none is taken).

    Ties in the hash are settled by the keys and the size; repeated rows share all of these and are interchangeable.
    """
    rows = kept(rows.withColumn("_h", F.xxhash64(F.lit(SEED), *keys)))
    n = rows.count()
    bits = max(4, math.ceil(math.log2(max(n, 1)) / 2))
    rows = rows.withColumn("_b", F.shiftrightunsigned("_h", 64 - bits))
    sums = rows.groupBy("source", "_b").agg(F.sum("size").alias("n"))
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    before = sums.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).drop("n")
    per = before.alias("x").join(goal.alias("y"), F.expr("x.source <=> y.source")).select("x.source", "_b", F.coalesce("before", F.lit(0)).alias("before"), "source_size", "target", "slope")
    own = Window.partitionBy("source", "_b").orderBy("_h", *keys, "size").rowsBetween(Window.unboundedPreceding, -1)
    t = rows.withColumn("_in", F.coalesce(F.sum("size").over(own), F.lit(0)))
    t = t.alias("r").join(per.alias("p"), F.expr("r.source <=> p.source and r._b = p._b")).select("r.*", "before", "source_size", "target", "slope")
    start, size, whole = F.col("before") + F.col("_in"), F.col("source_size"), F.floor(F.col("target")).cast("long")
    full = F.when(size > 0, F.floor(whole / size)).otherwise(0).cast("long")
    part = F.when(size > 0, F.greatest(F.lit(0), F.least(F.col("size"), whole - full * size - start))).otherwise(0).cast("long")
    t = t.withColumns({"_start": start, "full": full, "part": part}).withColumn("taken", F.col("full") * F.col("size") + F.col("part"))
    return t.withColumn("position", F.when(F.col("taken") > 0, position(F.col("_start"), F.col("target"), F.col("slope")))).drop("_h", "_b", "_in", "before")


def position(words, target, slope):
    """The time at which a source's demand, target times the integral (1 - s) t + s t^2 of its schedule, reaches words."""
    u = F.least(F.lit(1.0), words / target)
    return F.when(slope == 0, u).otherwise((F.sqrt((1 - slope) * (1 - slope) + 4 * slope * u) - (1 - slope)) / (2 * slope))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, position) of each row of docs (doc_id, text, source), in training order.

    A null text has no words; nothing is taken of a document without words. Sources without words have target 0. The
    copy at which a source's target is reached is taken in part, so taken words sum to the target, rounded down.
    Rows not taken come last. An empty table gives an empty result.
    """
    t = placed(sized(docs.select("doc_id", "source", "text")).drop("text"), ("doc_id",))
    return t.select("doc_id", "size", "source_size", "target", "taken", "position").orderBy(F.coalesce("position", F.lit(2.0)), F.xxhash64(F.lit(SEED), "doc_id"), "doc_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs in training order, a row per copy that the mix takes; the copy that a target cuts has its first words only.

    Repeated rows are numbered on both sides and paired one to one.
    """
    freed(spark)  # what earlier stages have left
    cols, k = docs.columns, ["_k", "_m"]
    keyed = sized(docs.withColumns({"_k": F.xxhash64(*cols), "_m": F.hash(*cols)}))
    plan = placed(keyed.select(*k, "source", "size"), tuple(k))
    plan = plan.withColumn("_n", F.row_number().over(Window.partitionBy(*k).orderBy("_start"))).where("taken > 0").drop("source", "size")
    rows = keyed.withColumn("_r", F.row_number().over(Window.partitionBy(*k).orderBy("size")))
    t = rows.join(plan, k).where("_r - _n = 0")
    copies = F.sequence(F.lit(0), F.col("full").cast("int") - F.when(F.col("part") > 0, 0).otherwise(1))
    t = t.withColumn("_copy", F.explode(copies))
    t = t.withColumn("_at", position(F.col("_start") + F.col("_copy") * F.col("source_size"), F.col("target"), F.col("slope")))
    cut = (F.col("_copy") == F.col("full")) & (F.col("part") < F.col("size"))
    pieces = F.split(F.regexp_replace("text", f"^[{SPACE}]+", ""), f"(?<=[{SPACE}])(?=[^{SPACE}])")
    first = F.regexp_replace(F.array_join(F.slice(pieces, F.lit(1), F.col("part").cast("int")), ""), f"[{SPACE}]+$", "")
    t = t.withColumn("text", F.when(cut, first).otherwise(F.col("text")))
    if "n_chars" in cols:
        t = t.withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return t.orderBy("_at", *k).select(*cols)
