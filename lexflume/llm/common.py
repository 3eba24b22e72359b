"""What several operators of this subpackage share."""

from __future__ import annotations

import gc
import tempfile
import time

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; every other character belongs to a word.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``; where that is unset one is made, in local mode only."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="lexflume-"))
    return sc._jsc.sc().getCheckpointDir().get()


def kept(df: DataFrame) -> DataFrame:
    """The rows of df, written once to the shared folder, with their lineage cut.

    A reliable checkpoint survives lost executors, and its files go when nothing refers to them any more.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def freed(spark: SparkSession) -> None:
    """Lets go of the shuffle files of results that are kept by now: they stay until the driver collects its garbage.

    Several times, since what refers to them is only found to be garbage itself at first.
    """
    for _ in range(4):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)  # references are cleared by threads of their own


def split_join(rows: DataFrame, of: DataFrame, key: str, n: str, total: int, share: int = 1000) -> DataFrame:
    """rows joined to the one row that of has for their key; n is how many of the total rows have that key.

    Keys with more than total / share rows are fewer than share, so they are broadcast, and no task gets such a key's rows.
    """
    hot = of.where(F.col(n) * share > total)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(of.where(F.col(n) * share <= total), key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)


def held_out(doc_id, folds: int, fold: int):
    """Whether crc32 of the id as text falls in the fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == fold


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), element by element."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of an edge table (a, b) of longs; component is the smallest node of each component.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the edges are stars, in a number of
    rounds that grows with the logarithm of the longest path. Each step is a minimum per node, combined before
    the shuffle, and a join on the node, so no neighbourhood is gathered in one task. Self-loops and nulls are
    ignored; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    e = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        both = e.select(F.inline(F.expr("array(struct(u, v), struct(v as u, u as v))")))  # read once, not as a union
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near, "u").select(F.inline(F.expr("array(struct(u, m as v), struct(v as u, m as v))"))).where("u <> v")
        e = kept(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct().toDF("node", "component"))
