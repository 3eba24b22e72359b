"""Sinks: tables by key, and one text file per paper."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(rows: DataFrame, done: DataFrame, *key: str) -> DataFrame:
    """The rows whose key is not done yet."""
    return rows.join(done.select(*key), list(key), "left_anti")


def append_new(rows: DataFrame, path: str, *key: str) -> None:
    """Appends the rows whose keys the table at path lacks; a first write makes the table."""
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        rows = pending(rows, spark.read.parquet(path), *key)
    rows.write.mode("append").parquet(path)


def write_texts(rows: DataFrame, path: str) -> None:
    """rows (slug, text) as path/slug=<slug>/part-*.txt, one file a paper; line ends in texts stay."""
    rows.select("slug", "text").repartition(F.col("slug")).write.mode("overwrite").partitionBy("slug").option("lineSep", "\n").text(path)


def write_records(rows: DataFrame, path: str) -> None:
    """rows as JSON lines, a folder per slug."""
    rows.repartition(F.col("slug")).write.mode("overwrite").partitionBy("slug").json(path)
