"""Operators over pages and their lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by_content(rows: DataFrame, text: str, order: str) -> DataFrame:
    """(sha, order): the first row of each content, named by 16 digits of its SHA-256."""
    return rows.groupBy(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256), 1, 16).alias("sha")).agg(F.min(order).alias(order))


def choose_text(cheap: Column, costly: Column, least: int = 100) -> Column:
    """The cheap text if it has enough characters, else the costly one if it is longer."""
    size = lambda c: F.length(F.trim(c))
    return F.when(size(cheap) >= least, cheap).when(size(costly) > size(cheap), costly).otherwise(cheap)


def longer(a: Column, b: Column) -> Column:
    return F.when(F.length(a) >= F.length(b), a).otherwise(b)


def repeated_lines(pages: DataFrame) -> DataFrame:
    """(doc, line): lines of 2 to 200 characters on at least max(3, 30 %) of a document's pages, of documents of 4 or more."""
    n = pages.groupBy("doc").agg(F.count_distinct("page").alias("n")).where("n >= 4")
    lines = pages.select("doc", "page", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", F.trim("line")).where(F.length("line").between(2, 200))
    counted = lines.groupBy("doc", "line").agg(F.count_distinct("page").alias("k"))
    return counted.join(n, "doc").where(F.col("k") >= F.greatest(F.lit(3), F.floor(F.col("n") * 0.3))).select("doc", "line", "k")


def broken_sentences(text: Column) -> Column:
    """How many paragraphs begin with a lower-case letter."""
    return F.size(F.filter(F.split(text, "\n\n"), lambda p: F.trim(p).rlike(r"^\p{Ll}")))


def islands(rows: DataFrame, by: str, order: str, flag: Column) -> DataFrame:
    """rows with run: the number of the run of equal flags that a row stands in, per group."""
    w = Window.partitionBy(by).orderBy(order)
    turn = F.when(flag != F.coalesce(F.lag(flag).over(w), ~flag), 1).otherwise(0)
    return rows.withColumn("_turn", turn).withColumn("run", F.sum("_turn").over(w)).drop("_turn")
