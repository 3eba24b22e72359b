"""Text extraction metrics over token arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexflume.functions.text import tokens


def char_ratio(a: Column, b: Column) -> Column:
    return F.when(F.length(b) > 0, F.round(F.length(a) / F.length(b), 3)).otherwise(0.0)


def word_metrics(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with jaccard, precision, recall, f1 of the sets of words of columns a and b, and char_ratio."""
    p = pairs.withColumn("_a", F.array_distinct(tokens(F.col(a)))).withColumn("_b", F.array_distinct(tokens(F.col(b))))
    p = p.withColumn("_i", F.size(F.array_intersect("_a", "_b"))).withColumn("_u", F.size("_a") + F.size("_b") - F.col("_i"))
    prec = F.when(F.size("_a") > 0, F.col("_i") / F.size("_a")).otherwise(0.0)
    rec = F.when((F.size("_a") > 0) & (F.size("_b") > 0), F.col("_i") / F.size("_b")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    out = {"jaccard": F.when(F.col("_u") > 0, F.round(F.col("_i") / F.col("_u"), 4)).otherwise(0.0), "precision": F.round(prec, 4), "recall": F.round(rec, 4), "f1": F.round(f1, 4), "char_ratio": char_ratio(F.col(a), F.col(b))}
    return p.withColumns(out).drop("_a", "_b", "_i", "_u")


def bag_wer(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, wer): one less the share of b's words, as a bag, that a has; 1 without words in b.

    Words are counted per key on both sides and joined, so no array of words meets another.
    """
    count = lambda c, n: pairs.select(key, F.explode(tokens(F.col(c))).alias("w")).groupBy(key, "w").agg(F.count(F.lit(1)).alias(n))
    m = count(b, "nb").join(count(a, "na"), [key, "w"], "left")
    m = m.groupBy(key).agg(F.sum("nb").alias("n"), F.sum(F.least("nb", F.coalesce("na", F.lit(0)))).alias("m"))
    return pairs.select(key).join(m, key, "left").select(key, F.when(F.col("n") > 0, F.round(F.greatest(F.lit(0.0), 1 - F.col("m") / F.col("n")), 4)).otherwise(1.0).alias("wer"))


def upper_medians(rows: DataFrame, by: str, value: str) -> DataFrame:
    """(by, upper_median) of value: counts are summed over its different values, so no group's rows are in one task."""
    n = rows.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(by)
    upto = F.sum("_n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    r = n.withColumns({"_to": upto, "_all": F.sum("_n").over(w)})
    return r.where("_to > _all div 2").groupBy(by).agg(F.min(value).alias("upper_median"))


def distinct_words(rows: DataFrame, by: str, text: str) -> DataFrame:
    """(by, n): how many different words a group's texts hold; combined before the shuffle, without gathering them."""
    w = rows.select(by, F.explode(F.array_distinct(tokens(F.col(text)))).alias("_w")).distinct()
    return w.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
