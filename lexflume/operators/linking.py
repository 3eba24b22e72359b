"""Links between citations, figures, captions and page regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def link_citations(cites: DataFrame, refs: DataFrame) -> DataFrame:
    """cites (doc, surname, year, ...) with ref_no: the document's first reference by that surname and year, or null."""
    first = refs.groupBy("doc", F.lower("surname").alias("_s"), F.col("year").alias("_y")).agg(F.min("ref_no").alias("ref_no")).withColumnRenamed("doc", "_d")
    return cites.join(first, (F.col("doc") == F.col("_d")) & (F.lower("surname") == F.col("_s")) & (F.col("year") == F.col("_y")), "left").drop("_d", "_s", "_y")


def pair_captions(captions: DataFrame, regions: DataFrame) -> DataFrame:
    """(page, caption, region, how): the nearest region above that overlaps a third of the caption's width, else the
    nearest image, else none. Both are joins on the page with a least per caption, taken before any shuffle of pairs."""
    c, r = captions.alias("c"), regions.alias("r")
    overlap = F.least("c.x1", "r.x1") - F.greatest("c.x0", "r.x0")
    both = c.join(r, F.col("c.page") == F.col("r.page"))
    above = both.where((F.col("r.y1") <= F.col("c.y0") + 20) & (overlap >= 0.3 * (F.col("c.x1") - F.col("c.x0"))))
    above = above.groupBy("c.page", "c.caption").agg(F.min_by("r.region", F.struct(F.col("c.y0") - F.col("r.y1"), F.col("r.region"))).alias("a"))
    mid = lambda t, k: (F.col(f"{t}.{k}0") + F.col(f"{t}.{k}1")) / 2
    far = (mid("c", "x") - mid("r", "x")) * (mid("c", "x") - mid("r", "x")) + (mid("c", "y") - mid("r", "y")) * (mid("c", "y") - mid("r", "y"))
    near = both.where("r.is_image").groupBy("c.page", "c.caption").agg(F.min_by("r.region", F.struct(far, F.col("r.region"))).alias("n"))
    out = captions.select("page", "caption").join(above, ["page", "caption"], "left").join(near, ["page", "caption"], "left")
    how = F.when(F.col("a").isNotNull(), "above").when(F.col("n").isNotNull(), "nearest").otherwise("unpaired")
    return out.select("page", "caption", F.coalesce("a", "n").alias("region"), how.alias("how"))


def last_marker(rows: DataFrame, markers: DataFrame) -> DataFrame:
    """rows (doc, pos) with marker: the last marker (doc, pos, marker) before each, by one ordered pass per document."""
    both = rows.select("doc", "pos", F.lit(None).cast("long").alias("m"), F.lit(0).alias("k")).unionByName(markers.select("doc", "pos", F.col("marker").cast("long").alias("m"), F.lit(1).alias("k")))
    w = Window.partitionBy("doc").orderBy("pos", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("marker", F.last("m", ignorenulls=True).over(w)).where("k = 0").select("doc", "pos", "marker")
