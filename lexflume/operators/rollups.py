"""Roll-ups and rankings of what was extracted: pages, spans, panels, plots, runs, candidates, rungs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_words(words: DataFrame, least: float = 15) -> DataFrame:
    """(page, text, n): a page's words (page, place, word, confidence) that are sure enough, in order. A page is one row."""
    w = words.where(F.col("confidence") >= least).groupBy("page").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w"))
    return w.select("page", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("text"), F.size("w").cast("long").alias("n"))


def low_pages(pages: DataFrame, text: str = "text", least: int = 100) -> DataFrame:
    """The pages with too little text to trust, to be read again; one row a page, however many a source has."""
    return pages.where(F.length(text) < least)


def span_roles(spans: DataFrame) -> DataFrame:
    """(line, span, role) of spans (line, span, size, baseline): above or below the line's upper median, and smaller."""
    mid = lambda c: F.element_at(F.array_sort(F.collect_list(c)), F.expr("cast(count(1) div 2 + 1 as int)"))  # noqa: E731  lines are short
    m = spans.groupBy("line").agg(mid("size").alias("med"), mid("baseline").alias("base"))
    small, off = F.col("size") <= 0.85 * F.col("med"), F.col("base") - F.col("baseline")
    role = F.when(small & (off >= 0.15 * F.col("med")), "super").when(small & (-off >= 0.15 * F.col("med")), "sub").otherwise("body")
    return spans.join(m, "line").select("line", "span", role.alias("role"))


def column_of(x: Column, width: float, n: int) -> Column:
    """Which of n columns of a page's width a place is in."""
    return F.least(F.lit(n - 1), F.floor(x / width * n))


def calibrated(pixel: Column, slope: float, intercept: float) -> Column:
    """The value that an axis gives to a pixel."""
    return pixel * slope + intercept


def clamped(x: Column, low: float, high: float) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - low) / (high - low)))


def backfilled(figures: DataFrame, captions: DataFrame) -> DataFrame:
    """figures (fig, num, own) with caption: their own, else the first of captions (num, text) with their number."""
    c = captions.groupBy(F.col("num").alias("_n")).agg(F.min("text").alias("_found"))
    return figures.join(c, F.col("num") == F.col("_n"), "left").select("fig", "num", F.coalesce(F.nullif(F.trim("own"), F.lit("")), "_found").alias("caption"))


def nearest_nodes(points: DataFrame, nodes: DataFrame, most: float = 80.0) -> DataFrame:
    """(fig, pt, node): the nearest of a figure's nodes (fig, node, x, y) to each point (fig, pt, px, py), within most."""
    d = points.join(nodes, "fig").withColumn("_d", F.expr("(px - x) * (px - x) + (py - y) * (py - y)")).where(F.col("_d") <= most * most)
    return d.groupBy("fig", "pt").agg(F.min_by("node", F.struct("_d", "node")).alias("node"))


def totals(rows: DataFrame, by: str, done: Column, refs: Column) -> DataFrame:
    """(confidence, success, cached, refs) per value of by, and of all under 'all'."""
    o = rows.withColumns({"_done": done, "_refs": refs}).rollup(by).agg(F.count_if("_done").alias("success"), F.count_if(~F.col("_done")).alias("cached"), F.sum(F.when(F.col("_done"), F.col("_refs"))).alias("refs"))
    return o.select(F.coalesce(by, F.lit("all")).alias("confidence"), "success", "cached", "refs")


def scatter_summary(markers: DataFrame) -> DataFrame:
    """Counts, mean and range of markers (color, cluster, value)."""
    return markers.groupBy("color", "cluster").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean"), F.min("value").alias("lo"), F.max("value").alias("hi"))


def pie_shares(samples: DataFrame) -> DataFrame:
    """(fig, color, pct): the share of a figure's samples that each colour has."""
    n = samples.groupBy("fig", "color").agg(F.count(F.lit(1)).alias("_n"))
    return n.select("fig", "color", F.round(100.0 * F.col("_n") / F.sum("_n").over(Window.partitionBy("fig")), 2).alias("pct"))


def stacked_matrix(segments: DataFrame, kinds: list[str]) -> DataFrame:
    """A row per bar of segments (fig, bar, kind, value), a column per kind, and their total."""
    p = segments.where(F.col("kind").isin(*kinds)).groupBy("fig", "bar").pivot("kind", kinds).agg(F.sum("value"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return p.select("fig", "bar", *[zero(k).alias(k) for k in kinds], F.round(sum((zero(k) for k in kinds[1:]), zero(kinds[0])), 4).alias("total"))


def line_medians(points: DataFrame) -> DataFrame:
    """(series, x, y): the median of the points of a series at each place."""
    return points.groupBy("series", "x").agg(F.percentile("value", 0.5).alias("y"))


def panel_status(panels: DataFrame) -> DataFrame:
    """(fig, status, confidence) of a figure from the statuses of its panels (fig, status)."""
    s = panels.groupBy("fig").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "partial").alias("partial"))
    status = F.when(F.col("ok") == F.col("n"), "ok").when(F.col("ok") + F.col("partial") > 0, "partial").otherwise("failed")
    return s.select("fig", status.alias("status"), F.round((0.95 * F.col("ok") + 0.5 * F.col("partial")) / F.col("n"), 6).alias("confidence"))


def accuracies(trials: DataFrame) -> DataFrame:
    """Counts and accuracy of trials (kind, cond, hit) by kind, by condition, by both, and of all."""
    return trials.cube("kind", "cond").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("hit"), 6).alias("accuracy"))


def eval_summary(runs: DataFrame) -> DataFrame:
    """Per extractor of runs (extractor, ok, f1, seconds): how many went well, the mean score of those, the mean time."""
    n = lambda c, name: F.count_if(c).alias(name)
    return runs.groupBy("extractor").agg(n(F.col("ok"), "n_ok"), n(~F.col("ok"), "n_err"), F.round(F.avg(F.when(F.col("ok"), F.col("f1"))), 3).alias("avg_f1"), F.round(F.avg("seconds"), 3).alias("avg_s"))


def worst_papers(stats: DataFrame, n: int = 10) -> DataFrame:
    """The n papers with most issues, then least coverage, fewest pages: a report of that length."""
    return stats.where("n_issues > 0").orderBy(F.desc("n_issues"), "coverage", "n_pages", "slug").limit(n)


def ladder(scores: DataFrame, rungs: int = 3, least: float = 0.15) -> DataFrame:
    """(fig, ladder): the best kinds of scores (fig, kind, score) that are good enough, best first."""
    r = scores.withColumn("_n", F.row_number().over(Window.partitionBy("fig").orderBy(F.desc("score"), "kind"))).where((F.col("_n") <= rungs) & (F.col("score") >= least))
    return r.groupBy("fig").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "kind"))), lambda x: x["kind"]), ">").alias("ladder"))


def best_candidate(rows: DataFrame, by: str, pick: str, *rank: Column) -> DataFrame:
    """(by, best, tried): of each group's candidates the one that ranks highest."""
    return rows.groupBy(by).agg(F.max_by(pick, F.struct(*rank)).alias("best"), F.count(F.lit(1)).alias("tried"))


def cascade(runs: DataFrame, enough: float = 0.8) -> DataFrame:
    """(fig, run_order, status, conf, n_runs): runs in order until one is ok and sure; of those the best, the earlier of equals."""
    stop = F.min(F.when((F.col("status") == "ok") & (F.col("conf") >= enough), F.col("run_order"))).over(Window.partitionBy("fig"))
    u = runs.withColumn("_stop", stop).where("_stop is null or run_order <= _stop")
    rank = F.expr("case status when 'ok' then 3 when 'partial' then 2 else 0 end")
    best = u.groupBy("fig").agg(F.max_by(F.struct("run_order", "status", "conf"), F.struct(rank, F.col("conf"), -F.col("run_order"))).alias("b"), F.count(F.lit(1)).alias("n_runs"))
    return best.select("fig", "b.*", "n_runs")


def top_and_margin(scores: DataFrame) -> DataFrame:
    """(fig, kind, score, margin): the best of a figure's scores and by how much it is."""
    w = Window.partitionBy("fig").orderBy(F.desc("score"), "kind")
    r = scores.withColumn("_n", F.row_number().over(w)).withColumn("_second", F.lead("score").over(w)).where("_n = 1")
    return r.select("fig", "kind", "score", F.round(F.col("score") - F.coalesce("_second", F.lit(0.0)), 6).alias("margin"))


def runs_of(rows: DataFrame, by: str, order: str, key: str) -> DataFrame:
    """(by, run, key, n, first_id): runs of rows with one key, in order."""
    w = Window.partitionBy(by).orderBy(order)
    r = rows.withColumn("_s", F.when(F.col(key) == F.lag(key).over(w), 0).otherwise(1)).withColumn("run", F.sum("_s").over(w))
    return r.groupBy(by, "run", key).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_id"))


def rank_error(truth: DataFrame, got: DataFrame) -> DataFrame:
    """(kind, n, mae): values (kind, value, id) of both sides matched by rank within their kind, and how far off they are."""
    w = Window.partitionBy("kind").orderBy("value", "id")
    side = lambda d, c: d.select("kind", F.col("value").alias(c), F.row_number().over(w).alias("r"))
    return side(truth, "_v").join(side(got, "_u"), ["kind", "r"]).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(F.col("_v") - F.col("_u"))), 4).alias("mae"))


def orphans(all_: DataFrame, emitted: DataFrame, *keys: str) -> DataFrame:
    """Keys that should be there and were not emitted."""
    return all_.select(*keys).distinct().join(emitted.select(*keys).distinct(), list(keys), "left_anti")


def pending(rows: DataFrame, done: DataFrame, key: str, only: list | None = None) -> DataFrame:
    """The keys of rows that aren't done; of those asked for, if any are."""
    rows = rows if only is None else rows.where(F.col(key).isin(*only))
    return rows.select(key).join(done.select(key), key, "left_anti")


def totals_of(rows: DataFrame, *columns: str) -> DataFrame:
    """One row: the sum of each column over all papers."""
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in columns])


def batch_report(rows: DataFrame) -> DataFrame:
    """(report): one JSON object with the counts of a batch's papers (status, seconds), for a text sink."""
    n = lambda s: F.count_if(F.col("status") == s)
    r = rows.agg(F.count(F.lit(1)).alias("total"), n("ok").alias("ok"), n("failed").alias("failed"), F.coalesce(F.sum("seconds"), F.lit(0)).cast("long").alias("seconds"))
    return r.select(F.to_json(F.struct("total", "ok", "failed", "seconds")).alias("report"))


def with_texts(figures: DataFrame, texts: DataFrame) -> DataFrame:
    """figures (fig, ...) with the text that was read in each, or null; of several the first."""
    return figures.join(texts.groupBy("fig").agg(F.min("text").alias("text")), "fig", "left")


def regions(images: DataFrame, empty: DataFrame) -> DataFrame:
    """(page, region, x0, y0, x1, y1, is_image): what a caption can belong to, images and empty places."""
    cols = ["page", "region", "x0", "y0", "x1", "y1"]
    return images.select(*cols, F.lit(True).alias("is_image")).unionByName(empty.select(*cols, F.lit(False).alias("is_image")))
