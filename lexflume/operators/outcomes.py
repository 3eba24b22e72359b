"""What comes of a figure or paper in the end: slices, boxes, panels, answers that were checked, lines of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexflume.functions import repair as P
from lexflume.operators.charts import clustered
from lexflume.operators.markdown import blocks, valid_table


def pie_slices(wedges: DataFrame, angles: int = 720) -> DataFrame:
    """(plot, place, key, percent, status) from wedges (plot, key, a, b): a colour's share of what all wedges cover.

    A circle that they cover under four fifths of is no pie; more than twelve slices, or one, are a partial result.
    """
    s = wedges.groupBy("plot", "key").agg(F.sum(F.col("b") - F.col("a")).alias("span"))
    w = Window.partitionBy("plot")
    s = s.withColumns({"_all": F.sum("span").over(w), "_n": F.count(F.lit(1)).over(w), "place": F.row_number().over(w.orderBy(F.desc("span"), "key"))})
    status = F.when(F.col("_all") < 0.8 * angles, "no_bars").when(F.col("_n").between(2, 12), "ok").otherwise("partial")
    return s.select("plot", "place", "key", F.when(status != "no_bars", F.round(100.0 * F.col("span") / F.col("_all"), 2)).alias("percent"), status.alias("status"))


def box_candidates(boxes: DataFrame, width: float, height: float) -> DataFrame:
    """(chart, boxes) of components (chart, x, y, w, h, area) that can be boxes of a plot of that size, from left to right;
    of those that overlap sideways the largest. A chart's boxes are one row."""
    w, h = F.col("w"), F.col("h")
    fine = (w >= 10) & (h >= max(10.0, 0.06 * height)) & (w <= 0.30 * width) & (h <= 0.70 * height) & (w / h).between(0.20, 4) & (F.col("area") / (w * h) >= 0.10)
    kind = "array<struct<x:int,y:int,w:int,h:int>>"
    g = boxes.where(fine).groupBy("chart").agg(F.array_sort(F.collect_list(F.struct("x", "y", "w", "h"))).cast(kind).alias("b"))

    def step(out: Column, b: Column) -> Column:
        last = F.element_at(out, -1)
        over = (F.size(out) > 0) & (b["x"] < last["x"] + last["w"])
        larger = b["w"] * b["h"] > last["w"] * last["h"]
        put = F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(b))
        return F.when(over & larger, put).when(over, out).otherwise(F.concat(out, F.array(b)))

    return g.select("chart", F.aggregate("b", F.array().cast(kind), step).alias("boxes"))


def box_summary(q1: Column, q3: Column, median: Column, top: Column, bottom: Column, slope: float, intercept: float) -> Column:
    """Struct of the values of a box plot's box from the pixels of its edges, median and whiskers."""
    at = lambda p: F.round(p * slope + intercept, 3)
    return F.struct(at(q1).alias("q1"), at(q3).alias("q3"), at(median).alias("median"), F.least(at(top), at(bottom)).alias("low"), F.greatest(at(top), at(bottom)).alias("high"))


def panel_grid(labels: DataFrame, width: float, height: float, near: float = 0.04) -> DataFrame:
    """(fig, text, row, col) of labels of panels (fig, text, cx, cy): rows and columns are clusters of their places."""
    g = labels.groupBy("fig").agg(F.array_sort(F.collect_list(F.struct(F.col("cy").cast("double").alias("p"), "text"))).alias("ys"), F.array_sort(F.collect_list(F.struct(F.col("cx").cast("double").alias("p"), "text"))).alias("xs"))
    places = lambda c, tolerance: F.arrays_zip(F.transform(c, lambda e: e["text"]).alias("text"), clustered(F.transform(c, lambda e: e["p"]), tolerance).alias("g"))
    side = lambda c, tolerance, name: g.select("fig", F.explode(places(F.col(c), tolerance)).alias("e")).select("fig", F.col("e.text").alias("text"), F.col("e.g").alias(name))
    return side("ys", near * height, "row").join(side("xs", near * width, "col"), ["fig", "text"])


def best_attempt(attempts: DataFrame, enough: float = 0.5) -> DataFrame:
    """(fig, run, kind, status, conf, tried): attempts in order until one is ok and sure enough; of those the best."""
    stop = F.min(F.when((F.col("status") == "ok") & (F.col("conf") >= enough), F.col("run"))).over(Window.partitionBy("fig"))
    worth = F.when(F.col("status") == "ok", 3.0).when(F.col("status") == "partial", 1.5).otherwise(0.0) + F.col("conf")
    u = attempts.withColumn("_stop", stop).where("_stop is null or run <= _stop").withColumn("_w", worth)
    b = u.groupBy("fig").agg(F.max_by(F.struct("run", "kind", "status", "conf"), F.struct("_w", -F.col("run"))).alias("b"), F.count(F.lit(1)).alias("tried"))
    return b.select("fig", "b.*", "tried")


def checked_answer(kind: Column, raw: Column) -> Column:
    """Struct (alt, body, error) of a model's answer about a figure of a kind: a diagram, table or formula if it must have
    one and has, else a sentence, else the error that it has none."""
    say = lambda alt, body, error=None: F.struct(alt.alias("alt"), body.alias("body"), F.lit(error).cast("string").alias("error"))
    none = F.lit(None).cast("string")
    diagram, table, formula, sentence = P.mermaid(raw), valid_table(raw), P.latex(raw), P.short_sentence(raw)
    out = F.when(kind.isin("flow_diagram", "schematic") & diagram.isNotNull(), say(F.lit("Diagram extracted via vision model."), diagram))
    out = out.when(kind.isin("table_as_image", "bar_chart", "pie_chart") & table.isNotNull(), say(P.short_sentence(raw, 40), table))
    out = out.when((kind == "equation") & formula.isNotNull(), say(F.lit("Equation."), formula))
    return out.when(sentence.isNotNull(), say(sentence, none)).otherwise(say(none, none, "output-failed-validation"))


def unwrapped_references(docs: DataFrame, key: str, text: str, least: int = 3) -> DataFrame:
    """(key, text): tables of which at least so many rows begin with a number and a point become numbered lines."""
    b = blocks(docs, key, text)
    cells = lambda x: F.transform(F.split(F.regexp_replace(F.regexp_replace(F.trim(x), r"^\|", ""), r"\|$", ""), r"\|"), lambda v: F.trim(v))
    said = lambda c, k: F.array_join(F.filter(F.slice(c, k, F.greatest(F.size(c), F.lit(1))), lambda v: v != ""), " ")
    rows = F.filter("lines", lambda x: (F.trim(x) != "") & ~x.rlike(r"^\s*\|(?:\s*:?-+:?\s*\|)+\s*$"))
    none = F.array().cast("array<string>")

    def step(out: Column, x: Column) -> Column:
        c, more = cells(x), said(cells(x), 1)
        grown = F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.concat(F.rtrim(F.element_at(out, -1)), F.lit(" "), more)))
        return F.when(F.get(c, F.lit(0)).rlike(r"^[0-9]{1,3}\.$"), F.concat(out, F.array(F.concat(F.get(c, F.lit(0)), F.lit(" "), said(c, 2))))).when((more != "") & (F.size(out) > 0), grown).otherwise(out)

    listed = F.col("is_table") & (F.size(F.filter("lines", lambda x: x.rlike(r"^\s*\|\s*[0-9]{1,3}\.\s*\|"))) >= least)
    b = b.withColumn("lines", F.when(listed, F.concat(F.aggregate(rows, none, step), F.array(F.lit("")))).otherwise(F.col("lines")))
    g = b.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("block", "lines"))).alias("b"))
    return g.select(key, F.array_join(F.flatten(F.transform("b", lambda x: x["lines"])), "\n").alias(text))


def page_chars(records: DataFrame, json: str) -> DataFrame:
    """(key, page, chars) of each page of a record's list of pages; pages without numbers are skipped."""
    pages = F.from_json(json, "struct<pages: array<struct<page: string, chars: string>>>")["pages"]
    p = records.select("key", F.explode(pages).alias("p")).select("key", F.col("p.page").try_cast("int").alias("page"), F.col("p.chars").try_cast("long").alias("chars"))
    return p.where("page is not null and chars is not null")


def header_kind(c: Column) -> Column:
    """Whether a line heads an abstract, a panel about the article, or keywords; null for others."""
    c = F.trim(c)
    return F.when(c.rlike(r"(?i)^(?:a\s*b\s*s\s*t\s*r\s*a\s*c\s*t)\b") & (F.length(c) <= 30), "abstract").when(c.rlike(r"(?i)^(?:a\s*r\s*t\s*i\s*c\s*l\s*e\s+i\s*n\s*f\s*o)"), "article info").when(c.rlike(r"(?i)^key\s*words?\b"), "keywords")


def word_differences(a: Column, b: Column) -> Column:
    """Struct of the words that only one of two texts has, each once, sorted."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != ""))
    only = lambda x, y: F.array_sort(F.array_except(words(x), words(y)))
    return F.struct(only(a, b).alias("only_a"), only(b, a).alias("only_b"))


def report_lines(rows: DataFrame, *columns: str) -> DataFrame:
    """(line) per row: its columns as a row of a markdown table, fractions with two digits; for a text sink."""
    kinds = dict(rows.dtypes)
    show = lambda c: F.format_string("%.2f", F.col(c)) if kinds[c] == "double" else F.col(c).cast("string")
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(show(c), F.lit("")) for c in columns]), F.lit(" |")).alias("line"))
