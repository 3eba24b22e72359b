"""Papers as a whole: confidence, issues, captions by number, names resolved by n-grams, diagrams checked, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The syntax of diagrams that is read.
FENCE = r"(?is)```\s*mermaid\s*\n(.*?)```"
BARE_GRAPH = r"(?im)^\s*(flowchart|graph)\s+(TD|TB|BT|LR|RL)\b"
GRAPH = r"(?im)^\s*(graph|flowchart)\s+(TD|TB|BT|LR|RL)\s*$"
NODE = r"\b([A-Za-z][A-Za-z0-9_]*)\s*\[([^\]]+)\]"
EDGE = r"\b([A-Za-z][A-Za-z0-9_]*)\s*(?:\[[^\]]*\])?\s*-->\s*(?:\|([^|]*)\|)?\s*([A-Za-z][A-Za-z0-9_]*)"


def confidence(structure: Column, coverage: Column) -> Column:
    """By how much of a paper's structure was found (0 to 5), then by how much of its text."""
    return F.when((structure >= 4) & coverage.between(0.6, 1.3), "high").when(structure >= 2, "medium").otherwise("low")


def paper_stats(papers: DataFrame) -> DataFrame:
    """papers with coverage, structure and confidence, from md_words, raw_words and what was found of title, doi,
    n_references, n_figures, n_authors."""
    found = [F.coalesce(F.length("title") > 0, F.lit(False)), F.coalesce(F.length("doi") > 0, F.lit(False)), *[F.coalesce(F.col(c) > 0, F.lit(False)) for c in ("n_references", "n_figures", "n_authors")]]
    structure = sum((x.cast("int") for x in found[1:]), found[0].cast("int"))
    out = papers.withColumns({"coverage": F.round(F.col("md_words") / F.greatest("raw_words", F.lit(1)), 3), "structure": structure})
    return out.withColumn("confidence", confidence(F.col("structure"), F.col("coverage")))


def issues(has_text: Column, coverage: Column, pages: Column, figures: Column, captioned: Column, references: Column) -> Column:
    """What is wrong with a paper, in a fixed order."""
    return F.array_compact(
        F.array(
            F.when(~has_text, "missing paper.md"),
            F.when((coverage > 0) & (coverage < 0.85), F.format_string("low coverage %.2f", coverage)),
            F.when((figures == 0) & (pages > 2), "no figures detected"),
            F.when(captioned < figures, F.concat((figures - captioned).cast("string"), F.lit(" fig(s) w/o caption"))),
            F.when((references == 0) & (pages > 2), "no references parsed"),
        )
    )


def captions_by_number(captions: DataFrame) -> DataFrame:
    """(doc, number, text): captions (doc, ord, number, text) without their heads, joined where several have a number;
    those with compound numbers stand under the whole number too."""
    body = F.regexp_replace("text", r"(?i)^\s*(?:Figure|Fig\.?)\s+\d+[A-Za-z]?\s*[.:\-—)]?\s*", "")
    c = captions.withColumn("text", F.trim(F.regexp_replace(body, r"\s+", " "))).where("text <> ''").withColumn("number", F.trim("number"))
    keys = F.array_compact(F.array_distinct(F.array("number", F.nullif(F.regexp_extract("number", r"^(\d+)", 1), F.lit("")))))
    c = c.select("doc", "ord", F.explode(keys).alias("number"), "text")
    every = F.array_sort(F.collect_list(F.struct("ord", "text")))
    return c.groupBy("doc", "number").agg(F.array_join(F.transform(every, lambda x: x["text"]), " / ").alias("text"))


def grams(c: Column, n: int = 4) -> Column:
    c = F.lower(c)
    return F.when(F.length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: c.substr(i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def resolve_names(slugs: DataFrame, files: DataFrame, least: int = 4) -> DataFrame:
    """(slug, file, overlap): the file whose name shares most 4-grams with each slug, four at least; the lesser name of
    equals. Both are names of the corpus's papers, which are few beside their text; pairs are counted by gram."""
    s, f = slugs.select("slug", F.explode(grams(F.col("slug"))).alias("g")), files.select("file", F.explode(grams(F.col("file"))).alias("g"))
    n = s.join(f, "g").groupBy("slug", "file").agg(F.count(F.lit(1)).alias("overlap")).where(F.col("overlap") >= least)
    best = n.groupBy("slug").agg(F.min(F.struct((-F.col("overlap")).alias("k"), "file")).alias("b"))
    return slugs.select("slug").distinct().join(best, "slug", "left").select("slug", F.col("b.file").alias("file"), (-F.col("b.k")).alias("overlap"))


def diagram_verdict(rows: DataFrame, text: str) -> DataFrame:
    """rows with nodes, edges and verdict of the diagram in a model's answer: ok, or what it lacks. More than half of the
    endpoints of arrows must be nodes that are defined, or exactly half."""
    fenced = F.regexp_extract(text, FENCE, 1)
    src = F.when(F.col(text).rlike(FENCE), F.trim(fenced)).when(F.col(text).rlike(BARE_GRAPH), F.trim(text))
    r = rows.withColumn("_src", src)
    r = r.withColumns({"_ids": F.array_distinct(F.regexp_extract_all("_src", F.lit(NODE), F.lit(1))), "_from": F.regexp_extract_all("_src", F.lit(EDGE), F.lit(1)), "_to": F.regexp_extract_all("_src", F.lit(EDGE), F.lit(3))})
    ends = F.array_union("_from", "_to")
    verdict = F.when(F.col("_src").isNull(), "no diagram").when(~F.col("_src").rlike(GRAPH), "no header").when(F.size("_ids") == 0, "no nodes").when(F.size("_from") == 0, "no edges")
    verdict = verdict.when(2 * F.size(F.array_except(ends, F.col("_ids"))) > F.size(ends), "undefined nodes").otherwise("ok")
    count = lambda c: F.coalesce(F.when(F.col("_src").isNotNull(), F.size(c)), F.lit(0))
    return r.withColumns({"nodes": count("_ids"), "edges": count("_from"), "verdict": verdict}).drop("_src", "_ids", "_from", "_to")


def distillation(rows: DataFrame, *by: str) -> DataFrame:
    """Counts by source of answers (source, seconds) and the share of them for which the costly model was not called."""
    n = lambda s: F.count_if(F.col("source") == s)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_total"),
        n("student").alias("student"),
        n("teacher").alias("teacher"),
        n("caption_only").alias("caption_only"),
        F.count_if(~F.coalesce(F.col("source").isin("student", "teacher", "caption_only"), F.lit(False))).alias("empty"),
        F.coalesce(F.sum(F.when(F.col("source") == "teacher", F.col("seconds"))), F.lit(0)).alias("teacher_seconds"),
        F.round(100 * n("student") / F.count(F.lit(1)), 1).alias("saved_pct"),
    )


def front_page(title: Column, authors: Column, year: Column, journal: Column, doi: Column, abstract: Column, body: Column) -> Column:
    """A paper as markdown: title, authors, a line of what is known of its publication, abstract, body."""
    some = lambda c: F.when(F.length(c) > 0, c)
    about = F.concat_ws(" · ", some(year.cast("string")), some(journal), F.when(F.length(doi) > 0, F.concat(F.lit("DOI: "), doi)))
    return F.concat_ws(
        "\n\n",
        F.when(F.length(title) > 0, F.concat(F.lit("# "), title)),
        F.when(F.size(authors) > 0, F.concat(F.lit("*"), F.array_join(authors, ", "), F.lit("*"))),
        some(about),
        F.when(F.length(abstract) > 0, F.concat(F.lit("## Abstract\n\n"), abstract)),
        some(body),
    )


def collect_papers(stats: DataFrame, papers: DataFrame) -> DataFrame:
    """(slug, n_pages, title): papers of which either record is there, the first record's values before the second's;
    names that begin with an underscore are left out."""
    out = stats.alias("s").join(papers.alias("p"), "slug", "full").where(~F.col("slug").startswith("_"))
    pick = lambda c, none: F.coalesce(F.nullif(F.col(f"s.{c}"), F.lit(none)), F.col(f"p.{c}"), F.lit(none))
    return out.select("slug", pick("n_pages", 0).alias("n_pages"), pick("title", "").alias("title"))
