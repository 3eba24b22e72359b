"""Markdown as rows of blocks: a document's lines are numbered into runs of table rows and of other lines, each run is
one row with its lines in order, and what is done to tables is an expression over that array. Documents are put
together again by one aggregate on their key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Lines of journals' banners, footers and licences; matched from a line's start.
BOILERPLATE = (
    r"(?i)^\s*-?\s*\*?\s*Corresponding\s+author",
    r"(?i)^\s*-?\s*_?E-?mail\s+address(?:es)?:?_?\s+",
    r"^\s*_[A-Z]\.\s+[A-Z][A-Za-zÀ-ÿĀ-ž\-']+_\s*[\x{A8}\x{2D8}\x{2D9}\x{2DC}\x{B4}]?\s*$",
    r"(?i)^\s*https?://doi\.org/10\.\d",
    r"(?i)^\s*Received:?\s+\d{1,2}\s+[\p{L}\p{N}_]+\s+\d{4}",
    r"^\s*\d{4}-\d{4}/",
    r"^\s*©\s*\d{4}\s+(?:The\s+)?[Aa]uthors?",
    r"(?i)^\s*This\s+is\s+an\s+open\s+access\s+article",
    r"(?i)^\s*Available\s+online\s+\d",
    r"(?i)^\s*Published\s+by\s+(Copernicus|Elsevier|Wiley|Springer|MDPI|Frontiers)",
    r"(?i)^\s*wileyonlinelibrary\.com",
    r"(?i)^\s*www\.(?:mdpi|elsevier|sciencedirect)\.com",
    r"(?i)^\s*Vol\.?:?\s*\([\d:]+\)",
    r"^\s*_[A-Z][\p{L}\p{N}_\s&]+_\s+\*\*\d{4}\*\*\s*,\s*_\d",
    r"^\s*_[A-Z][\p{L}\p{N}_\s&\.]+_\s+\d{4};?\s*\d",
    r"^[A-Z][\p{L}\p{N}_\s&]{3,40}\s+\d+\s*\(\d{4}\)\s+\d",
    r"(?i)^\s*Academic\s+Editors?[:\s]",
    r"(?i)^\s*Guest\s+Editor[:\s]",
    r"(?i)^\s*Handled\s+by\b",
    r"(?i)^\s*\*?\*?Publisher['’]s\s+Note:?\*?\*?",
    r"(?i)^\s*\*?\*?Copyright:?\*?\*?\s*©",
    r"(?i)^\s*\*?\*?Citation:?\*?\*?\s+[A-Z]",
    r"(?i)^\s*\*?\*?Funding(?:\s+information)?:?\*?\*?\s+[A-Z]",
    r"(?i)^\s*This\s+article\s+is\s+an\s+open\s+access\s+article",
    r"(?i)^\s*Creative\s+Commons\s+Attribution\b",
    r"(?i)^\s*Received[:\s]+\d.*Accepted[:\s]+\d",
    r"(?i)^\s*Extended\s+author\s+information",
    r"(?i)^\s*Specialty\s+section:",
    r"(?i)^\s*These\s+authors\s+(?:contributed|have\s+contributed)",
    r"(?i)^\s*\*?Correspondence:?\*?\s+[A-Z]",
    r"(?i)^\s*\*\*\d+\*\*\s+Page\s+\d+\s+of\s+\d+\s*$",
    r"(?i)^\s*Page\s+\d+\s+of\s+\d+\s+\*\*\d+\*\*\s*$",
    r"(?i)^\s*Page\s+\d+\s+of\s+\d+\s*$",
    r"(?i)^\s*https?://www\.mdpi\.com/journal/",
    r"(?i)^\s*https?://onlinelibrary\.wiley\.com/",
)
# Words of title blocks that were taken for tables.
BANNER = ("doi:", "received:", "accepted:", "published:", "https://", "http://", "copyright", "creative commons", "issn", "journal of", "@", "elsevier", "wiley", "springer", "frontiers", "mdpi", "correspondence")
SEPARATOR = "^(-{2,}|:?-+:?)$"
# How the first lines of blocks begin that are no paragraphs.
NO_PARAGRAPH = r"^(!\[|\||\*— Page |#{1,3} |\*\*Fig|\*\*Table|---)"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def text_lines(c: Column) -> Column:
    return F.split(F.coalesce(c, F.lit("")), "\n", -1)


def strip_boilerplate(c: Column) -> Column:
    def kept(line: Column) -> Column:
        hit = F.lit(False)
        for p in BOILERPLATE:
            hit = hit | line.rlike(p)
        return ~hit

    return F.array_join(F.filter(text_lines(c), kept), "\n")


def paragraphs(c: Column) -> Column:
    """Blocks between blank lines, without tables, figures, page marks, headings and lists."""
    blocks = F.transform(F.split(F.coalesce(c, F.lit("")), r"\n\s*\n", -1), strip)
    listed = lambda b: F.forall(F.filter(F.split(b, "\n"), lambda x: ~x.rlike(r"^\s*$")), lambda x: x.rlike(r"^[#*\->|]"))
    return F.filter(blocks, lambda b: (b != "") & ~b.rlike(NO_PARAGRAPH) & ~listed(b))


def split_references(c: Column) -> tuple[Column, Column]:
    """(body, reference section): apart at the first heading of references, which the section keeps."""
    cut = r"(?is)^(.*?)(?:(?<=\n)|(?<![\s\S]))(#{1,4}\s*\**\s*(?:references?|bibliography|literature\s+cited|works\s+cited)\s*\**\s*(?:\n.*)?)$"
    section = F.regexp_extract(c, cut, 2)
    return F.substring(c, F.lit(1), F.length(c) - F.length(section)), section


def cells(line: Column) -> Column:
    return F.transform(F.split(F.regexp_extract(strip(line), r"(?s)^\|(.*?)\|?$", 1), r"\|", -1), strip)


def is_separator(row: Column) -> Column:
    some = F.filter(row, lambda c: c != "")
    return (F.size(some) > 0) & F.forall(some, lambda c: c.rlike(SEPARATOR))


def format_row(row: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.transform(row, lambda c: F.replace(F.replace(c, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))), " | "), F.lit(" |"))


def blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, block, is_table, lines): maximal runs of lines that begin with a pipe, and the runs between; blocks count from 1."""
    rows = docs.select(key, F.posexplode(text_lines(F.col(text))).alias("pos", "line")).withColumn("is_table", F.col("line").rlike(r"^\s*\|"))
    w = Window.partitionBy(key).orderBy("pos")
    turn = F.when(F.col("is_table") != F.coalesce(F.lag("is_table").over(w), ~F.col("is_table")), 1).otherwise(0)
    rows = rows.withColumn("turn", turn).withColumn("block", F.sum("turn").over(w))
    run = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return rows.groupBy(key, "block").agg(F.first("is_table").alias("is_table"), F.transform(run, lambda x: x["line"]).alias("lines"))


def together(parts: DataFrame, key: str, keep: Column | None = None) -> DataFrame:
    """(key, text): the blocks to keep, joined in order; empty for documents of which none is kept."""
    part = F.struct("block", "lines")
    kept = F.array_sort(F.collect_list(part if keep is None else F.when(keep, part)))
    return parts.groupBy(key).agg(F.array_join(F.flatten(F.transform(kept, lambda x: x["lines"])), "\n").alias("text"))


def junk_tables(parts: DataFrame) -> DataFrame:
    """parts with junk: whether a run of table rows is a title block, prose or empty rather than a table.

    What later columns read more than once is a column of its own, so that it is made once a row."""
    filled = lambda r: F.exists(r, lambda c: (c != "") & ~c.rlike(SEPARATOR))
    p = parts.withColumn("_data", F.when(F.col("is_table"), F.filter(F.transform("lines", cells), filled)))
    p = p.withColumn("_full", F.filter(F.flatten("_data"), lambda c: c != ""))
    p = p.withColumns({"_body": F.lower(F.array_join("_full", " ")), "_sizes": F.transform("_full", F.length)})
    p = p.withColumn("_total", F.aggregate("_sizes", F.lit(0), lambda a, x: a + x))
    hits = F.lit(0)
    for w in BANNER:
        hits = hits + F.contains("_body", F.lit(w)).cast("int")
    narrow = F.array_max(F.transform("_data", F.size)) < 2
    wide = (F.col("_total") > 250 * F.size("_full")) | (F.array_max("_sizes") > 0.8 * F.col("_total"))
    junk = F.coalesce((F.size("lines") < 2) | (F.size("_data") == 0) | narrow | (hits >= 2) | wide, F.lit(True))
    return p.withColumn("junk", F.col("is_table") & junk).drop("_data", "_full", "_body", "_sizes", "_total")


def remove_junk_tables(docs: DataFrame, key: str, text: str) -> DataFrame:
    return together(junk_tables(blocks(docs, key, text)), key, ~F.col("junk"))


def reshape_breaks(parts: DataFrame) -> DataFrame:
    """parts whose tables with <br> in cells have one row per part of a cell; short rows are padded. Without a separator
    row the first row gives way to an empty header."""
    broken = F.col("is_table") & (F.size("lines") > 1) & F.exists("lines", lambda x: F.contains(x, F.lit("<br")))
    p = parts.withColumn("_rows", F.when(broken, F.transform("lines", cells)))
    p = p.withColumns({"_wide": F.array_max(F.transform("_rows", F.size)), "_seps": F.transform("_rows", is_separator)})
    p = p.withColumn("_at", F.when(F.array_contains("_seps", True), F.array_position("_seps", F.lit(True))).otherwise(F.lit(1)).cast("int"))
    split = lambda c: F.transform(F.split(c, r"(?i)<br\s*/?>", -1), strip)
    padded = F.transform("_rows", lambda r: F.transform(F.concat(r, F.array_repeat(F.lit(""), F.col("_wide") - F.size(r))), split))
    p = p.withColumn("_parts", padded)

    def expand(row: Column) -> Column:
        level = lambda k: F.transform(row, lambda c: F.coalesce(F.get(c, k), F.lit("")))
        return F.transform(F.sequence(F.lit(0), F.array_max(F.transform(row, F.size)) - 1), level)

    formatted = lambda rows: F.transform(F.flatten(F.transform(rows, expand)), format_row)
    blank = F.array(format_row(F.array_repeat(F.lit(""), F.col("_wide"))))
    head = F.when(F.col("_at") > 1, formatted(F.slice("_parts", F.lit(1), F.col("_at") - 1))).otherwise(blank)
    body = formatted(F.slice("_parts", F.col("_at") + 1, F.size("_parts")))
    rule = F.array(format_row(F.array_repeat(F.lit("---"), F.col("_wide"))))
    lines = F.when(F.col("_rows").isNull(), F.col("lines")).otherwise(F.concat(head, rule, body))
    return p.withColumn("lines", lines).drop("_rows", "_wide", "_seps", "_at", "_parts")


def reshape_break_tables(docs: DataFrame, key: str, text: str) -> DataFrame:
    return together(reshape_breaks(blocks(docs, key, text)), key)


def valid_table(c: Column) -> Column:
    """The first run of table rows, trimmed, if it has three rows or more, a separator, and rows of nearly one width; else null."""
    run = F.regexp_extract(F.coalesce(c, F.lit("")), r"(?:^|\n)((?:[ \t]*\|[^\n]*\|[ \t]*(?:\n|$))+)", 1)
    rows = F.filter(F.transform(F.split(run, "\n"), strip), lambda x: x != "")
    pipes = F.transform(rows, lambda x: F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))))
    good = (F.size(rows) >= 3) & F.exists(rows, lambda x: x.rlike(r"^\|[ :\-|]*-[ :\-|]*\|$")) & (F.array_max(pipes) - F.array_min(pipes) <= 1)
    return F.when(good, F.array_join(rows, "\n"))


def drop_running_lines(pages: DataFrame) -> DataFrame:
    """pages (doc, page, text) without running heads and feet, page numbers and volume banners; documents of fewer than
    four pages stay as they are. Lines and 60-character stems are counted per document before anything is joined."""
    n = pages.groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
    rows = pages.select("doc", "page", F.posexplode(text_lines(F.col("text"))).alias("pos", "line")).withColumn("s", strip(F.col("line")))
    rows = rows.withColumn("stem", F.substring("s", 1, 60))
    most = F.greatest(F.lit(3), F.floor(F.col("n") * 0.3))
    size = F.length("s")
    # one row per page and line, so both counts come from one shuffle of distinct lines
    by_page = rows.where(size.between(2, 200)).groupBy("doc", "s", "page").agg(F.count(F.lit(1)).alias("times"))
    by_line = by_page.groupBy("doc", "s").agg(F.count(F.lit(1)).alias("on"), F.sum("times").alias("times"))
    whole = by_line.join(n, "doc").where(F.col("on") >= most).select("doc", "s", F.lit(True).alias("whole"))
    stems = by_line.where(F.length("s") >= 30).groupBy("doc", F.substring("s", 1, 60).alias("stem")).agg(F.sum("times").alias("times"))
    stems = stems.join(n, "doc").where(F.col("times") >= most).select("doc", "stem", F.lit(True).alias("begun"))
    out = rows.join(whole, ["doc", "s"], "left").join(stems, ["doc", "stem"], "left").join(n, "doc")
    numbered = F.col("s").rlike(r"^[|\s]*(\d+\s*(of|/)\s*\d+|\d+)\s*[|\s]*$") | F.col("s").rlike(r"^(Vol\.?:?\(?\d+\)?|\d+\s+\d+\s*$)")
    drop = (F.col("n") >= 4) & (F.coalesce("whole", F.lit(False)) | numbered | ((size >= 30) & F.coalesce("begun", F.lit(False))))
    kept = F.array_sort(F.collect_list(F.when(~drop, F.struct("pos", "line"))))
    return out.groupBy("doc", "page").agg(F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("text"))
