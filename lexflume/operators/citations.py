"""Citations of all styles, links to references, the list of references as markdown, images and names of files."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexflume.functions.text import clean_soft_hyphens, collapse_blank_lines
from lexflume.operators.linking import link_citations
from lexflume.operators.markdown import reshape_break_tables
from lexflume.operators.references import SURNAME

# A name with its particles, and citations in brackets, in prose, and by numbers.
NAME = rf"(?:(?:de|van|van\s+der|von|del|della|du|le|la|el|al-|el-)\s+)?{SURNAME}"
ONE = rf"{NAME}(?:\s+(?:et\s+al\.?|and\s+{NAME}|&\s+{NAME}))?,?\s+[0-9]{{4}}[a-z]?(?:\[[0-9]+\])?(?:,\s*[0-9]{{4}}[a-z]?(?:\[[0-9]+\])?)*"
INLINE = rf"\(({ONE}(?:\s*;\s*{ONE})*)\s*\)"
PROSE = rf"({NAME}(?:\s+(?:et\s+al\.?|and\s+{NAME}|&\s+{NAME}))?\s+\([0-9]{{4}}[a-z]?\))"
NUMBERS = r"([0-9]+(?:\s*[-–]\s*[0-9]+)?(?:\s*,\s*[0-9]+(?:\s*[-–]\s*[0-9]+)?)*)"
BRACKETS = rf"(?:^|[\s(,;])\[{NUMBERS}\]"
PARENTHESES = r"\(([0-9]{1,3}(?:\s*[-–]\s*[0-9]{1,3})?(?:\s*,\s*[0-9]{1,3}(?:\s*[-–]\s*[0-9]{1,3})?)*)\)"
STYLES = {"inline": INLINE, "prose": PROSE, "bracket": BRACKETS, "paren": PARENTHESES}
#: Letters with accents and the letters that they are without.
_BARE = {chr(c): n for c in range(0xC0, 0x250) if len(n := unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()) == 1}


def citations(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, style, pos, cite): what a document cites in each style, in order."""

    def of(style: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x, i: F.struct(F.lit(style).alias("style"), i.alias("pos"), x.alias("cite")))

    found = [of(*sp) for sp in STYLES.items()]
    return docs.select("doc", F.explode(F.concat(*found)).alias("c")).select("doc", "c.*")


def numbers_of(spec: Column, most: int = 50) -> Column:
    """The numbers of a citation like 12-15, 17; spans that are too long or turned around give none."""
    part = lambda x, k: F.regexp_extract(x, r"([0-9]+)\s*[-–]\s*([0-9]+)", k).try_cast("int")
    span = lambda x: F.when((part(x, 2) - part(x, 1)).between(1, most - 1), F.sequence(part(x, 1), part(x, 2))).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(F.split(spec, r"\s*,\s*"), lambda x: F.when(x.rlike(r"^[0-9]+\s*[-–]"), span(x)).otherwise(F.array_compact(F.array(F.trim(x).try_cast("int"))))))


def link_prose(cites: DataFrame, refs: DataFrame) -> DataFrame:
    """cites (doc, pos, cite) of prose with surname, year, ref_no and linked: the citation, as a link where it has a reference."""
    year = F.regexp_extract("cite", r"\(([0-9]{4})[a-z]?\)$", 1).try_cast("int")
    c = cites.withColumns({"surname": F.regexp_extract("cite", f"({SURNAME})", 1), "year": year.cast("long")})
    r = link_citations(c, refs)
    link = F.concat(F.lit("["), "cite", F.lit("](#ref-"), F.lpad(F.col("ref_no").cast("string"), 3, "0"), F.lit(")"))
    return r.withColumn("linked", F.coalesce(link, "cite"))


def references_section(refs: DataFrame) -> DataFrame:
    """(doc, md) from refs (doc, ref_no, text, doi, marker): a list with anchors, a link where the text has none, and each
    marker of a page before the first reference that it precedes. A document's references are one row."""
    first = F.row_number().over(Window.partitionBy("doc", "marker").orderBy("ref_no")) == 1
    link = F.when((F.length("doi") > 0) & ~F.contains("text", F.lit("doi.org")), F.concat(F.lit(" [doi:"), "doi", F.lit("](https://doi.org/"), "doi", F.lit(")")))
    line = F.concat(F.lit('- <a id="ref-'), F.lpad(F.col("ref_no").cast("string"), 3, "0"), F.lit('"></a>'), "text", F.coalesce(link, F.lit("")))
    mark = F.when(F.col("marker").isNotNull() & first, F.concat(F.lit("\n"), "marker", F.lit("\n\n"))).otherwise("")
    r = refs.withColumn("_l", F.concat(mark, line)).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("ref_no", "_l"))).alias("x"))
    return r.select("doc", F.concat(F.lit("\n\n---\n\n## References\n\n"), F.array_join(F.transform("x", lambda e: e["_l"]), "\n"), F.lit("\n")).alias("md"))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def figures_of_paths(paths: DataFrame, figures: DataFrame) -> DataFrame:
    """paths (doc, path) with fig: the document's first figure (doc, fig, file) whose file has that name."""
    f = figures.groupBy("doc", base_name(F.col("file")).alias("_b")).agg(F.min("fig").alias("fig"))
    return paths.withColumn("_b", base_name(F.col("path"))).join(f, ["doc", "_b"], "left").select("doc", "path", "fig")


def remapped_images(md: Column, names: Column) -> Column:
    """Images without text put under the names of a map, as ``path`` or ``path|alt``; those that it has not are dropped."""
    parts = F.regexp_extract_all(md, F.lit(r"!\[\]\([^)]+\)|[^!]+|!"), F.lit(0))

    def put(p: Column) -> Column:
        new = F.element_at(names, F.regexp_extract(p, r"([^/(]*)\)$", 1))
        image = F.when(F.contains(new, F.lit("|")), F.concat(F.lit("!["), F.substring_index(F.regexp_replace(new, r"^[^|]*\|", ""), "\x00", 1), F.lit("](./"), F.substring_index(new, "|", 1), F.lit(")"))).otherwise(F.concat(F.lit("![](./"), new, F.lit(")")))
        return F.when(F.startswith(p, F.lit("![](")), F.coalesce(image, F.lit(""))).otherwise(p)

    return F.array_join(F.transform(parts, put), "")


def slug(c: Column, most: int = 60) -> Column:
    """A name for files: letters without accents, digits, and single dashes."""
    c = F.regexp_replace(F.translate(c, "".join(_BARE), "".join(_BARE.values())), r"[^\x00-\x7f]", "")
    c = F.lower(F.regexp_replace(F.regexp_replace(c, r"[^\w\s-]", ""), r"^\s+|\s+$", ""))
    c = F.regexp_replace(F.substring(F.regexp_replace(c, r"[\s_-]+", "-"), 1, most), "-+$", "")
    return F.when(c == "", "paper").otherwise(c)


def postprocessed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text): soft hyphens out, tables with breaks reshaped, blank lines collapsed, in that order."""
    d = reshape_break_tables(docs.select(key, clean_soft_hyphens(F.col(text)).alias(text)), key, text)
    return d.select(key, collapse_blank_lines(F.col(text)).alias(text))
