"""Expressions that mend extracted text, read model answers and LaTeX, and tell titles from banners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Environments of LaTeX that hold no prose, commands that leave nothing behind.
NOISY = ("equation", "equation*", "align", "align*", "eqnarray", "eqnarray*", "gather", "gather*", "split", "multline", "multline*", "math", "displaymath", "figure", "figure*", "table", "table*", "thebibliography", "verbatim", "lstlisting", "minted", "tikzpicture", "pgfpicture")
EMPTY_COMMANDS = ("cite", "citep", "citet", "ref", "eqref", "label", "footnote", "url", "href", "includegraphics", "bibliography", "bibliographystyle")
# What banners of journals hold, and headings that are no titles.
BANNER = r"(?i)(received:|accepted:|published:|^doi:|copyright|contents lists|open access|journal homepage|sciencedirect|elsevier|wiley|springer|frontiers|mdpi|cite this|article number|how to cite|available\s+online|peer\s*review|\b\d{4}-\d{4}\b|\bvol\.?\s*\d|issue\s+\d|\d+\s*\(\d+\):)"
GENERIC = r"(?i)^(article|original research|review article|research article|practice and policy|opinion|short communication|editorial|perspective|brief report|letter|funding\s+information|correspondence|abstract|resumen|keywords?|acknowledgments?|conflicts?\s+of\s+interest|author\s+contributions?|data\s+availability|appendix|received|accepted|published|conclusion|conclusions|introduction|methods?|results?|discussion|open access|original article|table of contents)$"
# Prompts that models repeat.
ECHOES = (r"(?i)\bcolumns?\s*[`:]+\s*Category\s*[`,]", r"(?i)\bValue\s*\(units\)", r"(?i)\bMERMAID_UNAVAILABLE\b", r"(?i)\bTABLE_UNAVAILABLE\b", r"(?i)\bLATEX_UNAVAILABLE\b", r"(?i)\bin one short sentence\b", r"(?i)\breproduce them as a markdown table\b", r"(?i)\bdo not invent\b")
# Where a paper's front matter ends.
BODY = (r"(?i)^#{1,3}\s*\**\s*(abstract|resumen)\b", r"(?i)^#{1,3}\s*\**\s*(introduction|background|overview|1\s*\.)\b", r"(?i)^#{1,3}\s*\**\s*\d+\s*\.\s*\**\s*[A-Z][a-z]+", r"(?i)^#{1,3}\s*\**\s*1\b")


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def rejoin_ligatures(c: Column) -> Column:
    """Words that a lost ligature broke, as in ``E ff ect`` and ``fl ow``; five passes, for words broken more than once."""
    for _ in range(5):
        c = F.regexp_replace(c, r"(?<![a-zA-Z])([a-zA-Z])\s+(ff|fi|fl|ffi|ffl)\s+([a-z][a-zA-Z]*)", "$1$2$3")
        c = F.regexp_replace(c, r"(?<![a-zA-Z])(ff|fi|fl|ffi|ffl)\s+([a-z][a-zA-Z]*)", "$1$2")
    return c


def mend_spacing(c: Column) -> Column:
    """Hyphens, marks, gaps and years whose spaces extraction lost or made."""
    for pattern, put in (
        (r"([\p{L}\p{N}_])-\s+([\p{L}\p{N}_])", "$1-$2"),
        (r"\s+([,.;:])", "$1"),
        (" {3,}", "  "),
        (r"(\b(?:19|20)\d{2})([a-z]{2,})", "$1 $2"),
        (r"([A-Za-z.]),((?:19|20)\d{2})", "$1, $2"),
        (r"\[[◦°]\]", "°"),
    ):
        c = F.regexp_replace(c, pattern, put)
    return c


def image_alt(c: Column, n: int = 200) -> Column:
    s = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[*_`]+", ""), r"\s+", " "))
    s = F.translate(s, "[]", "()")
    return F.when(F.length(s) > n, F.concat(F.rtrim(F.substring(s, 1, n - 1)), F.lit("…"))).otherwise(s)


def code_block(c: Column) -> Column:
    """The body of the first fenced block, or null."""
    fence = r"(?s)```[a-zA-Z]*\s*\n(.*?)```"
    return F.when(c.rlike(fence), _strip(F.regexp_extract(c, fence, 1)))


def is_echo(c: Column) -> Column:
    hit = F.lit(False)
    for p in ECHOES:
        hit = hit | c.rlike(p)
    return F.coalesce(hit, F.lit(False))


def strip_front_matter(c: Column, within: int = 4500) -> Column:
    """A body from its first heading of an abstract, introduction or numbered section, if that begins near enough."""
    marks = "|".join(p.removeprefix("(?i)^") for p in BODY)
    cut = F.regexp_extract(c, rf"(?is)^(.*?)(?:(?<=\n)|(?<![\s\S]))(?:{marks})", 1)
    found = c.rlike(rf"(?im)^(?:{marks})") & (F.length(cut) <= within)
    return F.when(found, F.substring(c, F.length(cut) + 1, F.length(c))).otherwise(c)


def is_good_title(c: Column) -> Column:
    t = _strip(c)
    tokens = F.filter(F.split(t, r"\s+"), lambda x: x != "")
    spaced = (F.size(tokens) >= 4) & F.forall(tokens, lambda x: F.length(x) <= 2)
    norm = F.lower(F.when(spaced, F.array_join(tokens, "")).otherwise(F.regexp_replace(t, r"\s+", " ")))
    long = F.size(F.filter(tokens, lambda x: F.length(x) > 2)) >= 4
    return F.coalesce(F.length(t).between(30, 400) & ~t.rlike(BANNER) & ~t.rlike(GENERIC) & ~norm.rlike(GENERIC) & long, F.lit(False))


def strip_latex(c: Column) -> Column:
    """The prose of a LaTeX document: no comments, preamble, formulas, figures, references; other commands give what is
    in their braces, eight deep."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?m)(?<!\\)%[^\n]*$", "")
    c = F.regexp_replace(F.regexp_replace(c, r"(?s)^.*?\\begin\{document\}", ""), r"(?s)\\end\{document\}.*$", "")
    for env in NOISY:
        e = env.replace("*", r"\*")
        c = F.regexp_replace(c, rf"(?s)\\begin\{{{e}\}}.*?\\end\{{{e}\}}", " ")
    for p in (r"(?s)\$\$.*?\$\$", r"(?<!\\)\$(?:[^$\\]|\\.)*\$", r"(?s)\\\(.*?\\\)", r"(?s)\\\[.*?\\\]"):
        c = F.regexp_replace(c, p, " ")
    for _ in range(8):
        c = F.regexp_replace(c, r"\\(?:" + "|".join(EMPTY_COMMANDS) + r")(?![a-zA-Z@])\s*\*?\s*(?:\[[^\]]*\])?\s*\{[^{}]*\}", " ")
        c = F.regexp_replace(c, r"\\[a-zA-Z@]+\s*\*?\s*(?:\[[^\]]*\])?\s*\{([^{}]*)\}", "$1")
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\\[a-zA-Z@]+\*?", " "), r"[{}]", " "), r"\s+", " "))
