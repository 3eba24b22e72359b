"""String functions as Column expressions: cleaning, keys, parsing of numbers and ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters replaced one to one, characters dropped, ligatures spelled out.
PUNCT_FROM = "‐‑‒–—−  ‘’“”"
PUNCT_TO = "------  ''\"\""
DROPPED = "​"
LIGATURES = (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"))


def let(c: Column, f) -> Column:
    """f of c, which is made once however often f reads it, also within lambdas."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def clean_soft_hyphens(c: Column) -> Column:
    return F.replace(text_or_empty(c), F.lit("­"), F.lit(""))


def expand_ligatures(c: Column) -> Column:
    for a, b in LIGATURES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def normalize_unicode_punct(c: Column) -> Column:
    return expand_ligatures(F.translate(text_or_empty(c), PUNCT_FROM + DROPPED, PUNCT_TO))


def collapse_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, "\n{3,}", "\n\n")


def strip_stray_br(c: Column) -> Column:
    return F.regexp_replace(c, r"(?m)[ \t]*<br\s*/?>[ \t]*$", "")


def dehyphenate(c: Column) -> Column:
    """Joins words broken over a line end; three passes, for words broken twice."""
    for _ in range(3):
        c = F.regexp_replace(c, "([A-Za-z]{2,})[­-]\n([a-z])", "$1$2")
    return c


def normalise_math_glyphs(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("◦"), F.lit("°")), F.lit("′′"), F.lit("″"))


def normalise(c: Column) -> Column:
    """Lower case, ligatures spelled out, other characters beyond ASCII as spaces, white space collapsed."""
    c = F.lower(expand_ligatures(text_or_empty(c)))
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^\x00-\x7f]", " "), r"\s+", " "))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(normalise(c), F.lit("[a-z0-9]+"), F.lit(0))


def title_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(text_or_empty(c), "[^a-zA-Z0-9 ]", " ")), r"\s+", " "))


def prefix_key(c: Column, n: int = 80) -> Column:
    return F.substring(F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9]", ""), 1, n)


def truncate(c: Column, n: int = 280) -> Column:
    c = F.trim(F.regexp_replace(text_or_empty(c), r"\s+", " "))
    return F.when(F.length(c) > n, F.concat(F.rtrim(F.substring(c, 1, n - 1)), F.lit("…"))).otherwise(c)


def parse_number(c: Column) -> Column:
    """A number in a label; one comma without a point is a decimal comma, other commas group thousands."""
    m = F.regexp_extract(F.regexp_replace(F.trim(text_or_empty(c)), "%", ""), r"^(-?\d[\d.,]*)$", 1)
    decimal = ~F.contains(m, F.lit(".")) & m.rlike(r"^[^,]*,[^,]*$")
    return F.when(m == "", None).otherwise(F.when(decimal, F.replace(m, F.lit(","), F.lit("."))).otherwise(F.replace(m, F.lit(","), F.lit(""))).try_cast("double"))


def expand_range(spec: Column, most: int = 50) -> Column:
    """The numbers of a list such as ``3-5, 7``, ascending and distinct; of a range that is too long, the first."""

    ends = F.regexp_replace(text_or_empty(spec), "([0-9]+)[A-Za-z]+", "$1")
    # the numbers of each part are found once, then read from their array
    ends = F.transform(F.split(ends, r"(?i)\s*(?:,|and|&)\s*"), lambda p: F.transform(F.regexp_extract_all(p, F.lit(r"(?i)(?:^\s*|\G(?<=\d)\s*(?:-|–|—|to)\s*)(\d+)"), F.lit(1)), lambda x: x.try_cast("int")))

    def span(q: Column) -> Column:
        a, b = F.get(q, F.lit(0)), F.coalesce(F.get(q, F.lit(1)), F.get(q, F.lit(0)))
        return F.when(a.isNull(), F.slice(q, 1, 0)).when(F.abs(b - a) > most, F.slice(q, 1, 1)).otherwise(F.sequence(F.least(a, b), F.greatest(a, b)))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(ends, span))))


def journal_like(c: Column) -> Column:
    """Whether a string looks like a journal, volume and page rather than a title."""
    c = text_or_empty(c)
    w = F.filter(F.split(c, r"\s+"), lambda x: x != "")
    short = (F.size(w) <= 3) & F.exists(w, lambda x: x.endswith(".") & (F.length(x) <= 6))
    return (c == "") | c.rlike(r"(?i)\b\d+\s*(?:\(\d+\))?\s*[,;]\s*[ep]?\d") | short


def next_ident(i: Column) -> Column:
    """0 as A, 25 as Z, 26 as AA."""
    return F.when(i < 26, F.char(65 + i)).otherwise(F.concat(F.char(64 + F.floor(i / 26)), F.char(65 + i % 26)))
