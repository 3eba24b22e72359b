"""Decisions as expressions: which figures, references, tables and paragraphs are worth a costly second look."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _row(decision: str, cost: float) -> Column:
    return F.struct(F.lit(decision).alias("decision"), F.lit(cost).alias("cost"))


def for_table(has_rows: Column, confidence: Column) -> Column:
    return F.when(~F.coalesce(has_rows, F.lit(False)), _row("extract", 60.0)).when(confidence >= 0.85, _row("skip", 0.0)).when(confidence >= 0.55, _row("validate", 40.0)).otherwise(_row("replace", 80.0))


def for_paragraph(text: Column) -> Column:
    """By the share of characters that look like residue: soft hyphens, ligatures, runs of marks, stray letters."""
    count = lambda c: F.length(text) - F.length(F.translate(text, c, ""))
    bad = 3 * count("­") + count("ﬀﬁﬂﬃﬄ")
    bad = bad + F.regexp_count(text, F.lit("(?U)[^\\w\\s.,;:?!()\\-—\"'/°%$]{3,}")) + F.regexp_count(text, F.lit(r"(?U)\b(?![aAI]\b)[a-zA-Z]\b"))
    share = bad / F.greatest(F.lit(1), F.length(text))
    return F.when(text.isNull() | (F.length(text) < 20), _row("skip", 0.0)).when(share > 0.04, _row("replace", 30.0)).when(share > 0.015, _row("validate", 20.0)).otherwise(_row("skip", 0.0))


def for_reference(raw: Column, verdict: Column) -> Column:
    letters = F.length(F.regexp_replace(raw, r"[^\p{L}]", "")) / F.greatest(F.lit(1), F.length(raw))
    return F.when(F.coalesce(raw, F.lit("")) == "", _row("skip", 0.0)).when(verdict == "verified", _row("skip", 0.0)).when(verdict == "mismatch", _row("replace", 20.0)).when((verdict == "not_found") & (F.length(raw) < 30), _row("extract", 20.0)).when(letters < 0.55, _row("extract", 20.0)).otherwise(_row("skip", 0.0))


def rotation(flag: Column, osd: Column, confidence: Column, least: float = 1.5) -> Column:
    """The rotation that sets a page upright, or null where none is called for."""
    return F.when((flag == 0) & (osd != 0) & (confidence >= least), F.pmod(-osd, F.lit(360)))


def pct(n: Column, of: Column) -> Column:
    return F.when(F.coalesce(of, F.lit(0)) != 0, F.round(100.0 * n / of, 1)).otherwise(0.0)
