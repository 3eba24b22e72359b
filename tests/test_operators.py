"""Literal cases of operators over markdown, references and text, the empty and the null ones among them."""

import pytest
from pyspark.sql import functions as F

from lexflume.functions import cleaning as C
from lexflume.operators import layout as L
from lexflume.operators import markdown as M
from lexflume.operators import references as R


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()[0]


@pytest.mark.parametrize(("f", "arg", "want"), [
    (M.strip_boilerplate, "Page 3 of 17\ntext\n© 2020 The Authors", "text"),
    (M.paragraphs, "## H\n\none\ntwo\n\n| a |\n\n- x\n- y", ["one\ntwo"]),
    (M.paragraphs, None, []),
    (M.cells, "| a | b|", ["a", "b"]),
    (M.valid_table, "x\n| a | b |\n|---|---|\n| 1 | 2 |\ny", "| a | b |\n|---|---|\n| 1 | 2 |"),
    (M.valid_table, "| a |", None),
    (C.rejoin_ligatures, "E ff ect of the fl ow and e ffi cient", "Effect of the flow and efficient"),
    (C.mend_spacing, "well- known , 2019for al.,2015", "well-known, 2019 for al., 2015"),
    (C.image_alt, "*A* [b]", "A (b)"),
    (C.code_block, "x\n```py\n1\n```", "1"),
    (C.code_block, "none", None),
    (C.strip_front_matter, "Journal\n# Introduction\nBody", "# Introduction\nBody"),
    (C.strip_latex, "\\begin{document}\\textbf{\\emph{a}} $x$ \\cite{k} b\\end{document}", "a b"),
    (R.numbers, "12-15, 17", [12, 13, 14, 15, 17]),
    (R.numbers, "5-3", []),
])
def test_functions(spark, f, arg, want):
    assert one(spark, f(F.lit(arg).cast("string"))) == want


def test_reference_section(spark):
    body, refs = M.split_references(F.lit("a\n## References\n- x"))
    assert (one(spark, body), one(spark, refs)) == ("a\n", "## References\n- x")


def test_references_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "# References")], "doc long, md string")
    assert R.parse_references(docs, "doc", "md").count() == 0


def test_numbered_references_keep_their_numbers(spark):
    md = "# References\n1. Smith, J. (2019). A title of a paper.\n3. Brown, K. 2020b. Another title here.\n3. Twice, T. (2021). Left out here."
    got = R.parse_references(spark.createDataFrame([(1, md)], "doc long, md string"), "doc", "md").collect()
    assert [(r.strategy, r.ref_no, r.year, r.first_author) for r in got] == [("numbered", 1, 2019, "Smith"), ("numbered", 3, 2020, "Brown")]


def test_break_table_is_reshaped(spark):
    docs = spark.createDataFrame([(1, "t\n| a | b |\n|---|---|\n| x<br>y | z |\nu"), (2, "")], "doc long, md string")
    got = dict(map(tuple, M.reshape_break_tables(docs, "doc", "md").collect()))
    assert got == {1: "t\n| a | b |\n| --- | --- |\n| x | z |\n| y |  |\nu", 2: ""}


def test_reading_order_of_two_columns(spark):
    boxes = [("Title", 50, 10, 550), ("Left top", 50, 80, 280), ("Right top", 320, 80, 550), ("Left bot", 50, 200, 280), ("Right bot", 320, 200, 550)]
    rows = spark.createDataFrame([(1, n, float(a), float(b), float(c)) for n, a, b, c in boxes], "page long, id string, x0 double, y0 double, x1 double")
    assert L.count_columns(rows, 600.0).first().n_cols == 2
    got = [r.id for r in L.reading_order(rows, 600.0).orderBy("pos").collect()]
    assert got == ["Title", "Left top", "Left bot", "Right top", "Right bot"]
