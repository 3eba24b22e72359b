"""Queries against their SQL on small tables, and literal cases of functions."""

import numbers

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexflume.functions import text as T
from lexflume.operators import charts, policies
from lexflume.plans import all_queries as Q

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v is pd.NA or v != v:
        return None
    return round(float(v), 6) if isinstance(v, numbers.Number | np.number | np.bool_) else str(v)


def rows(df):
    return sorted(repr([plain(v) for v in r]) for r in df[sorted(df.columns)].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, con, name):
    got, want = Q.QUERIES[name](spark, DIR).toPandas(), con.execute(Q.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()[0]


@pytest.mark.parametrize(("f", "arg", "want"), [
    (T.dehyphenate, "config­\nuration", "configuration"),
    (T.dehyphenate, "broken-\nword", "brokenword"),
    (T.expand_ligatures, "classiﬁcation aﬂow oﬃce", "classification aflow office"),
    (T.tokens, "Hello World! 123.", ["hello", "world", "123"]),
    (T.expand_range, "3", [3]),
    (T.expand_range, "3-5", [3, 4, 5]),
    (T.expand_range, "3, 4 and 7", [3, 4, 7]),
    (T.expand_range, "2-90", [2]),
    (T.journal_like, "J. Bio. 99, 12345", True),
    (T.journal_like, "Distributed representations of words and phrases", False),
    (T.parse_number, "1,5", 1.5),
    (T.parse_number, "1,200.5", 1200.5),
    (T.clean_soft_hyphens, None, ""),
])
def test_literal(spark, f, arg, want):
    assert one(spark, f(F.lit(arg))) == want


def test_policies(spark):
    assert one(spark, policies.for_paragraph(F.lit("A clean paragraph of plain words that says what it should.")))["decision"] == "skip"
    assert one(spark, policies.for_paragraph(F.lit("so­me ­ﬁx ­­ﬂ ### x y z ***** broken")))["decision"] == "replace"
    assert one(spark, policies.for_table(F.lit(True), F.lit(0.6)))["decision"] == "validate"
    assert one(spark, policies.pct(F.lit(3), F.lit(10))) == 30.0
    assert one(spark, policies.pct(F.lit(3), F.lit(0))) == 0.0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["page", "caption", "region", "how"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_axes_are_fitted_without_what_fits_worst(spark):
    def plain(g):  # the same by loops over every band
        best = None
        for band in sorted({b for b, _, _ in g}):
            p = sorted((x, y) for b, x, y in g if b == band)
            while len(p) >= 2 and len({x for x, _ in p}) >= 2:
                x, y = np.array(p).T
                slope, intercept = np.polyfit(x, y, 1)
                off = abs(y - slope * x - intercept)
                r2 = 1 - (off**2).sum() / (((y - y.mean()) ** 2).sum() or 1e-9)
                if r2 >= 0.99 or len(p) == 2:
                    if r2 >= 0.95 and slope > 0 and (best is None or r2 * len(p) > best[0]):
                        best = (r2 * len(p), slope, len(p))
                    break
                p.pop(int(off.argmax()))
        return best

    rng = np.random.default_rng(3)
    rows = [(c, "x", int(rng.integers(0, 2)), float(x), 2.0 * float(x) + 5 + (40 if rng.random() < 0.2 else 0)) for c in range(20) for x in rng.choice(200, 7, replace=False)]
    got = {r["chart"]: r for r in charts.fit_axes(spark.createDataFrame(rows, "chart long, axis string, band int, pixel double, value double")).collect()}
    for c in range(20):
        want = plain([(b, x, y) for k, _, b, x, y in rows if k == c])
        assert (want is None) == (c not in got)
        if want:
            assert abs(got[c]["slope"] - want[1]) < 1e-9 and got[c]["n"] == want[2]


def test_bars_take_the_nearest_free_word(spark):
    rows = [([10.0, 20.0, 30.0], [(11.0, "a"), (29.0, "c"), (12.0, "b")], 10.0, ["a", "Category 2", "c"]), ([10.0, 12.0], [(10.0, "a"), (10.5, "b")], 10.0, ["a", "b"]), ([5.0], [], 10.0, ["Category 1"])]
    d = spark.createDataFrame(rows, "c array<double>, w array<struct<at: double, text: string>>, s double, want array<string>")
    assert all(r["got"] == r["want"] for r in d.withColumn("got", charts.labelled(F.col("c"), F.col("w"), F.col("s"))).collect())
