"""Quality rules: base counts, and robust multivariate outliers per language and source.

Every step is a DataFrame expression. Word statistics are array expressions within a row, so no text is shuffled.
The statistics are transformed to stable variance; each (lang, source) group, a pool of a language's small ones, or where
that is small too the whole language or corpus, gets a minimum-covariance-determinant estimate (Rousseeuw and Van Driessen, 1999): from two deterministic starts,
concentration steps refit mean and covariance on the nearest half of the group's rows until the determinant stops
falling, and the start with the smaller determinant is kept. A row is rejected when its Mahalanobis distance under its group's estimate is
beyond the 0.999 quantile of the chi-square law.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.llm.common import SPACE, kept, table

#: The share of a group that an estimate rests on, the most concentration steps, and the least rows of a group.
SHARE, STEPS, LEAST = 0.5, 50, 60
#: The least rows of a whole table for an estimate of its own.
FEW = 20
#: Concentration ends when no logarithm of a determinant falls by more: 1 % of a determinant, 0.1 % of each axis.
CLOSE = 1e-2
#: Squared distances beyond this quantile of the chi-square law are rejected.
LAW = 0.999
#: Words that short texts' shares are shrunk by towards the usual ones, and the least spread of a statistic.
PRIOR, FLOOR = 20.0, 0.03
SALTS = 32
STATS = ("x0", "x1", "x2", "x3", "x4")


def base_counts(text: Column) -> dict[str, Column]:
    """Expressions over a column of texts without nulls; words and windows are arrays made in an earlier step."""
    return {
        "word_chars": F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
    }


def counted(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the shares' raw counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    a = docs.withColumn("_t", text).withColumn("_w", F.array_remove(F.split("_t", f"[{SPACE}]+"), ""))
    a = a.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    # windows as (hash, place), sorted: equal windows stand together
    n = F.size("_w")
    a = a.withColumn("_h", F.when(n >= 5, F.sort_array(F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.struct(F.xxhash64(F.slice("_w", i + 1, 5)).alias("h"), i.alias("i"))))))
    same = lambda i, x: F.get("_h", i)["h"] == x["h"]
    a = a.withColumn("_p", F.sort_array(F.transform(F.filter("_h", lambda x, i: same(i - 1, x) | F.coalesce(same(i + 1, x), F.lit(False))), lambda x: x["i"])))
    m = F.size("_p")
    covered = F.aggregate(F.transform("_p", lambda p, i: F.least(F.lit(5), F.coalesce(F.get("_p", i + 1) - p, F.lit(5)))), F.lit(0), lambda s, x: s + x)
    counts = base_counts(F.col("_t")) | {
        "n_words": n.cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": F.when(m > 0, covered).otherwise(0).cast("long"),
        "_n_lines": F.size("_l"),
        "_upper": F.length("_t") - F.length(F.regexp_replace("_t", r"\p{Lu}", "")),
        "_marks": F.length("_t") - F.length(F.translate("_t", "!?.,;:", "")),
    }
    return a.withColumns(counts).drop("_t", "_w", "_l", "_h", "_p")


def statistics() -> dict[str, Column]:
    """Shares under the arcsine root, shrunk for short texts; mean word length under the logarithm."""
    share = lambda k, n, usual: F.asin(F.sqrt(F.least(F.lit(1.0), (k + PRIOR * usual) / (n + PRIOR))))
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "x0": F.log((chars + PRIOR * 5.5) / (n + PRIOR)),
        "x1": share(F.col("n_symbols"), chars, 0.002),
        "x2": share(F.col("_upper"), chars, 0.03),
        "x3": share(F.col("_marks"), n, 0.15),
        "x4": share(F.col("n_dup_lines"), F.col("_n_lines"), 0.01),
    }


def _pairs(d: int):
    return [(i, j) for i in range(d) for j in range(i + 1)]


def _cholesky(p: DataFrame, d: int) -> DataFrame:
    """Adds the inverse-ready factor l_i_j and the log determinant to a table with covariances c_i_j; a row per group."""
    for j in range(d):
        diag = F.col(f"c_{j}_{j}") - sum((F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        p = p.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(diag, F.lit(1e-12))))
        if j + 1 < d:
            p = p.withColumns({f"l_{i}_{j}": (F.col(f"c_{i}_{j}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l_{j}_{j}") for i in range(j + 1, d)})
    return p.withColumn("logdet", sum((F.log(f"l_{j}_{j}") for j in range(d)), F.lit(0.0)) * 2)


def _distance(t: DataFrame, d: int) -> DataFrame:
    """Adds the squared Mahalanobis distance d2 to rows with statistics, means m_i and factors l_i_j."""
    for i in range(d):
        t = t.withColumn(f"y_{i}", (F.col(STATS[i]) - F.col(f"m_{i}") - sum((F.col(f"l_{i}_{k}") * F.col(f"y_{k}") for k in range(i)), F.lit(0.0))) / F.col(f"l_{i}_{i}"))
    return t.withColumn("d2", sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(d)), F.lit(0.0))).drop(*[f"y_{i}" for i in range(d)])


def _salted(p: DataFrame) -> DataFrame:
    return p.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _law(x: float, k: int) -> float:
    """The distribution function of chi-square with k degrees of freedom, by its series."""
    a, total, term = k / 2, 0.0, 1.0
    for n in range(400):
        total += term
        term *= x / 2 / (a + n + 1)
    return math.exp(a * math.log(x / 2) - x / 2 - math.lgamma(a + 1)) * total


def _quantile(share: float, k: int) -> float:
    low, high = 1e-9, 200.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _law(mid, k) < share else (low, mid)
    return low


def _consistency(d: int, share: float) -> float:
    """What the covariance of the nearest share of normal rows must be multiplied by."""
    return share / _law(_quantile(share, d), d + 2)


def mcd(rows: DataFrame) -> DataFrame:
    """(g, m_i, l_i_j, n): the estimate of each group g of rows (g, salt, statistics).

    Rows of a group are dealt over salts, and each pass combines sums or quantile sketches before the shuffle, so
    a group with a third of all rows costs no task more than its share. Spread below FLOOR counts as FLOOR, so a
    statistic that is constant in a group doesn't make its smallest change infinitely far.
    """
    d = len(STATS)
    mid = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"q_{i}") for i, x in enumerate(STATS)])
    first = mid.select("g", "n", *[F.col(f"q_{i}")[1].alias(f"m_{i}") for i in range(d)], *[F.greatest((F.col(f"q_{i}")[2] - F.col(f"q_{i}")[0]) / 1.349, F.lit(FLOOR)).alias(f"s_{i}") for i in range(d)])
    t = rows.join(_salted(first), ["g", "salt"])
    z = [F.abs(F.col(x) - F.col(f"m_{i}")) / F.col(f"s_{i}") for i, x in enumerate(STATS)]
    # two starts: the nearest rows by the sum of squares and by the largest coordinate
    t = t.select("g", "salt", *STATS, F.explode(F.array(F.struct(F.lit(0).alias("start"), sum((v * v for v in z), F.lit(0.0)).alias("d2")), F.struct(F.lit(1).alias("start"), F.greatest(*z).alias("d2")))).alias("s")).select("g", "salt", *STATS, "s.*")
    key, factor, params = ["g", "start", "salt"], _consistency(d, SHARE), None
    both = rows.select("g", "salt", *STATS, F.explode(F.array(F.lit(0), F.lit(1))).alias("start"))
    for _ in range(STEPS):
        limit = t.groupBy("g", "start").agg(F.percentile_approx("d2", SHARE, 1000).alias("most"))
        near = t.join(_salted(limit), key).where("d2 <= most")
        sums = near.groupBy("g", "start").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"m_{i}") for i, x in enumerate(STATS)], *[F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"c_{i}_{j}") for i, j in _pairs(d)])
        sums = sums.withColumns({f"m_{i}": F.col(f"m_{i}") / F.col("n") for i in range(d)})
        sums = sums.withColumns({f"c_{i}_{j}": (F.col(f"c_{i}_{j}") / F.col("n") - F.col(f"m_{i}") * F.col(f"m_{j}")) * factor + (FLOOR * FLOOR if i == j else 0.0) for i, j in _pairs(d)})
        sums = _cholesky(sums, d).drop(*[f"c_{i}_{j}" for i, j in _pairs(d)])
        if params is None:
            params = kept(sums)
        else:
            both_ = kept(sums.join(params.select("g", "start", F.col("logdet").alias("_was")), ["g", "start"]))
            params, fell = both_.drop("_was"), both_.agg(F.max(F.col("_was") - F.col("logdet"))).first()[0]
            if fell is None or fell <= CLOSE:
                break
        t = _distance(both.join(_salted(params.drop("n", "logdet")), key), d).select("g", "salt", "start", *STATS, "d2")
    best = params.groupBy("g").agg(F.min_by(F.struct("start", *[c for c in params.columns if c not in ("g", "start")]), F.struct("logdet", "start")).alias("p"))
    return best.select("g", "p.*").drop("start", "logdet")


def quality_rules(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys, base counts, base_failed, distance, kept), a row per row of docs (keys, text, lang, source).

    A null text has no words and fails the base rule. Null languages and sources are groups of their own. Groups with
    under LEAST rows that pass the base rule are pooled by language. Rows of a pool that is still under it are judged by
    the estimate of their whole language, if that has LEAST rows, or else of the whole table, and only in a table with
    under FEW such rows by the base rule alone (distance null). Repeated rows are judged
    alike, row by row; other columns of docs are not looked at. An empty table gives an empty result.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    a = counted(docs.select(*keys, "text", "lang", "source"))
    a = a.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).withColumns(statistics())
    a = kept(a.select(*keys, "lang", "source", *counts, "base_failed", *STATS, F.pmod(F.xxhash64(*keys), F.lit(SALTS)).cast("int").alias("salt")))
    rows = kept(_labelled(a, _labels(a.where("not base_failed"))))
    fits = mcd(rows.where("not base_failed").select(F.explode("feeds").alias("g"), "salt", *STATS)).withColumnRenamed("n", "n_fit")
    out = _distance(rows.drop("feeds").join(_salted(fits), ["g", "salt"], "left"), len(STATS))
    far = F.when(~F.col("base_failed") & (F.col("n_fit") >= SHARE * FEW * 0.9), F.col("d2"))
    return out.select(*keys, *counts, "base_failed", far.alias("distance"), (~F.col("base_failed") & F.coalesce(far <= _quantile(LAW, len(STATS)), F.lit(True))).alias("kept"))


def _labels(fine: DataFrame) -> DataFrame:
    """(_lang, _source, g, feeds): the group each language and source is judged by, and the groups it is part of."""
    own = fine.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = F.when(F.col("n") < LEAST, F.col("n"))
    by_lang = own.groupBy("lang").agg(F.sum(small).alias("pooled"), F.sum("n").alias("whole")).withColumnRenamed("lang", "_l")
    by_lang = by_lang.withColumn("rest", F.coalesce(F.col("pooled") < LEAST, F.lit(False)))  # whether its pool is too small
    any_ = by_lang.agg(F.coalesce(F.max(F.col("rest") & (F.col("whole") < LEAST)), F.lit(False)).alias("all_"))
    name = lambda *c: F.to_json(F.array(*[F.coalesce(F.col(x), F.lit("\0")) for x in c]))
    whole = F.concat(F.lit("whole "), name("lang"))
    first = F.when(F.col("n") >= LEAST, name("lang", "source")).when(F.col("pooled") >= LEAST, name("lang"))
    g = F.coalesce(first, F.when(F.col("whole") >= LEAST, whole), F.lit("all"))
    wide = F.array(first, F.when(F.col("rest") & (F.col("whole") >= LEAST), whole), F.when(F.col("all_"), F.lit("all")))
    t = own.join(by_lang, F.expr("lang <=> _l"), "left").join(F.broadcast(any_))
    return t.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), g.alias("g"), F.filter(wide, lambda x: x.isNotNull()).alias("feeds"))


def _labelled(a: DataFrame, labels: DataFrame) -> DataFrame:
    """a with the labels g and feeds of its language and source; joined by salt besides, since one source may hold a third of all rows."""
    b = _salted(labels).withColumnRenamed("salt", "_salt")
    return a.join(b, F.expr("lang <=> _lang and source <=> _source and salt = _salt"), "left").drop("_lang", "_source", "_salt")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that are kept, as quality_rules() says; null and empty texts have too few words and go.

    Rows are told apart by two hashes of all their columns, 96 bits; equal rows are judged alike.
    """
    keyed = docs.withColumns({"_k": F.xxhash64(*docs.columns), "_m": F.hash(*docs.columns)})
    out = quality_rules(keyed, ("_k", "_m")).where("not kept").select("_k", "_m").distinct()
    return keyed.join(out.hint("shuffle_hash"), ["_k", "_m"], "left_anti").select(*docs.columns)
