"""Queries over figures: kinds, scores, credibility, arbitration, captions, answers of models, diagrams."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexflume.operators import figures as V
from lexflume.plans.registry import query

#: Numbers of an order, under the names that the figures below are made of.
_ORDER = ("o_orderkey as l_orderkey", "cast(1 + o_custkey % 7 as int) as l_linenumber", "o_custkey as l_partkey", "cast(floor(o_totalprice) as bigint) as l_suppkey", "1 + cast(floor(o_totalprice) as bigint) % 50 as l_quantity")
#: A figure per order: a caption, words in the image, features.
_FIG = (
    "l_orderkey", "l_linenumber",
    "case l_partkey % 9 when 0 then 'Bar chart of the mean of yield and average kg per plot' when 1 then 'Workflow of the process' when 2 then 'Study area, map of the region' when 3 then 'Time series of the annual trend' when 4 then 'Pie chart: share of land and composition' when 5 then '' when 6 then 'Results by group' when 7 then 'Quartile and median values' else 'Table and matrix of scatter, regression and correlation' end as caption",
    "case l_suppkey % 5 when 0 then '' when 1 then '10 20 30 40 50 % x' when 2 then 'picture of the site, formula x = 3' when 3 then 'a b c principal component' else '1 2 3 table 4.5' end as ocr",
    "l_orderkey % 11 <> 0 as has", "l_linenumber % 2 = 0 as axes", "cast(l_quantity as int) % 15 as bars", "l_partkey % 300 as colours", "l_suppkey % 4 as circles",
    "cast(l_quantity as double) / 900 as density", "l_suppkey % 120 as rects", "cast(l_quantity as double) / 10 as aspect", "(l_partkey % 30) / 100.0 as text_share", "l_partkey % 7 = 0 as math", "l_partkey % 3 = 0 as gray",
    "30 + l_partkey % 400 as w", "30 + l_suppkey % 50 as h",
)
_FIG_SQL = f"select {', '.join(_FIG)} from (select {', '.join(_ORDER)} from orders)"
_FEATURES = ("has", "axes", "bars", "colours", "circles", "density", "rects", "aspect", "text_share", "math", "gray")


def _hits(text: str, kind: str) -> str:
    return "(" + " + ".join(f"contains({text}, '{k}')::int" for k in V.KEYWORDS[kind]) + ")"


def _most(text: str, n: str = "best") -> str:
    return ", ".join(f"{_hits(text, k)} h_{k}" for k in V.KEYWORDS)


_BEST = f"greatest({', '.join('h_' + k for k in V.KEYWORDS)})"
_BEST_KIND = "case " + " ".join(f"when h_{k} = {_BEST} then '{k}'" for k in V.KEYWORDS) + " end"
_STRONG = " ".join(f"when regexp_matches(t, '{p}') then '{k}'" for p, k, _ in V.STRONG)


@query(f"""with f as (select *, trim(lower(case when caption <> '' then caption else ocr end)) t from ({_FIG_SQL})), h as (select *, {_most('t')} from f)
select l_orderkey, l_linenumber, case when t = '' then 'unknown' {_STRONG} when {_BEST} = 0 then 'unknown' else {_BEST_KIND} end as kind, {_BEST} as hits from h""")
def v4_k13_classify_captions(t):
    f = t("orders").selectExpr(*_ORDER).selectExpr(*_FIG)
    text = F.lower(F.when(F.col("caption") != "", F.col("caption")).otherwise(F.col("ocr")))
    return f.select("l_orderkey", "l_linenumber", V.classify(F.col("caption"), F.col("ocr"))["kind"].alias("kind"), (-V.most_keywords(text)["n"]).alias("hits"))


def _scaled(x: str, a: float, b: float) -> str:
    return f"greatest(0.0::double, least(1.0::double, ({x} - {a}::double) / ({b}::double - {a}::double)))"


_A = {
    "bar": f"case when has then {_scaled('bars', 2, 12)} else 0 end", "axis": "case when not has then 0.5 when axes then 1 else 0 end", "noaxis": "case when not has then 0.5 when axes then 0 else 1 end",
    "few4": f"case when has then 1 - {_scaled('bars', 0, 4)} else 0 end", "boxes": f"case when has then {_scaled('rects', 3, 15)} else 0 end",
}
#: Weighted terms by kind; cap stands for the caption's score.
_TERMS = {
    "bar_chart": [(0.30, _A["bar"]), (0.30, "cap"), (0.15, "case when regexp_matches(ocr, '[0-9]') then 1 else 0.3 end"), (0.25, _A["axis"])],
    "stacked_bar_chart": [(0.30, _A["bar"]), (0.25, "cap"), (0.20, f"case when has then {_scaled('colours', 6, 30)} else 0 end"), (0.25, _A["axis"])],
    "pie_chart": [(0.55, "case when not has then 0 else (case when circles = 1 then 1 when circles = 2 and bars = 0 then 0.7 when circles >= 3 then 0.2 else 0 end)::double * (case when bars >= 3 then 0.2 else 1 end)::double end"), (0.35, "cap"), (0.10, "case when contains(ocr, '%') then 1 else 0 end")],
    "line_plot": [(0.25, f"case when has then {_scaled('density', 0.005, 0.05)} else 0 end"), (0.20, "cap"), (0.15, f"case when has then 1 - {_scaled('rects', 0, 6)} else 0 end"), (0.10, f"case when has then 1 - {_scaled('bars', 0, 6)} else 0 end"), (0.30, _A["axis"])],
    "scatter_plot": [(0.30, f"case when has then {_scaled('rects', 10, 100)} else 0 end"), (0.20, "cap"), (0.15, _A["few4"]), (0.10, _scaled(r"len(regexp_extract_all(ocr, '\b[0-9]+(?:\.[0-9]+)?\b'))", 4, 20)), (0.25, _A["axis"])],
    "box_plot": [(0.25, f"case when has then {_scaled('rects', 2, 8)} else 0 end"), (0.45, "cap"), (0.30, _A["axis"])],
    "flow_diagram": [(0.25, _A["boxes"]), (0.35, "cap"), (0.20, f"case when has then {_scaled('density', 0.005, 0.03)} else 0 end"), (0.20, _A["noaxis"])],
    "schematic": [(0.30, _A["boxes"]), (0.50, "cap"), (0.20, _A["noaxis"])],
    "map": [(0.55, "cap"), (0.25, f"case when has then {_scaled('colours', 10, 80)} else 0 end"), (0.20, _A["few4"])],
    "photo": [(0.65, "cap"), (0.35, f"case when not has then 0 else {_scaled('colours', 60, 250)} * (1 - {_scaled('text_share', 0.03, 0.20)}) * (case when bars <= 1 then 1 else 0 end)::double end")],
    "equation": [(0.30, "cap"), (0.25, "case when has and aspect > 2.5 then 1 else 0 end"), (0.30, "case when regexp_matches(ocr, '[=∑∫√≤≥±·×÷]') or (has and math) then 1 else 0 end"), (0.15, _A["noaxis"])],
    "table_as_image": [(0.30, "cap"), (0.30, f"case when has then {_scaled('density', 0.008, 0.04)} else 0 end"), (0.25, _scaled("len(regexp_extract_all(ocr, '[0-9]'))::double / greatest(1, length(ocr))", 0.05, 0.30)), (0.15, "case when has and gray then 1 else 0 end")],
    "decorative": [(0.70, "case when has and decor then 1 else 0 end"), (0.30, "cap")],
}
_ROUND = "floor(({}) * 1000 + 0.5) / 1000"


def _score(kind: str) -> str:
    cap = f"least(1.0::double, {_hits('t', kind)} / 3.0::double)" if kind in V.KEYWORDS else "0.0::double"
    total = " + ".join(["0.0::double", *[f"{w}::double * ({x.replace('cap', cap) if x == 'cap' else x})::double" for w, x in terms]]) if (terms := _TERMS[kind]) else ""
    if kind == "decorative":
        total = f"({total}) * (case when len(list_filter(regexp_split_to_array(caption, '\\s+'), lambda x: x <> '')) >= 4 then 0.4 else 1 end)::double"
    return f"{{'kind': '{kind}', 'score': {_ROUND.format(total)}, 'cap': {cap}}}"


_PLAIN = "not (axes or rects >= 3 or bars >= 2 or circles >= 1 or text_share > 0.04)"
_WHY = f"case when h < 40 or w < 40 then 'thin' when w * h < 6000 then 'tiny' when (aspect > 8 or aspect < 0.125) and {_PLAIN} then 'banner' when colours < 4 and {_PLAIN} then 'monochrome' end"
_SCORED = f"select *, [{', '.join(map(_score, _TERMS))}] s from (select *, {_WHY} is not null decor, lower(caption || ' ' || ocr) t from ({_FIG_SQL}))"


def _scored(t):
    f = t("orders").selectExpr(*_ORDER).selectExpr(*_FIG)
    cols = {c: F.col(c) for c in _FEATURES}
    f = f.withColumn("decor", V.decorative(F.col("w"), F.col("h"), cols).isNotNull())
    return f.withColumn("s", V.specialists(F.col("caption"), F.col("ocr"), {**cols, "decor": F.col("decor")}))


@query(f"select l_orderkey, l_linenumber, {_WHY} as why from ({_FIG_SQL})")
def v2_decorative(t):
    f = t("orders").selectExpr(*_ORDER).selectExpr(*_FIG)
    return f.select("l_orderkey", "l_linenumber", V.decorative(F.col("w"), F.col("h"), {c: F.col(c) for c in _FEATURES}).alias("why"))


@query(f"select l_orderkey, l_linenumber, x.kind as kind, x.score as score, x.cap as cap from (select l_orderkey, l_linenumber, unnest(s) x from ({_SCORED}))")
def v5_v7_v19_specialists(t):
    return _scored(t).select("l_orderkey", "l_linenumber", F.explode("s").alias("x")).select("l_orderkey", "l_linenumber", "x.kind", "x.score", "x.cap")


_MIX = """u as (select l_orderkey, l_linenumber, unnest(s) x, generate_subscripts(s, 1) i from scored),
r as (select *, row_number() over (partition by l_orderkey, l_linenumber order by x.score desc, i) n, row_number() over (partition by l_orderkey, l_linenumber order by x.cap desc, i) c from u),
o as (select l_orderkey, l_linenumber, max(x.kind) filter (where c = 1) ck, max(x.cap) filter (where c = 1) cc, max(x.score) filter (where c = 1) cs, max(x.score) filter (where c > 1) others, max(x.kind) filter (where n = 1) k, max(x.score) filter (where n = 1) s1, max(x.score) filter (where n = 2) s2 from r group by all),
mix as (select l_orderkey, l_linenumber, case when cc >= 0.66 then ck else k end kind, case when cc >= 0.66 then greatest(cs, cc) else s1 end confidence, floor((case when cc >= 0.66 then greatest(cs, cc) - others else s1 - s2 end) * 1000 + 0.5) / 1000 margin from o)"""


@query(f"with scored as ({_SCORED}), {_MIX} select * from mix")
def v20_mixture(t):
    return _scored(t).select("l_orderkey", "l_linenumber", V.mixture(F.col("s")).alias("m")).select("l_orderkey", "l_linenumber", "m.*")


@query(f"""with scored as ({_SCORED}), {_MIX}, h as (select l_orderkey, l_linenumber, {_most("t")} from scored)
select l_orderkey, l_linenumber, case when {_BEST} >= 2 then {_BEST_KIND} else kind end as kind, case when {_BEST} >= 2 then {_ROUND.format(f"least(1.0::double, {_BEST} / 3.0::double)")} else confidence end as confidence,
case when {_BEST} >= 2 then {_ROUND.format(f"least(1.0::double, {_BEST} / 3.0::double)")} else margin end as margin from h join mix using (l_orderkey, l_linenumber)""")
def v21_hybrid(t):
    s = _scored(t)
    return s.select("l_orderkey", "l_linenumber", V.hybrid(F.col("caption"), F.col("ocr"), F.col("s")).alias("m")).select("l_orderkey", "l_linenumber", "m.*")


#: Extractions of an order's lines: what each found.
_FOUND_SQL = """select l_orderkey fig, cast(count(*) as int) bars, list(l_quantity::double * 4 order by l_linenumber) percents,
list({'median': l_quantity::double, 'q1': l_quantity::double - 2, 'q3': l_quantity::double + l_linenumber, 'low': l_quantity::double - 2 - l_partkey % 2, 'high': l_quantity::double + l_linenumber} order by l_linenumber) boxes,
list(cast(l_suppkey % 6 as int) order by l_linenumber) samples,
list({'n': cast(l_partkey % 9 as bigint), 'x_min': 0.0::double, 'x_max': (l_partkey % 2)::double, 'y_min': 0.0::double, 'y_max': (l_suppkey % 2)::double, 'x_mean': (l_partkey % 5)::double, 'y_mean': 1.0::double} order by l_linenumber) clusters,
list([(l_partkey % 3)::double, (l_suppkey % 3)::double] order by l_linenumber) cells from lineitem group by all"""


def _found(t):
    d = lambda c: F.col(c).cast("double")
    li = t("lineitem")
    q, ln = d("l_quantity"), F.col("l_linenumber")
    m = lambda c, k: (F.col(c) % k).cast("double")
    rows = F.struct(
        ln.alias("o"), (q * 4).alias("p"), F.struct(q.alias("median"), (q - 2).alias("q1"), (q + ln).alias("q3"), (q - 2 - F.col("l_partkey") % 2).alias("low"), (q + ln).alias("high")).alias("b"), (F.col("l_suppkey") % 6).cast("int").alias("s"),
        F.struct((F.col("l_partkey") % 9).cast("long").alias("n"), F.lit(0.0).alias("x_min"), m("l_partkey", 2).alias("x_max"), F.lit(0.0).alias("y_min"), m("l_suppkey", 2).alias("y_max"), m("l_partkey", 5).alias("x_mean"), F.lit(1.0).alias("y_mean")).alias("c"),
        F.array(m("l_partkey", 3), m("l_suppkey", 3)).alias("r"),
    )
    g = li.groupBy(F.col("l_orderkey").alias("fig")).agg(F.array_sort(F.collect_list(rows)).alias("x"))
    part = lambda k: F.transform("x", lambda e: e[k])
    return g.select("fig", F.size("x").alias("bars"), part("p").alias("percents"), part("b").alias("boxes"), part("s").alias("samples"), part("c").alias("clusters"), part("r").alias("cells"))


_SPREAD = "(list_max(list_transform(boxes, lambda b: b.median)) - list_min(list_transform(boxes, lambda b: b.median))) / coalesce(nullif(list_max(list_transform(boxes, lambda b: abs(b.median))), 0), 1)"
_REAL = "len(list_filter(boxes, lambda b: abs(b.high - b.q3) / coalesce(nullif(abs(b.q3 - b.q1), 0), 1) > 0.2 or abs(b.q1 - b.low) / coalesce(nullif(abs(b.q3 - b.q1), 0), 1) > 0.2))"
_CRED = f"""greatest(-1.0::double, least(1.0::double, 0.0::double + (case when fig % 3 = 0 then case when bars >= 3 then 0.3 when bars = 1 then -0.5 else 0 end else 0 end)::double
 + (case when fig % 3 = 1 then (case when len(percents) >= 3 then 0.3 when len(percents) < 2 then -0.5 else 0 end)::double + (case when list_sum(percents) between 95 and 105 then 0.2 else -0.3 end)::double else 0 end)
 + (case when fig % 2 = 0 then (case when len(boxes) >= 3 then 0.2 else 0 end)::double + (case when {_SPREAD} < 0.15 then -0.6 when {_SPREAD} >= 0.5 then 0.3 else 0 end)::double + (case when {_REAL} >= greatest(1, len(boxes) // 2) then 0.3 else -0.6 end)::double else 0 end)
 + (case when fig % 5 = 0 then case when len(list_filter(samples, lambda x: x >= 4)) > 0 then 0.2 else -0.3 end else 0 end)::double
 + (case when fig % 7 < 3 then (case when list_sum(list_transform(clusters, lambda c: c.n)) >= 15 then 0.4 when list_sum(list_transform(clusters, lambda c: c.n)) >= 5 then 0.2 else 0 end)::double + (case when len(list_filter(clusters, lambda c: c.x_max > c.x_min and c.y_max > c.y_min)) > 0 then 0.1 else 0 end)::double - (case when len(list_distinct(list_transform(clusters, lambda c: c.x_mean))) < len(clusters) then 0.3 else 0 end)::double else 0 end)
 + (case when fig % 4 = 0 then case when len(cells) >= 2 and len(list_filter(flatten(cells), lambda v: v <> 0)) >= 4 then 0.3 else -0.3 end else 0 end)::double))"""
_STATUS_OF = "case fig % 8 when 0 then 'partial' when 1 then 'no_bars' when 2 then 'ocr_failed' when 3 then 'no_axis' else 'ok' end"
_WORTH = "case status when 'ok' then 4.0 when 'partial' then 2.0 when 'no_bars' then 0.3 when 'no_axis' then 0.3 when 'ocr_failed' then 0.1 else 0 end"


@query(f"""with f as ({_FOUND_SQL}), c as (select fig, {_ROUND.format(_CRED)} credible, {_STATUS_OF} status, (fig % 13) / 10.0::double conf from f)
select fig, status, credible, {_ROUND.format(f"({_WORTH})::double + least(1.0::double, conf) + case when status in ('ok', 'partial') then credible else 0 end")} as quality from c""")
def p4_p5_quality(t):
    f = _found(t)
    only = lambda c, when: F.when(F.expr(when), F.col(c))
    cred = V.credibility(only("bars", "fig % 3 = 0"), only("percents", "fig % 3 = 1"), only("boxes", "fig % 2 = 0"), only("samples", "fig % 5 = 0"), only("clusters", "fig % 7 < 3"), only("cells", "fig % 4 = 0"))
    f = f.select("fig", F.expr(_STATUS_OF).alias("status"), cred.alias("credible"), F.expr("(fig % 13) / 10.0D").alias("conf"))
    return f.select("fig", "status", "credible", V.thousandths(V.quality(F.col("status"), F.col("conf"), F.col("credible"))).alias("quality"))


_CANDS = "l_orderkey as fig, 'k' || l_linenumber as kind, l_linenumber as run, cast(case when l_orderkey % 3 = 0 then (l_partkey % 6) / 10.0 else (l_partkey % 40) / 10.0 end as double) as quality, 'k' || (1 + l_orderkey % 5) as hint"


@query(f"""with c as (select {_CANDS} from lineitem), r as (select *, row_number() over (partition by fig order by quality desc, run) n from c),
g as (select fig, max(quality) filter (where n = 1) q1, max(kind) filter (where n = 1) k1, max(quality) filter (where n = 2) q2, min(n) filter (where kind = hint) hn, max(quality) filter (where kind = hint) hq, max(hint) hint from r group by fig)
select fig, case when q1 < 0.5 and hn is not null then hint when q1 >= 0.5 and q1 - q2 < 0.3 and hn <= 3 then hint else k1 end as kind,
case when q1 < 0.5 and hn is not null then hq when q1 >= 0.5 and q1 - q2 < 0.3 and hn <= 3 then hq else q1 end as quality,
case when hn = 1 then 'highest' when q1 < 0.5 and hn is not null then 'all failed' when q1 >= 0.5 and q1 - q2 < 0.3 and hn <= 3 then 'close call' else 'highest' end as why from g""")
def p6_p7_arbitrate(t):
    return V.arbitrate(t("lineitem").selectExpr(*_split(_CANDS)))


def _split(select: str) -> list[str]:
    """The expressions of a select list; commas within parentheses don't part them."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(select):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(select[last:i])
            last = i + 1
    return [*out, select[last:]]


_TRIED = "event_id, case event_id % 7 when 0 then 'ok' when 1 then 'partial' when 2 then 'no_bars' when 3 then 'no_axis' when 4 then 'ocr_failed' when 5 then 'unsupported' else 'error' end as status, (event_id % 10) / 10.0 as conf, case user_id % 3 when 0 then 'Missing labels' else 'x' end as reason, cast(event_id % 4 as int) as bars, cast(user_id % 8 as int) as expected, event_id % 2 = 0 as retried, cast(user_id % 4 as int) as l"
_LADDER = "case l when 0 then {a}('bars/simple', 'pie/hough') when 1 then {a}('line/plot', 'flow_diagram') when 2 then {a}('bars/stacked') else {none} end"
_OTHER = "ladder[case when starts_with(ladder[1], 'bars') then 2 else 1 end]"
_FREE = "list_filter(ladder, lambda k: regexp_matches(k, 'pie|diagram|schematic'))[1]"


@query(f"""with e as (select *, {_LADDER.format(a='list_value', none='[]::varchar[]')} ladder from (select {_TRIED} from events)),
x as (select *, case status when 'no_bars' then {_OTHER} when 'no_axis' then {_FREE} when 'unsupported' then ladder[1] end nxt from e)
select event_id, case when status = 'ok' and conf < 0.7 and bars > 0 and expected >= bars + 2 and not retried then 'retry' when status = 'ok' then 'accept' when status = 'partial' and reason = 'Missing labels' and not retried then 'retry' when status = 'partial' then 'accept'
 when status = 'ocr_failed' and not retried then 'retry' when nxt is not null then 'next_kind' else 'give_up' end as action, nxt as kind from x""")
def p2_reflect(t):
    e = t("events").selectExpr(*_split(_TRIED)).withColumn("ladder", F.expr(_LADDER.format(a="array", none="cast(array() as array<string>)")))
    r = V.reflect(F.col("status"), F.col("conf"), F.col("reason"), F.col("bars"), F.col("expected"), F.lit("bars/simple"), F.col("ladder"), F.col("retried"))
    return e.select("event_id", r.alias("r")).select("event_id", "r.action", "r.kind")


_CAPTION = "case doc_id % 4 when 0 then 'Figure ' || doc_id || '. ' when 1 then '' when 2 then 'Plot ' else 'fig. 3b: ' end || case doc_id % 3 when 0 then 'It shows that ' else '' end || split_part(text, '.', 1) || case doc_id % 5 when 0 then '' else '.' end"
_W = r"len(list_filter(regexp_split_to_array({}, '\s+'), lambda x: x <> ''))"
_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_ASSESS = rf"""c as (select doc_id, {_TRIM.format('c')} c from (select doc_id, {_CAPTION} c from documents)), b as (select doc_id, c, {_TRIM.format(f"regexp_replace(c, '{V.NUMBERED}', '')")} b from c),
a as (select doc_id, c, case when {_W.format('c')} < 6 or {_W.format('b')} < 5 then 0 else {_ROUND.format(f"(case when {_W.format('b')} >= 12 then 0.3 when {_W.format('b')} >= 8 then 0.15 else 0 end)::double + (case when regexp_matches(b, '[.?!]$') then 0.2 else 0 end)::double + (case when {' or '.join(f'''contains(lower(b), '{v}')''' for v in V.VERBS)} then 0.2 else 0 end)::double + (case when list_filter(regexp_split_to_array(lower(b), '[[:space:]]+'), lambda x: x <> '')[1] in ({', '.join(f"'{o}'" for o in V.OPENERS)}) then 0 else 0.15 end)::double + (case when regexp_matches(b, '[0-9]') and regexp_matches(b, '(^|[^[:word:]])[0-9]+([.][0-9]+)?($|[^[:word:]])') then 0.15 else 0 end)::double")} end score from b)"""


@query(f"with {_ASSESS} select doc_id, score::double as score from a")
def p10_assess_captions(t):
    return t("documents").select("doc_id", V.assess_caption(F.expr(_CAPTION)).alias("score"))


_TIDY_C = r"array_to_string(list_filter(regexp_split_to_array({}, '\s+'), lambda x: x <> ''), ' ')"
_SHORT = "case when length({0}) > 280 then substr({0}, 1, 279) || '…' else {0} end"


@query(f"""with {_ASSESS}, x as (select doc_id, score, c, case doc_id % 2 when 0 then '  a model  says ' || doc_id else '  ' end teacher from a)
select doc_id, case when score >= 0.55 then 'student' when trim(teacher) <> '' then 'teacher' when c <> '' then 'caption_only' else 'empty' end as source,
case when score < 0.55 and trim(teacher) <> '' then {_TIDY_C.format('teacher')} else {_SHORT.format(_TIDY_C.format('c'))} end as alt from x""")
def p11_alt_text(t):
    d = t("documents").select("doc_id", F.expr(_CAPTION).alias("c"), F.expr("case doc_id % 2 when 0 then '  a model  says ' || doc_id else '  ' end").alias("teacher"))
    return d.select("doc_id", V.alt_text(F.col("c"), F.col("teacher")).alias("a")).select("doc_id", "a.source", "a.alt")


@query("""with e as (select event_id, case event_id % 6 when 0 then 'ok' when 1 then 'partial' when 2 then 'no_axis' when 3 then 'error' when 4 then 'unsupported' end status from events)
select event_id, case when status in ('ok', 'partial') then 'validate' else 'extract' end as decision, case status when 'ok' then 40.0 when 'partial' then 60.0 else 120.0 end::double as cost from e""")
def p12_figure_policy(t):
    e = t("events").selectExpr("event_id", "case event_id % 6 when 0 then 'ok' when 1 then 'partial' when 2 then 'no_axis' when 3 then 'error' when 4 then 'unsupported' end status")
    return e.select("event_id", V.for_figure(F.col("status")).alias("d")).select("event_id", "d.*")


_WORDY = "case conv_id % 9 when 0 then 'Algorithm of ' when 1 then 'A Western blot: ' when 2 then 'Listing 3 ' when 3 then 'the formula ' when 4 then 'a decision tree ' when 5 then 'Sankey ' when 6 then 'screenshot ' when 7 then 'TEM ' else '' end || text"
_RULES = " ".join(f"when regexp_matches(c, '{p}') then '{k}|{form}'" for p, k, form in V.PROMPTS)
_ANSWER = "case turn % 4 when 0 then 'Here: ```py' || chr(10) || 'x = 1' || chr(10) || '``` done' when 1 then 'x^2 + 1$' when 2 then '$$ y $$' else ' plain ' end"


@query(f"""with c as (select conv_id, turn, {_WORDY} c, {_TRIM.format(_ANSWER)} a from conversations), p as (select *, case when c = '' then 'generic|alt_text' {_RULES} else 'generic|alt_text' end k from c), q as (select *, split_part(k, '|', 1) subkind, split_part(k, '|', 2) form from p)
select conv_id, turn, subkind, form, case when form in ('code', 'pseudocode', 'mermaid') and contains(a, '```') then '```py' || chr(10) || 'x = 1' || chr(10) || '```' when form = 'latex' and not contains(a, '$$') and not starts_with(a, '$') then '$$ ' || rtrim(a, '$') || ' $$' else a end as answer from q""")
def v22_prompts(t):
    c = t("conversations").select("conv_id", "turn", V.prompt_for(F.expr(_WORDY)).alias("p"), F.expr(_ANSWER.replace("chr(10)", "'\\n'")).alias("a"))
    return c.select("conv_id", "turn", "p.subkind", "p.form", V.trimmed_answer(F.col("a"), F.col("p.form")).alias("answer"))


_CHECK = "case conv_id % 4 when 0 then ' OK' || chr(10) || 'more' when 1 then 'Flag: - bars are off ' || turn when 2 then '' else text end"


@query(f"""with c as (select conv_id, turn, {_TRIM.format(f"split_part({_TRIM.format(_CHECK)}, chr(10), 1)")} l from conversations)
select conv_id, turn, case when starts_with(lower(l), 'ok') then 'ok' when starts_with(lower(l), 'flag') then 'flag' else 'skipped' end as verdict,
case when starts_with(lower(l), 'ok') then '' when starts_with(lower(l), 'flag') then {_TRIM.format("regexp_replace(substr(l, 5), '^[:\\-– ]+', '')")} else 'non-conforming output' end as note from c""")
def m9_verdicts(t):
    c = t("conversations").select("conv_id", "turn", V.verdict(F.expr(_CHECK.replace("chr(10)", "'\\n'"))).alias("v"))
    return c.select("conv_id", "turn", "v.*")


@query("""select l_orderkey, l_linenumber, case when (l_partkey % 40) / 40.0 > 0.85 and 3 + l_suppkey % 6 >= 5 then 'circle' when 3 + l_suppkey % 6 = 4 and l_quantity / 50.0 < 0.65 then 'diamond' when 3 + l_suppkey % 6 = 4 and l_quantity / 50.0 < 0.92 then 'rounded' when 3 + l_suppkey % 6 >= 5 and l_quantity / 50.0 > 0.78 then 'rounded' else 'rect' end as shape from lineitem""")
def r3_shapes(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", V.shape(F.expr("l_quantity / 50.0"), F.expr("(l_partkey % 40) / 40.0"), F.expr("3 + l_suppkey % 6")).alias("shape"))


_NODES = "l_orderkey as fig, 'N' || l_linenumber as id, case l_partkey % 4 when 0 then 'Node ' || l_linenumber when 1 then '[' when 2 then 'Take  (' || l_suppkey || ') steps' else 'x' end as label, case l_suppkey % 5 when 0 then 'diamond' when 1 then 'circle' when 2 then 'rounded' when 3 then 'parallelogram' else 'rect' end as shape"
_EDGES = "l_orderkey as fig, 'N' || l_linenumber as src, 'N' || (l_linenumber + 1) as dst, l_partkey % 2 = 0 as directed, case l_suppkey % 3 when 0 then 'yes' else '' end as label"


@query(rf"""with n as (select {_NODES} from lineitem), s as (select *, coalesce(nullif(array_to_string(list_filter(regexp_split_to_array(translate(label, '[](){{}}|', '       '), '\s+'), lambda x: x <> ''), ' '), ''), id) safe from n),
w as (select *, '    ' || id || case shape when 'diamond' then '{{' || safe || '}}' when 'circle' then '((' || safe || '))' when 'rounded' then '(' || safe || ')' when 'parallelogram' then '[/' || safe || '/]' else '[' || safe || ']' end line from s),
p as (select fig, string_agg(line, chr(10) order by id, line) t,
 avg(case when not starts_with(label, 'Node ') and length(trim(label)) >= 2 and regexp_matches(label, '\p{{L}}') then 1.0 else 0 end) r from w group by fig),
y as (select fig, src, dst, '    ' || src || ' ' || case when directed then '-->' else '---' end || case when label <> '' then '|' || label || '|' else '' end || ' ' || dst line from (select {_EDGES} from lineitem)),
e as (select fig, string_agg(line, chr(10) order by src, dst, line) t from y group by fig)
select fig, case when r >= 0.3 then 'ok' else 'no_nodes' end as status, case when r >= 0.3 then '```mermaid' || chr(10) || 'flowchart LR' || chr(10) || p.t || chr(10) || e.t || chr(10) || '```' end as mermaid from p join e using (fig)""")
def r7_f13_diagrams(t):
    li = t("lineitem")
    return V.diagrams(li.selectExpr(*_split(_NODES)), li.selectExpr(*_split(_EDGES)))
