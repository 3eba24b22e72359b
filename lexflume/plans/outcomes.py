"""Queries over outcomes: slices, boxes, panels, attempts, checked answers, lists of references in tables, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexflume.operators import charts, metrics, rollups
from lexflume.operators import outcomes as O
from lexflume.plans.charts import _items
from lexflume.plans.registry import query

_WEDGES = "user_id as plot, 'c' || event_id % 14 as key, cast(event_id * 7 % 720 as int) as a, cast(event_id * 7 % 720 + 4 + user_id % 9 as int) as b"


@query(f"""with s as (select plot, key, sum(b - a) span from (select {_WEDGES} from events) group by all), w as (select *, sum(span) over (partition by plot) al, count(*) over (partition by plot) n, row_number() over (partition by plot order by span desc, key)::int place from s)
select plot, place, key, case when al < 576 then null else round(100.0::double * span / al, 2) end as percent, case when al < 576 then 'no_bars' when n between 2 and 12 then 'ok' else 'partial' end as status from w""")
def x5_pie_slices(t):
    return O.pie_slices(t("events").selectExpr(*_items(_WEDGES)))


_CAND = "user_id as chart, cast(event_id * 37 % 500 as int) as x, cast(event_id % 90 as int) as y, cast(5 + event_id % 60 as int) as w, cast(5 + event_id % 71 as int) as h, cast((5 + event_id % 60) * (5 + event_id % 71) / 4 as int) as area"


@query(f"""with recursive c as (select chart, x, y, w, h, row_number() over (partition by chart order by x, y, w, h) n from (select {_CAND} from events) where w >= 10 and h >= 18 and w <= 180 and h <= 210 and w::double / h between 0.2 and 4 and area::double / (w * h) >= 0.1),
r as (select chart, n, 1 as g, x, y, w, h from c where n = 1 union all
 select c.chart, c.n, case when c.x < r.x + r.w then r.g else r.g + 1 end, case when c.x < r.x + r.w and c.w * c.h <= r.w * r.h then r.x else c.x end, case when c.x < r.x + r.w and c.w * c.h <= r.w * r.h then r.y else c.y end,
 case when c.x < r.x + r.w and c.w * c.h <= r.w * r.h then r.w else c.w end, case when c.x < r.x + r.w and c.w * c.h <= r.w * r.h then r.h else c.h end from r join c on c.chart = r.chart and c.n = r.n + 1),
b as (select chart, g, arg_max({{'x': x, 'y': y, 'w': w, 'h': h}}, n) b from r group by all)
select chart, g as place, b.x as x, b.y as y, b.w as w, b.h as h, round((b.y + b.h) * -0.5 + 200, 3)::double as q1, round(b.y * -0.5 + 200, 3)::double as q3 from b""")
def x4_boxes(t):
    b = O.box_candidates(t("events").selectExpr(*_items(_CAND)), 600.0, 300.0).select("chart", F.posexplode("boxes").alias("i", "b"))
    s = O.box_summary(F.col("b.y") + F.col("b.h"), F.col("b.y"), F.col("b.y"), F.col("b.y"), F.col("b.y"), -0.5, 200.0)
    return b.select("chart", (F.col("i") + 1).alias("place"), "b.x", "b.y", "b.w", "b.h", s.alias("s")).select("chart", "place", "x", "y", "w", "h", "s.q1", "s.q3")


@query("""with l as (select o_orderkey fig, unnest(['a', 'b', 'c', 'd', 'e', 'f']) txt, unnest([0, 1, 2, 3, 4, 5]) k from orders) select fig, txt as text, (k // 3)::int as row, (k % 3)::int as col from l""")
def j19_x11_panel_grid(t):
    o = t("orders").select(F.col("o_orderkey").alias("fig"), F.posexplode(F.array(*map(F.lit, "abcdef"))).alias("k", "text"))
    at = o.select("fig", "text", (F.expr("k % 3") * 200 + F.expr("(fig + k) % 7")).alias("cx"), (F.expr("k div 3") * 150 + F.expr("(fig * k) % 5")).alias("cy"))
    return O.panel_grid(at, 600.0, 400.0)


_TRIES = "user_id as fig, event_id as run, event_type as kind, case event_id % 3 when 0 then 'ok' when 1 then 'partial' else 'failed' end as status, cast((event_id % 90) / 100.0 as double) as conf"


@query(f"""with a as (select {_TRIES} from events), s as (select fig, min(run) stop from a where status = 'ok' and conf >= 0.5 group by fig), u as (select a.*, case status when 'ok' then 3.0 when 'partial' then 1.5 else 0 end::double + conf w from a left join s using (fig) where stop is null or run <= stop),
r as (select *, row_number() over (partition by fig order by w desc, run) n, count(*) over (partition by fig) tried from u) select fig, run, kind, status, conf, tried from r where n = 1""")
def p3_best_attempt(t):
    return O.best_attempt(t("events").selectExpr(*_items(_TRIES)))


@query("""select conv_id, turn, case turn % 4 when 0 then 'Diagram extracted via vision model.' when 1 then 'A table of crops here.' when 2 then 'Equation.' else case when conv_id % 2 = 0 then 'Three words said.' end end as alt,
case turn % 4 when 0 then 'graph LR' || chr(10) || 'A --> B' when 1 then '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | ' || conv_id || ' |' when 2 then '$$x^2$$' end as body, case when turn % 4 = 3 and conv_id % 2 = 1 then 'output-failed-validation' end as error from conversations""")
def p9_checked_answers(t):
    raw = "case turn % 4 when 0 then '```mermaid\\ngraph LR\\nA --> B\\n```' when 1 then concat('A table of crops here.\\n\\n| a | b |\\n|---|---|\\n| 1 | ', conv_id, ' |') when 2 then 'So $$ x^2 $$' else case when conv_id % 2 = 0 then 'Three words said' else 'No' end end"
    kind = F.expr("case turn % 4 when 0 then 'schematic' when 1 then 'bar_chart' when 2 then 'equation' else 'flow_diagram' end")
    return t("conversations").select("conv_id", "turn", O.checked_answer(kind, F.expr(raw)).alias("a")).select("conv_id", "turn", "a.*")


_REFTABLE = "'x' || chr(10) || case when doc_id % 3 = 0 then '|1.|One | |' || chr(10) || '|---|---|---|' || chr(10) || '| |goes on|' || chr(10) || '|2.|Two|' || chr(10) || '|3.|Three|b|' else '|1.|One|' || chr(10) || '|2.|Two|' end || chr(10) || 'y ' || doc_id"


@query("select doc_id, 'x' || chr(10) || case when doc_id % 3 = 0 then '1. One goes on' || chr(10) || '2. Two' || chr(10) || '3. Three b' || chr(10) else '|1.|One|' || chr(10) || '|2.|Two|' end || chr(10) || 'y ' || doc_id as md from documents")
def d6_unwrap_references(t):
    return O.unwrapped_references(t("documents").select("doc_id", F.expr(_REFTABLE.replace("chr(10)", "'\\n'")).alias("md")), "doc_id", "md")


@query("select doc_id as key, p.page as page, p.chars as chars from (select doc_id, unnest([{'page': 1, 'chars': n_chars::bigint}, {'page': (doc_id % 9 + 2)::int, 'chars': 7::bigint}]) p from documents)")
def a19_page_chars(t):
    j = "concat('{\"pages\": [{\"page\": 1, \"chars\": ', n_chars, '}, {\"page\": \"x\", \"chars\": 3}, {\"page\": \"', doc_id % 9 + 2, '\", \"chars\": \"7\"}]}')"
    return O.page_chars(t("documents").select(F.col("doc_id").alias("key"), F.expr(j).alias("j")), "j")


_LINE = "case doc_id % 5 when 0 then 'A B S T R A C T' when 1 then 'Abstract: ' || text when 2 then 'A R T I C L E I N F O' when 3 then 'Keywords: soil' else text end"


@query("select doc_id, case doc_id % 5 when 0 then 'abstract' when 1 then case when length(trim('Abstract: ' || text)) <= 30 then 'abstract' end when 2 then 'article info' when 3 then 'keywords' end as kind from documents")
def f5_header_kinds(t):
    return t("documents").select("doc_id", O.header_kind(F.expr(_LINE)).alias("kind"))


_W = "list_distinct(list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda w: w <> ''))"


@query(f"with x as (select conv_id, turn, {_W.format('text')} a, {_W.format('''translate(text, 'e', '')''')} b from conversations) select conv_id, turn, array_to_string(list_sort(list_filter(a, lambda w: not list_contains(b, w))), ' ') as only_a, array_to_string(list_sort(list_filter(b, lambda w: not list_contains(a, w))), ' ') as only_b from x")
def u8_word_differences(t):
    d = t("conversations").select("conv_id", "turn", O.word_differences(F.col("text"), F.expr("translate(text, 'e', '')")).alias("d"))
    return d.select("conv_id", "turn", F.array_join("d.only_a", " ").alias("only_a"), F.array_join("d.only_b", " ").alias("only_b"))


@query("select '| ' || doc_id || ' | ' || coalesce(lang, '') || ' | ' || n_chars || ' | ' || printf('%.2f', (doc_id % 97) / 101.0::double) || ' |' as line from documents")
def b6_b8_report_lines(t):
    d = t("documents").select("doc_id", "lang", "n_chars", (F.col("doc_id") % 97 / F.lit(101.0)).alias("coverage"))
    return O.report_lines(d, "doc_id", "lang", "n_chars", "coverage")


@query("select coalesce(sum(n_chars), 0)::bigint as n_chars, coalesce(sum(doc_id % 7), 0)::bigint as n_figures from documents")
def k21_totals(t):
    return rollups.totals_of(t("documents").select("n_chars", (F.col("doc_id") % 7).alias("n_figures")), "n_chars", "n_figures")


@query("""with w as (select distinct lang, unnest(regexp_extract_all(regexp_replace(lower(text), '[^\\x00-\\x7f]', ' ', 'g'), '[a-z0-9]+')) w from documents) select lang, count(*) as n from w group by lang""")
def k22_distinct_words(t):
    return metrics.distinct_words(t("documents"), "lang", "text")


@query("""select '{"total":' || count(*) || ',"ok":' || count(*) filter (doc_id % 4 > 0) || ',"failed":' || count(*) filter (doc_id % 4 = 0) || ',"seconds":' || sum(doc_id % 60)::bigint || '}' as report from documents""")
def b12_batch_report(t):
    return rollups.batch_report(t("documents").selectExpr("case when doc_id % 4 > 0 then 'ok' else 'failed' end as status", "doc_id % 60 as seconds"))


@query("select o_orderkey as fig, o_custkey as paper, x.text as text from orders left join (select l_orderkey, min(l_returnflag || l_partkey) as text from lineitem where l_linenumber > 2 group by 1) x on l_orderkey = o_orderkey")
def a21_figure_texts(t):
    texts = t("lineitem").where("l_linenumber > 2").selectExpr("l_orderkey as fig", "l_returnflag || l_partkey as text")
    return rollups.with_texts(t("orders").selectExpr("o_orderkey as fig", "o_custkey as paper"), texts)


_REGION = "l_orderkey as page, l_linenumber as region, cast(l_quantity as double) as x0, cast(l_partkey % 90 as double) as y0, cast(l_quantity + 40 as double) as x1, cast(l_partkey % 90 + 30 as double) as y1"


@query(f"select {_REGION}, l_suppkey % 2 = 0 as is_image from lineitem where l_suppkey % 3 <> 2")
def u6_regions(t):
    side = lambda where: t("lineitem").where(f"l_suppkey % 3 <> 2 and {where}").selectExpr(*_items(_REGION))
    return rollups.regions(side("l_suppkey % 2 = 0"), side("l_suppkey % 2 = 1"))


@query("""select o_orderkey as chart, case when o_orderkey % 4 = 0 then 'b,a,Category 3,d' else 'b,a,c,d' end as labels from orders""")
def j15_bar_labels(t):
    word = lambda at, text: F.struct(F.expr(f"cast({at} as double)").alias("at"), F.lit(text).alias("text"))
    words = F.array(word("20 + o_orderkey % 5", "a"), word("10 - o_orderkey % 4", "b"), word("case when o_orderkey % 4 = 0 then 99 else 31 end", "c"), word("40 + o_orderkey % 3", "d"))
    centres = F.array(*[F.lit(x) for x in (10.0, 20.0, 30.0, 40.0)])
    return t("orders").select(F.col("o_orderkey").alias("chart"), F.array_join(charts.labelled(centres, words, F.lit(10.0)), ",").alias("labels"))
