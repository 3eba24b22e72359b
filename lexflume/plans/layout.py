"""Queries over the geometry of pages and plots."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexflume.operators import layout as L
from lexflume.plans.registry import query

_BLOCKS = ("l_partkey as page", "l_orderkey * 10 + l_linenumber as id", "cast(l_orderkey * 37 % 450 as double) as x0", "cast(l_orderkey * 13 % 800 as double) as y0", "cast(l_orderkey * 37 % 450 + case l_suppkey % 15 when 0 then 480 else 40 + l_suppkey % 3 * 60 end as double) as x1", "cast(l_orderkey * 13 % 800 + 30 as double) as y1")
_B = f"b as (select {', '.join(_BLOCKS)} from lineitem)"
_COLS = """h as (select page, count(*) nb, list_transform(range(0, 16), lambda i: len(list_filter(list(least(15, trunc((x0 + x1) / 2 / 600.0 * 16)::int)), lambda x: x = i))) hist from b group by page),
s as (select *, list_transform(range(0, 16), lambda i: case when i > 0 then hist[i] else 0 end + hist[i + 1] + case when i < 15 then hist[i + 2] else 0 end) sm from h),
k as (select *, list_filter(range(1, 15), lambda i: sm[i + 1] >= list_sum(sm) / greatest(1, len(list_filter(sm, lambda x: x > 0))) and sm[i + 1] >= sm[i] and sm[i + 1] > sm[i + 2]) peaks from s),
c as (select page, case when nb < 4 then 1 else least(3, greatest(1, list_reduce(list_concat([0], peaks), lambda acc, p: case when acc > 0 and p - acc % 100 <= 2 then acc else (acc // 100 + 1) * 100 + p end) // 100)) end::int n_cols from k)"""


def _blocks(t):
    return t("lineitem").selectExpr(*_BLOCKS)


@query(f"with {_B}, {_COLS} select page, n_cols from c")
def g11_count_columns(t):
    return L.count_columns(_blocks(t), 600.0)


@query(f"""with {_B}, {_COLS}, d as (select b.*, n_cols, case when n_cols <= 1 then 0 else least(n_cols - 1, trunc((x0 + x1) / 2 / 600.0 * n_cols)::int) end col, x1 - x0 > 0.7 * 600 and n_cols > 1 wide from b join c using (page)),
o as (select *, row_number() over (partition by page order by col, y0, x0, id) r from d where not wide), m as (select page, max(r) m from o group by page),
e as (select page, r slot, 1 kind, y0, id, col from o union all
 select d.page, coalesce((select min(o.r) from o where o.page = d.page and o.y0 > d.y0), m + 1), 0, d.y0, d.id, d.col from d left join m on m.page = d.page where wide)
select page, (row_number() over (partition by page order by slot, kind, y0, id) - 1)::int as pos, id, col from e""")
def g12_g13_reading_order(t):
    return L.reading_order(_blocks(t), 600.0)


@query(f"""with {_B}, g as (select *, coalesce(y0 - lag(y1) over (partition by page order by y0, id) > 20, false) gap from b), r as (select *, max(gap) over (partition by page order by y0, id rows unbounded preceding) cut from g)
select page, id, y0 from r where not cut""")
def w4_until_gap(t):
    return L.until_gap(_blocks(t), 20.0).select("page", "id", "y0")


@query("""with e as (select l_suppkey plot, l_partkey edge from lineitem), k as (select plot, count(*) over (partition by plot order by edge range between current row and 12 following) k from e)
select plot, count(*) as n, max(k) as best from k group by plot""")
def w9_largest_cluster(t):
    return L.largest_cluster(t("lineitem").selectExpr("l_suppkey as plot", "l_partkey as edge"), 12)


@query("""with s as (select c_custkey plot, a angle, case when (c_custkey + (a + 9) // 18) % 4 = 3 then null else 'k' || ((c_custkey + case when a < 27 or a >= 80 then 0 else (a + 9) // 18 end) % 4) end key from customer, range(0, 90) t(a)),
g as (select *, case when row_number() over w > 1 and key is not distinct from lag(key) over w then 0 else 1 end t from s window w as (partition by plot order by angle)),
r as (select *, sum(t) over (partition by plot order by angle) run from g), u as (select plot, run, first(key) key, min(angle) a, max(angle) + 1 b from r where key is not null group by plot, run),
x as (select *, first_value(run) over w fr, last_value(run) over w lr, first_value(key) over w fk, last_value(key) over w lk, first_value(a) over w fa, last_value(b) over w lb, last_value(a) over w la from u window w as (partition by plot order by run rows between unbounded preceding and unbounded following)),
y as (select *, fr < lr and fk = lk and fa = 0 and lb = 90 m from x)
select plot, key, case when m and run = fr then la - 90 else a end as a, b from y where not (m and run = lr) and b - case when m and run = fr then la - 90 else a end >= 4""")
def w10_wedges(t):
    key = "case when (c_custkey + (angle + 9) div 18) % 4 = 3 then null else 'k' || ((c_custkey + case when angle < 27 or angle >= 80 then 0 else (angle + 9) div 18 end) % 4) end"
    return L.wedges(t("customer").select(F.col("c_custkey").alias("plot"), F.expr(f"transform(sequence(0L, 89L), angle -> {key})").alias("keys")), 90)


_SWATCHES = ("l_orderkey as plot", "l_linenumber as swatch", "l_partkey % 300 as cx", "l_suppkey % 60 as cy")
_WORDS = ("l_orderkey as plot", "case l_partkey % 4 when 0 then cast(l_partkey as {s}) || '%' when 1 then 'x' else 'w' || (l_partkey % 90) end as text", "l_suppkey * 7 % 400 as cx", "l_partkey % 60 as cy")


@query(f"""with s as (select distinct {', '.join(_SWATCHES)} from lineitem), w as (select {', '.join(_WORDS).format(s='varchar')} from lineitem),
n as (select s.plot, swatch, text, row_number() over (partition by s.plot, swatch order by w.cx - s.cx + 2 * abs(w.cy - s.cy), text) r from s join w on s.plot = w.plot where w.cx - s.cx between 0 and 200 and abs(w.cy - s.cy) <= 25 and length(text) >= 2 and not regexp_matches(text, '^-?\\d[\\d.,]*%?$'))
select plot, swatch, text as word from n where r = 1""")
def j16_label_swatches(t):
    li = t("lineitem")
    return L.label_swatches(li.selectExpr(*_SWATCHES).distinct(), li.selectExpr(*[c.format(s="string") for c in _WORDS]))


_BOXES = ("l_partkey as page", "l_orderkey * 10 + l_linenumber as id", "cast(l_suppkey % 6 * 20 as double) as x0", "cast(l_orderkey % 5 * 20 as double) as y0", "cast(l_suppkey % 6 * 20 + 40 + l_linenumber * 5 as double) as x1", "cast(l_orderkey % 5 * 20 + 60 as double) as y1")
_IN = "(greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0)))".format(a="a", b="x[1]")


@query(f"""with b as (select {', '.join(_BOXES)} from lineitem), p as (select page, list([{{'id': id, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}] order by (x1 - x0) * (y1 - y0) desc, id, x0, y0, x1, y1) bs from b group by page),
k as (select page, list_reduce(bs, lambda acc, x: case when len(list_filter(acc, lambda a: {_IN} >= 0.5 * ((a.x1 - a.x0) * (a.y1 - a.y0) + (x[1].x1 - x[1].x0) * (x[1].y1 - x[1].y0) - {_IN}))) > 0 then acc else list_concat(acc, x) end) kept from p),
u as (select page, unnest(kept) v from k) select page, v.id as id, v.x0 as x0, v.y0 as y0, v.x1 as x1, v.y1 as y1 from u""")
def j17_suppress_overlaps(t):
    return L.suppress_overlaps(t("lineitem").selectExpr(*_BOXES))
