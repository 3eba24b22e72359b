"""Queries over charts, diagrams' edges, citations, references and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexflume.operators import charts as X
from lexflume.operators import citations as Z
from lexflume.operators import policies
from lexflume.plans.registry import query


@query("""with recursive s as (select user_id page, value::double v, row_number() over (partition by user_id order by value, event_id) n from events),
r as (select page, n, v, v as total, 1 as k, 0 as g from s where n = 1 union all
 select s.page, s.n, s.v, case when abs(s.v - r.total / r.k) <= 1.5 then r.total + s.v else s.v end, case when abs(s.v - r.total / r.k) <= 1.5 then r.k + 1 else 1 end, case when abs(s.v - r.total / r.k) <= 1.5 then r.g else r.g + 1 end from r join s on s.page = r.page and s.n = r.n + 1)
select page, count(*) as n, max(g) + 1 as clusters, max(c) as largest from (select page, g, count(*) over (partition by page, g) c from r) group by page""")
def w11_clusters(t):
    e = t("events").groupBy(F.col("user_id").alias("page")).agg(F.array_sort(F.collect_list(F.col("value").cast("double"))).alias("v"))
    c = e.select("page", F.explode(X.clustered(F.col("v"), 1.5)).alias("g")).groupBy("page", "g").agg(F.count(F.lit(1)).alias("c"))
    return c.groupBy("page").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("clusters"), F.max("c").alias("largest"))


_TICKS = "l_orderkey as chart, case when l_suppkey % 2 = 0 then 'x' else 'y' end as axis, cast(l_partkey % 2 as int) as band, cast(l_quantity * 7 as double) as pixel, cast(case when l_suppkey % 2 = 0 then l_quantity * 2 else 100 - l_quantity end + (l_suppkey % 7) / cast(7 as double) as double) * cast(1.234567 as double) as value"


@query(f"""with g as (select chart, axis, band, regr_slope(value, pixel) slope, regr_intercept(value, pixel) intercept, regr_r2(value, pixel) r2, count(*) n from (select {_TICKS} from lineitem) group by all)
select chart, axis, band, round(slope, 5) as slope, round(intercept, 5) + 0.0 as intercept, round(r2, 5) as r2, n from g where n >= 3 and r2 >= 0.95 and case when axis = 'x' then slope > 0 else slope < 0 end""")
def g23_axis_bands(t):
    b = X.axis_bands(t("lineitem").selectExpr(*_items(_TICKS))).where("n >= 3")
    return b.select("chart", "axis", "band", F.round("slope", 5).alias("slope"), (F.round("intercept", 5) + 0.0).alias("intercept"), F.round("r2", 5).alias("r2"), "n")


@query()
def g23_fit_axes(t):
    a = X.fit_axes(t("lineitem").selectExpr(*_items(_TICKS)))
    return a.select("chart", "axis", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"), F.round("r2", 6).alias("r2"), "n")


def _items(select: str) -> list[str]:
    """The expressions of a select list; commas within parentheses don't part them."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(select):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(select[last:i])
            last = i + 1
    return [*out, select[last:]]


_BOXES = "l_orderkey as chart, cast(l_partkey % 380 as int) as x, cast(l_suppkey % 60 as int) as y, cast(2 + l_partkey % 40 as int) as w, cast(10 + l_quantity * 4 as int) as h, cast((2 + l_partkey % 40) * (10 + l_quantity * 4) * (0.4 + (l_suppkey % 6) / 10.0) as int) as area"
_BAR = "area >= 0.001 * 400 * 300 and w >= 3 and h >= 3 and h / w >= 0.3 and h >= 0.05 * 300 and w <= 0.5 * 400 and area / (w * h) >= 0.55"


@query(f"""with b as (select * from (select {_BOXES} from lineitem) where {_BAR}), a as (select chart, x, y, w, h, case when chart % 50 = 0 then 0.0 else -0.25 end::double slope, (50.0 + chart % 5)::double intercept from b),
k as (select *, count(*) over (partition by chart order by y + h range between current row and 15 following) k, count(*) over (partition by chart) n from a), m as (select *, max(k) over (partition by chart) most from k),
v as (select *, case when slope = 0 then 'no_axis' when n >= 2 and most >= greatest(2, floor(0.75 * n)) then 'ok' else 'no_bars' end status from m)
select chart, floor(x + w / 2)::bigint as x, case when status = 'ok' then round(case when abs(y + h + intercept / slope) <= 15 then y * slope + intercept else (y * slope + intercept) - ((y + h) * slope + intercept) end, 3) end as value, status from v""")
def x1_x2_bar_values(t):
    b = X.bar_boxes(t("lineitem").selectExpr(*_items(_BOXES)), 400.0, 300.0)
    a = t("orders").selectExpr("o_orderkey as chart", "cast(case when o_orderkey % 50 = 0 then 0.0 else -0.25 end as double) as slope", "cast(50.0 + o_orderkey % 5 as double) as intercept")
    return X.bar_values(b.select("chart", "x", "y", "w", "h"), a, 300.0)


_SPOTS = "user_id as chart, cast(event_id * 37 % 600 as double) as x, cast(1 + event_id % 40 as int) as w, cast(1 + event_id % 13 as int) as h, cast(event_id % 90 as int) as area"


@query(f"""with m as (select * from (select {_SPOTS} from events) where area >= 4 and area <= 0.01 * 600 * 400 and greatest(w, h) <= 30 and greatest(w, h) / greatest(1, least(w, h)) <= 2.5),
r as (select chart, min(x) lo, max(x) hi, count(*) n from m group by chart), b as (select m.chart, n, greatest(10, floor((hi - lo) / 6)) bins, floor((x - lo) / nullif(hi - lo, 0) * greatest(10, floor((hi - lo) / 6))) b from m join r on m.chart = r.chart),
f as (select chart, n, bins, count(distinct b) k from b group by all) select chart, n, case when n < 3 then 'too few' when k > 0 and n / k < 1.5 and k > 0.7 * bins then 'line' else 'scatter' end as status from f""")
def x6_scatter_or_line(t):
    return X.line_like(X.markers(t("events").selectExpr(*_items(_SPOTS)), 600.0, 400.0))


_HUES = "user_id % 20 as chart, cast(event_id % 9 as int) as hue, cast(event_id * 37 % 600 as double) as x"


@query(f"""with s as (select chart, hue, count(*) n, max(x) - min(x) w from (select {_HUES} from events) group by all having count(*) >= 60 and max(x) - min(x) >= 240)
select chart, hue, n, place from (select chart, hue, n, row_number() over (partition by chart order by n desc, hue)::int place from s) where place <= 6""")
def x7_line_series(t):
    return X.line_series(t("events").selectExpr(*_items(_HUES)), 600.0)


_PIX = "user_id as fig, event_id % 5 as edge, cast(event_id * 37 % 40 as int) as x, cast(event_id * 53 % 33 as int) as y"
_ENDS = f"""p as (select {_PIX} from events), g as (select fig, edge, arg_min({{'x': x, 'y': y}}, x * 100 + y) a, arg_max({{'x': x, 'y': y}}, x * 100 + y) b, arg_min({{'x': x, 'y': y}}, y * 100 + x) c, arg_max({{'x': x, 'y': y}}, y * 100 + x) d from p group by all),
u as (select fig, edge, unnest([{{'i': 0, 'p': a, 'q': b}}, {{'i': 1, 'p': a, 'q': c}}, {{'i': 2, 'p': a, 'q': d}}, {{'i': 3, 'p': b, 'q': c}}, {{'i': 4, 'p': b, 'q': d}}, {{'i': 5, 'p': c, 'q': d}}]) e from g),
ends as (select fig, edge, e.p.x x1, e.p.y y1, e.q.x x2, e.q.y y2 from (select *, row_number() over (partition by fig, edge order by (e.p.x - e.q.x) ** 2 + (e.p.y - e.q.y) ** 2 desc, e.i) n from u) where n = 1)"""


@query(f"with {_ENDS} select * from ends")
def r5_far_ends(t):
    return X.far_ends(t("events").selectExpr(*_items(_PIX)))


def _near(k: int) -> str:
    w = f"filter (abs(x - x{k}) <= 14 and abs(y - y{k}) <= 14)"
    return f"count(*) {w} n{k}, var_pop(x) {w} xx{k}, var_pop(y) {w} yy{k}, covar_pop(x, y) {w} xy{k}"


def _spread(k: int) -> str:
    return f"case when n{k} < 6 then 0 else sqrt(greatest(0, (xx{k} + yy{k}) / 2 - sqrt(greatest(0, ((xx{k} + yy{k}) / 2) ** 2 - (xx{k} * yy{k} - xy{k} * xy{k}))))) end"


@query(f"""with {_ENDS}, j as (select fig, edge, {_near(1)}, {_near(2)} from p join ends using (fig, edge) group by all), s as (select *, {_spread(1)} s1, {_spread(2)} s2 from j)
select fig, edge, case when n1 < 6 and n2 < 6 then 0 when greatest(s1, s2) > 0.6 and abs(s1 - s2) / greatest(s1, s2) >= 0.35 then case when s1 > s2 then 1 else 2 end when abs(n1 - n2) / greatest(n1, n2) >= 0.25 then case when n1 > n2 then 1 else 2 end else 0 end as head from s""")
def r6_arrowheads(t):
    p = t("events").selectExpr(*_items(_PIX))
    return X.arrowheads(p, X.far_ends(p))


_CITED = "replace(replace(text, ' the ', ' the (Smith et al., 2020; de Jones 2019a) and van Brown (2018) in [3-5, 7] or (12) '), ' de ', ' Ruiz & Díaz (2001), (OECD, 2023[6]) ')"


@query(f"""with d as (select doc_id doc, {_CITED} x from documents), c as (select doc, unnest([{', '.join(f"{{'style': '{s}', 'all': regexp_extract_all(x, '{p.replace(chr(39), chr(39) * 2)}', 1)}}" for s, p in Z.STYLES.items())}]) c from d),
u as (select doc, c.style style, unnest(c.all) cite, generate_subscripts(c.all, 1) - 1 pos from c) select doc, style, pos, cite from u""")
def g19_citations(t):
    return Z.citations(t("documents").select(F.col("doc_id").alias("doc"), F.expr(_CITED).alias("text")))


_REFS = "select doc_id doc, 'Brown' surname, 2018 as year, doc_id % 9 + 1 as ref_no from documents where doc_id % 2 = 0 union all select doc_id, 'RUIZ', 2001, doc_id % 7 + 2 from documents where doc_id % 3 = 0"


@query(rf"""with d as (select doc_id doc, {_CITED} x from documents), c as (select doc, regexp_extract_all(x, '{Z.PROSE.replace("'", "''")}', 1) a from d), u as (select doc, unnest(a) cite, generate_subscripts(a, 1) - 1 pos from c),
s as (select *, regexp_extract(cite, '({Z.SURNAME.replace("'", "''")})', 1) surname, regexp_extract(cite, '\(([0-9]{{4}})[a-z]?\)$', 1)::int yr from u), r as (select doc, lower(surname) s, year y, min(ref_no) ref_no from ({_REFS}) group by all)
select s.doc, pos, cite, case when ref_no is null then cite else '[' || cite || '](#ref-' || lpad(ref_no::varchar, 3, '0') || ')' end as linked from s left join r on s.doc = r.doc and lower(surname) = r.s and yr = r.y""")
def j2_j4_link_prose(t):
    d = t("documents")
    cites = Z.citations(d.select(F.col("doc_id").alias("doc"), F.expr(_CITED).alias("text"))).where("style = 'prose'").select("doc", "pos", "cite")
    ref = lambda where, name, year, no: d.where(where).selectExpr("doc_id as doc", f"'{name}' as surname", f"cast({year} as bigint) as year", f"{no} as ref_no")
    refs = ref("doc_id % 2 = 0", "Brown", 2018, "doc_id % 9 + 1").unionByName(ref("doc_id % 3 = 0", "RUIZ", 2001, "doc_id % 7 + 2"))
    return Z.link_prose(cites, refs).select("doc", "pos", "cite", "linked")


_SPEC = "case event_id % 5 when 0 then (event_id % 30) || '-' || (event_id % 90) when 1 then (event_id % 9) || ', ' || (event_id % 7) when 2 then '3 – 6,9' when 3 then 'x' else event_id || '' end"


@query(rf"""with s as (select event_id, {_SPEC} s from events), p as (select event_id, unnest(regexp_split_to_array(s, '\s*,\s*')) p, generate_subscripts(regexp_split_to_array(s, '\s*,\s*'), 1) i from s),
n as (select event_id, i, case when regexp_matches(p, '^[0-9]+\s*[-–]') then case when regexp_extract(p, '[-–]\s*([0-9]+)', 1)::int - regexp_extract(p, '^([0-9]+)', 1)::int between 1 and 49 then range(regexp_extract(p, '^([0-9]+)', 1)::int, regexp_extract(p, '[-–]\s*([0-9]+)', 1)::int + 1) else [] end when try_cast(p as int) is null then [] else [p::int] end l from p)
select event_id, array_to_string(flatten(list(l order by i)), ',') as numbers from n group by event_id""")
def g18_numeric_ranges(t):
    return t("events").select("event_id", F.array_join(Z.numbers_of(F.expr(_SPEC)), ",").alias("numbers"))


_LIST = "o_custkey as doc, o_orderkey as ref_no, 'Ref ' || o_orderkey || case o_orderkey % 5 when 0 then ' https://doi.org/10.1/x' else '' end as text, case o_orderkey % 2 when 0 then '10.1/x' || o_orderkey else '' end as doi, case when o_orderkey % 4 > 0 then '⟦' || (o_orderkey % 4) || '/9⟧' end as marker"


@query(f"""with r as (select {_LIST} from orders), l as (select *, case when marker is not null and row_number() over (partition by doc, marker order by ref_no) = 1 then chr(10) || marker || chr(10) || chr(10) else '' end || '- <a id="ref-' || lpad(ref_no::varchar, 3, '0') || '"></a>' || text || case when doi <> '' and not contains(text, 'doi.org') then ' [doi:' || doi || '](https://doi.org/' || doi || ')' else '' end l from r)
select doc, chr(10) || chr(10) || '---' || chr(10) || chr(10) || '## References' || chr(10) || chr(10) || string_agg(l, chr(10) order by ref_no) || chr(10) as md from l group by doc""".replace("lpad(ref_no::varchar, 3, '0')", "case when length(ref_no::varchar) > 3 then substr(ref_no::varchar, 1, 3) else lpad(ref_no::varchar, 3, '0') end"))
def b3_references_section(t):
    return Z.references_section(t("orders").selectExpr(*_items(_LIST)))


@query("""with f as (select o_custkey doc, 'f' || (o_orderkey % 6) || '.png' b, min('fig-' || o_orderkey) fig from orders group by all), p as (select distinct o_custkey doc, 'images/f' || (o_orderkey % 9) || '.png' path from orders)
select p.doc, path, fig from p left join f on p.doc = f.doc and substr(path, 8) = b""")
def j18_figures_of_paths(t):
    o = t("orders")
    figures = o.selectExpr("o_custkey as doc", "'fig-' || o_orderkey as fig", "'out/x/f' || (o_orderkey % 6) || '.png' as file")
    return Z.figures_of_paths(o.selectExpr("o_custkey as doc", "'images/f' || (o_orderkey % 9) || '.png' as path").distinct(), figures)


_MD = "replace(replace(text, '. ', '. ![](tmp/a.png) ! '), ', ', ', ![](b.png)![](c.png) ')"


@query("select doc_id, replace(replace(text, '. ', '. ![](./figs/1.png) ! '), ', ', ', ![An alt](./figs/2.png) ') as md from documents")
def j12_c14_remap_images(t):
    names = F.create_map(F.lit("a.png"), F.lit("figs/1.png"), F.lit("b.png"), F.lit("figs/2.png|An alt"))
    return t("documents").select("doc_id", Z.remapped_images(F.expr(_MD), names).alias("md"))


@query(r"""with s as (select doc_id, trim(regexp_replace(lower(regexp_replace(regexp_replace(strip_accents(replace(text, 'ß', '')), '[^\x00-\x7f]', '', 'g'), '[^0-9A-Za-z_\s-]', '', 'g')), '^\s+|\s+$', '', 'g')) s from documents), d as (select doc_id, regexp_replace(substr(regexp_replace(s, '[\s_-]+', '-', 'g'), 1, 60), '-+$', '') s from s)
select doc_id, case when s = '' then 'paper' else s end as slug from d""")
def c15_slugs(t):
    return t("documents").select("doc_id", Z.slug(F.col("text")).alias("slug"))


@query("""with x as (select doc_id, replace(text, 'ﬁ', 'fi') t from documents), c as (select doc_id, length(t) n, 3 * (length(t) - length(replace(t, '­', ''))) + len(regexp_extract_all(t, '[^\\p{L}\\p{N}_\\s.,;:?!()\\-—"''/°%$]{3,}')) + len(list_filter(regexp_extract_all(t, '[\\p{L}\\p{N}_]+'), lambda w: regexp_full_match(w, '[b-zB-HJ-Z]'))) bad from x)
select doc_id, case when n < 20 then 'skip' when bad / n > 0.04 then 'replace' when bad / n > 0.015 then 'validate' else 'skip' end as decision from c""")
def p15_paragraph_policy(t):
    return t("documents").select("doc_id", policies.for_paragraph(F.expr("replace(text, 'ﬁ', 'fi')"))["decision"].alias("decision"))


_SOFT = "replace(replace(text, 'th', 't­h'), chr(10), repeat(chr(10), 5))"


@query(r"select doc_id, trim(regexp_replace(replace(text, chr(10), repeat(chr(10), 5)), '\n{3,}', chr(10) || chr(10), 'g'), chr(10)) as text from documents")
def c13_postprocess(t):
    d = Z.postprocessed(t("documents").select("doc_id", F.expr(_SOFT.replace("chr(10)", "'\\n'")).alias("text")), "doc_id", "text")
    return d.select("doc_id", F.regexp_replace("text", "^\n+|\n+$", "").alias("text"))
