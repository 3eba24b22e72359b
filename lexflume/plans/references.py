"""Queries over references, citations and mentions of figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexflume.operators import references as R
from lexflume.plans.registry import query


def _ref(k: int) -> str:
    mark = f"case doc_id % 4 when 0 then '- ' when 1 then '{k}. ' when 2 then '' else '[{k}] ' end"
    sur = f"chr(cast(65 + doc_id * {k} % 26 as int)) || 'orton'"
    return f"{mark} || {sur} || ', J., Brown, K. (' || (1990 + doc_id * {k} % 30) || '). ' || trim(translate(substr(text, cast({k - 1} * ceil(length(text) / 6.0) + 1 as int), cast(ceil(length(text) / 6.0) as int)), chr(10) || '[]*|', '     ')) || '. Journal {k}' || case (doc_id + {k}) % 3 when 0 then ', https://doi.org/10.1234/ab' || doc_id else '' end"


_LIST = "'# References' || chr(10) || chr(10) || " + " || case doc_id % 4 when 2 then chr(10) || chr(10) else chr(10) end || ".join(_ref(k) for k in range(1, 7))
_TIDY = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"


@query(rf"""with s as (select doc_id, trim(substr(md, 13), chr(10) || ' ') body from (select doc_id, {_LIST} md from documents)),
g as (select doc_id, regexp_replace(body, '([\].)a-z0-9])\s+(\d{{1,3}})\.\s+([A-Z][a-zA-ZáéíóúñÁÉÍÓÚÑ\-]{{1,40}}[,;\s])', '\1' || chr(10) || '\2. \3', 'g') body from s),
w as (select doc_id, list_filter(list_transform(regexp_split_to_array(chr(10) || body, '\n[-*]\s+')[2:], lambda x: {_TIDY.format('x')}), lambda x: length(x) > 20) b,
 list_filter(list_transform(regexp_extract_all(chr(10) || body, '\n\s*(?:\[\d+\]|\d+\.)\s+[^\n]+'), lambda x: {{'ref_no': regexp_extract(x, '^\s*\[?(\d+)', 1)::int, 'raw': {_TIDY.format(r"regexp_replace(x, '^\s*(?:\[\d+\]|\d+\.)\s+', '')")}}}), lambda e: length(e.raw) > 20) n,
 list_filter(list_transform(regexp_split_to_array(body, '\n\s*\n'), lambda x: {_TIDY.format('x')}), lambda x: length(x) > 30 and regexp_matches(x, '\b(19|20)\d{{2}}\b')) p from g),
best as (select doc_id, case when len(b) >= len(n) and len(b) >= len(p) then 'bullets' when len(n) >= len(p) then 'numbered' else 'paragraphs' end strategy, b, n, p from w),
e as (select doc_id, strategy, case strategy when 'numbered' then list_transform(n, lambda e: e.ref_no) else range(1, greatest(len(b), len(p)) + 1) end nos, case strategy when 'bullets' then b when 'numbered' then list_transform(n, lambda e: e.raw) else p end raws from best),
u as (select doc_id, strategy, unnest(nos)::int ref_no, unnest(raws) raw from e where len(raws) > 0),
t as (select doc_id, strategy, ref_no, trim(regexp_replace(raw, '^[\-*•]\s*|^\[\d+\]\s*|^\d+\.\s*', '')) text from u where raw is not null)
select doc_id, strategy, ref_no, text, nullif(regexp_extract(text, '{R.DOI}', 1), '') as doi,
 coalesce(nullif(regexp_extract(text, '\((\d{{4}})[a-z]?\)', 1), ''), nullif(regexp_extract(text, '(?:^|\D)((?:19|20)\d{{2}})[a-z]?(?:\D|$)', 1), ''))::int as year,
 nullif(regexp_extract(text, '^({R.SURNAME.replace("'", "''")})', 1), '') as first_author,
 array_to_string(regexp_extract_all(substr(text, 1, 300), '({R.SURNAME.replace("'", "''")})(?:,?\s+[A-Z]\.|\s+et\s+al)', 1)[1:5], ';') as co_authors from t""")
def g2_g3_f8_w2_parse_references(t):
    r = R.parse_references(t("documents").select("doc_id", F.expr(_LIST).alias("md")), "doc_id", "md")
    return r.withColumn("co_authors", F.array_join("co_authors", ";"))


#: Citations put into prose; some of references that are not there.
_CITED = "replace(replace(text, '. ', ' [' || (doc_id % 9 + 1) || '-' || (doc_id % 9 + 3) || ', ' || (doc_id % 12) || ']. '), chr(10), ' [2] ')"


@query(rf"""with c as (select doc_id, list_transform(regexp_extract_all(x, '(?:^|[\s(,;])\[(\d+(?:\s*[\-–]\s*\d+)?(?:\s*,\s*\d+(?:\s*[\-–]\s*\d+)?)*)\]', 1), lambda s: s) specs from (select doc_id, {_CITED} x from documents)),
u as (select doc_id as doc, unnest(specs) spec, (generate_subscripts(specs, 1) - 1)::int pos from c),
n as (select doc, pos, spec, flatten(list_transform(regexp_split_to_array(spec, '\s*,\s*'), lambda p: case when contains(p, '-') then range(split_part(p, '-', 1)::int, split_part(p, '-', 2)::int + 1) else [p::int] end)) nums from u),
g as (select doc, sum(len(nums)) total, sum(len(list_filter(nums, lambda k: k <= 8 + doc % 4))) inside from n group by doc)
select n.doc, pos, spec, case when len(list_filter(nums, lambda k: k < 1 or k > 8 + n.doc % 4)) = 0 and total >= 3 and inside >= 0.7 * total then '[' || array_to_string(list_transform(nums, lambda k: '[' || k || '](#ref-' || lpad(k::varchar, 3, '0') || ')'), ', ') || ']' end as linked
from n join g on n.doc = g.doc""")
def j3_link_numeric(t):
    d = t("documents")
    cites = R.numeric_citations(d.select(F.col("doc_id").alias("doc"), F.expr(_CITED).alias("x")), "doc", "x")
    refs = d.select(F.col("doc_id").alias("doc"), F.explode(F.expr("sequence(1, cast(8 + doc_id % 4 as int))")).alias("num"))
    return R.link_numeric(cites, refs)


#: A document per order: its lines are figures, and its text mentions some.
_FIGS = "l_orderkey as doc, 'fig-00' || l_linenumber as fig_id, l_partkey * 1000 + l_suppkey as ord, case l_partkey % 3 when 0 then (l_suppkey % 5) || 'b' when 1 then cast(l_suppkey % 7 as string) end as caption_number, 'Continued from Fig. ' || (l_suppkey % 5) || '; see Figures 2 and 3.' as caption_text"
_FIGS_SQL = f"select distinct {_FIGS.replace(' as string', ' as varchar')} from lineitem"
_BODY = "'We show in Figure ' || (o_custkey % 6) || ' and figs. ' || (o_custkey % 4) || '-' || (o_custkey % 4 + 2) || ' that Fig. 3, 4 and 7 hold.'"
_MENTIONS = """m0 as (select o_orderkey doc, [{'pos': 0, 'matched': 'Figure ' || (o_custkey % 6) || ' and', 'nums': [o_custkey % 6]}] x, o_custkey k from orders),
m as (select doc, 0 pos, k % 6 num from m0 union all select doc, 1, unnest(range(k % 4, k % 4 + 3)) from m0 union all select doc, 2, unnest([3, 4, 7]) from m0)"""
_TARGETS = f"""f as ({_FIGS_SQL}), g as (select *, try_cast(nullif(regexp_extract(caption_number, '^(\\d+)', 1), '') as int) num from f),
a as (select doc, num, max_by(fig_id, {{'o': ord, 'f': fig_id}}) a from g where num is not null group by doc, num),
b as (select doc, nullif(regexp_extract(fig_id, '^fig[-_]?0*(\\d+)', 1), '')::int num, min_by(fig_id, {{'o': ord, 'f': fig_id}}) b from g where coalesce(trim(caption_number), '') = '' group by all)"""
_LINKED = "l as (select m.doc, m.pos, m.num, coalesce(a.a, b.b) fig_id, a.a is null rescued from m left join a on m.doc = a.doc and m.num = a.num left join b on m.doc = b.doc and m.num = b.num where coalesce(a.a, b.b) is not null)"
_CROSSED = """x0 as (select doc, fig_id source, num own, unnest(list_distinct([split_part(split_part(caption_text, 'Fig. ', 2), ';', 1)::int, 2, 3])) num from g),
x as (select distinct x0.doc, source, coalesce(a.a, b.b) fig_id from x0 left join a on x0.doc = a.doc and x0.num = a.num left join b on x0.doc = b.doc and x0.num = b.num where x0.num is distinct from own and coalesce(a.a, b.b) is not null)"""


def _figures(t):
    return t("lineitem").selectExpr(*[f"{c}" for c in ("l_orderkey as doc", "'fig-00' || l_linenumber as fig_id", "l_partkey * 1000 + l_suppkey as ord", "case l_partkey % 3 when 0 then (l_suppkey % 5) || 'b' when 1 then cast(l_suppkey % 7 as string) end as caption_number", "'Continued from Fig. ' || (l_suppkey % 5) || '; see Figures 2 and 3.' as caption_text")]).distinct()


def _found(t):
    return R.mentions(t("orders").select(F.col("o_orderkey").alias("doc"), F.expr(_BODY).alias("body")), "doc", "body")


@query(f"with {_MENTIONS} select doc, pos, num from m")
def g17_find_mentions(t):
    return _found(t).select("doc", "pos", "num")


@query(f"with {_MENTIONS}, {_TARGETS}, {_LINKED} select doc, pos, num, fig_id, rescued from l")
def j5_link_figures(t):
    return R.link_figures(_found(t), _figures(t)).select("doc", "pos", "num", "fig_id", "rescued")


@query(f"with {_TARGETS}, {_CROSSED} select doc, source, fig_id from x")
def j6_cross_captions(t):
    return R.link_captions(_figures(t))


@query(f"""with {_MENTIONS}, {_TARGETS}, {_LINKED}, {_CROSSED}, u as (select doc, fig_id, rescued, false crossed from l union all select doc, fig_id, false, true from x),
n as (select doc, count(*) n_figures from f group by doc), s as (select doc, count(distinct fig_id) n_mentioned, count(*) mentions, count(*) filter (rescued) rescued, count(*) filter (crossed) cross_caption from u group by doc)
select n.doc, n_figures, coalesce(n_mentioned, 0) as n_mentioned, coalesce(mentions, 0) as mentions, coalesce(rescued, 0) as rescued, coalesce(cross_caption, 0) as cross_caption from n left join s on n.doc = s.doc""")
def k10_mention_summary(t):
    f = _figures(t)
    return R.mention_summary(R.link_figures(_found(t), f), R.link_captions(f), f)


_REFS = ("l_orderkey * 10 + l_linenumber as ref", "case l_partkey % 3 when 0 then '10.1/' || l_partkey when 1 then '10.9/' || l_partkey end as doi", "case l_suppkey % 4 when 0 then 'Wool' when 1 then 'cold widget of brand ' || (l_partkey % 40) when 2 then 'Entirely different heading about clouds ' || l_suppkey end as title")
_BOOKS = ("'10.1/' || p_partkey as doi", "p_name || ' of brand ' || (p_partkey % 40) as title")
_KEY = r"trim(regexp_replace(lower(regexp_replace({}, '[^a-zA-Z0-9 ]', ' ', 'g')), '\s+', ' ', 'g'))"
_BAG = "list_distinct(list_filter(string_split(" + _KEY.format("{}") + ", ' '), lambda w: w <> ''))"


@query(f"""with r as (select {', '.join(_REFS)} from lineitem), b as (select {', '.join(_BOOKS)} from part), d as (select doi, min(title) t1 from b group by doi), k as (select {_KEY.format('title')} k, min(title) t2 from b group by 1),
j as (select r.*, t1, t2, coalesce(t1, t2) t from r left join d on r.doi = d.doi left join k on {_KEY.format('r.title')} = k.k),
s as (select *, case when len({_BAG.format('title')}) > 0 and len({_BAG.format('t')}) > 0 then round(len(list_intersect({_BAG.format('title')}, {_BAG.format('t')})) / len(list_distinct(list_concat({_BAG.format('title')}, {_BAG.format('t')}))), 3) else 0.0 end sc from j)
select ref, case when t1 is not null and length(coalesce(title, '')) < 15 then 'verified' when t is not null then case when sc >= 0.4 then 'verified' else 'mismatch' end when doi is null and title is null then 'skipped' else 'not_found' end as verdict,
case when t1 is not null then 'doi' when t2 is not null then 'title' end as source, case when t1 is not null and length(coalesce(title, '')) < 15 then 0.5 when t is not null then sc else 0.0 end as score from s""")
def j11_verify_references(t):
    return R.verify(t("lineitem").selectExpr(*_REFS), t("part").selectExpr(*_BOOKS))


_OURS = ("o_custkey as doc", "cast(o_orderkey % 30 as {s}) as ref", "'Raw ref, no. ' || (o_orderkey % 50) as raw", "case when o_orderkey % 4 = 0 then '10.5/' || o_orderkey end as doi", "case when o_orderkey % 3 = 0 then 2000 end as year")
_THEIRS = ("o_custkey as doc", "o_orderkey as ord", "case when o_orderkey % 2 = 0 then ' ' || (o_orderkey % 20) end as marker", "'RAW REF no ' || (o_orderkey % 40) as raw", "'10.7/' || o_orderkey as doi", "cast(1950 + o_orderkey % 60 as int) as year")


@query(f"""with r as (select {', '.join(_OURS).format(s='varchar')} from orders), f as (select {', '.join(_THEIRS)} from orders), p as (select *, regexp_replace(lower(raw), '[^a-z0-9]', '', 'g') k from f),
m as (select doc, trim(marker) ref, max_by(doi, ord) d, max_by(year, ord) y from f where marker is not null group by 1, 2), b as (select doc, k, min_by(doi, ord) d, min_by(year, ord) y from p group by doc, k)
select r.doc, r.ref, coalesce(r.doi, case when m.doc is not null then m.d else b.d end) as doi, coalesce(r.year, case when m.doc is not null then m.y else b.y end) as year, case when m.doc is not null then 'marker' when b.doc is not null then 'prefix' end as how
from r left join m on r.doc = m.doc and r.ref = m.ref left join b on r.doc = b.doc and regexp_replace(lower(r.raw), '[^a-z0-9]', '', 'g') = b.k""")
def j10_enrich_references(t):
    o = t("orders")
    return R.enrich(o.selectExpr(*[c.format(s="string") for c in _OURS]), o.selectExpr(*_THEIRS))
