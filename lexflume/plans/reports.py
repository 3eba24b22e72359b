"""Queries over papers as a whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexflume.operators import reports as P
from lexflume.plans.registry import query

_PAPERS = ("c_custkey as slug", "c_custkey * 7 % 300 as md_words", "c_custkey * 11 % 310 as raw_words", "case when c_custkey % 5 > 0 then c_name else '' end as title", "case when c_custkey % 3 = 0 then '10.1/' || c_custkey end as doi", "c_custkey % 4 as n_references", "c_custkey % 6 as n_figures", "c_custkey % 2 as n_authors")


@query(f"""with p as (select *, round(md_words / greatest(raw_words, 1), 3) coverage, coalesce(length(title) > 0, false)::int + coalesce(length(doi) > 0, false)::int + (n_references > 0)::int + (n_figures > 0)::int + (n_authors > 0)::int structure from (select {', '.join(_PAPERS)} from customer))
select slug, coverage, structure, case when structure >= 4 and coverage between 0.6 and 1.3 then 'high' when structure >= 2 then 'medium' else 'low' end as confidence from p""")
def k2_paper_stats(t):
    return P.paper_stats(t("customer").selectExpr(*_PAPERS)).select("slug", "coverage", "structure", "confidence")


_ISSUES = ("c_custkey as slug", "c_custkey % 7 > 0 as has_text", "c_custkey % 130 / 100.0D as coverage", "c_custkey % 5 as pages", "c_custkey % 4 as figures", "c_custkey % 3 as captioned", "c_custkey % 6 as refs")


@query(f"""select slug, array_to_string(list_filter([case when not has_text then 'missing paper.md' end, case when coverage > 0 and coverage < 0.85 then 'low coverage ' || printf('%.2f', coverage) end, case when figures = 0 and pages > 2 then 'no figures detected' end,
case when captioned < figures then (figures - captioned) || ' fig(s) w/o caption' end, case when refs = 0 and pages > 2 then 'no references parsed' end], lambda x: x is not null), '; ') as issues from (select {', '.join(_ISSUES).replace('100.0D', '100.0')} from customer)""")
def k3_issues(t):
    c = t("customer").selectExpr(*_ISSUES)
    return c.select("slug", F.array_join(P.issues(*[F.col(x) for x in ("has_text", "coverage", "pages", "figures", "captioned", "refs")]), "; ").alias("issues"))


_CAPTIONS = ("l_orderkey as doc", "l_partkey * 10 + l_linenumber as ord", "case l_partkey % 3 when 0 then ' ' || (l_suppkey % 4) else (l_suppkey % 4) || '.' || (l_suppkey % 3) end as number", "case l_partkey % 4 when 0 then 'Figure 3a: ' when 1 then 'FIG. 12 — ' when 2 then 'Fig 2 ' else '' end || case when l_suppkey % 9 > 0 then 'Rate   of ' || l_partkey || chr(10) || ' parts' else '' end as text")


@query(rf"""with c as (select doc, ord, trim(number) number, trim(regexp_replace(regexp_replace(text, '(?i)^\s*(?:Figure|Fig\.?)\s+\d+[A-Za-z]?\s*[.:\-—)]?\s*', ''), '\s+', ' ', 'g')) text from (select {', '.join(_CAPTIONS)} from lineitem)),
k as (select doc, ord, unnest(list_distinct([number, regexp_extract(number, '^(\d+)', 1)])) number, text from c where text <> '')
select doc, number, string_agg(text, ' / ' order by ord, text) as text from k group by doc, number""")
def a15_captions_by_number(t):
    return P.captions_by_number(t("lineitem").selectExpr(*_CAPTIONS))


_GRAMS = "list_distinct(list_transform(range(1, greatest(length({0}) - 2, 1)), lambda i: substr(lower({0}), i, 4)))"


@query(f"""with s as (select distinct p_name slug from part), f as (select distinct p_type || ' ' || p_name || ' ' || p_brand file from part),
a as (select slug, unnest({_GRAMS.format('slug')}) g from s), b as (select file, unnest({_GRAMS.format('file')}) g from f),
n as (select slug, file, count(*) overlap from a join b using (g) group by slug, file having count(*) >= 4), r as (select *, row_number() over (partition by slug order by overlap desc, file) k from n)
select s.slug, r.file, r.overlap from s left join r on s.slug = r.slug and k = 1""")
def j9_a16_resolve_names(t):
    p = t("part")
    return P.resolve_names(p.select(F.col("p_name").alias("slug")).distinct(), p.selectExpr("p_type || ' ' || p_name || ' ' || p_brand as file").distinct())


_DIAGRAM = "case o_orderkey % 5 when 0 then 'Sure:' || chr(10) || '```mermaid' || chr(10) when 1 then 'text' else '' end || case o_orderkey % 7 when 6 then 'pie' else 'flowchart LR' end || chr(10) || case o_orderkey % 4 when 3 then '' else 'A[Start] ' end || case when o_orderkey % 11 = 0 then '' else case o_orderkey % 3 when 0 then '-->|yes| B' when 1 then '--> B[End]' else chr(10) || 'C --> D' || chr(10) || 'A --> E' end end || chr(10) || '```'"


@query(rf"""with t as (select o_orderkey, {_DIAGRAM} t from orders), s as (select o_orderkey, case when regexp_matches(t, '(?is)```\s*mermaid\s*\n(.*?)```') then trim(regexp_extract(t, '(?is)```\s*mermaid\s*\n(.*?)```', 1)) when regexp_matches(t, '{P.BARE_GRAPH}') then trim(t) end s from t),
e as (select *, list_distinct(regexp_extract_all(s, '{P.NODE}', 1)) ids, regexp_extract_all(s, '{P.EDGE}', 1) f, regexp_extract_all(s, '{P.EDGE}', 3) g from s), u as (select *, list_distinct(list_concat(f, g)) ends from e)
select o_orderkey, coalesce(len(ids), 0)::int as nodes, coalesce(len(f), 0)::int as edges, case when s is null then 'no diagram' when not regexp_matches(s, '{P.GRAPH}') then 'no header' when len(ids) = 0 then 'no nodes' when len(f) = 0 then 'no edges'
when 2 * len(list_filter(ends, lambda x: not list_contains(ids, x))) > len(ends) then 'undefined nodes' else 'ok' end as verdict from u""")
def g25_u5_diagram_verdict(t):
    return P.diagram_verdict(t("orders").select("o_orderkey", F.expr(_DIAGRAM).alias("t")), "t").drop("t")


_SOURCE = "case event_id % 5 when 0 then 'teacher' when 1 then 'caption_only' when 2 then 'none' else 'student' end"


@query(f"""select event_type, count(*) as n_total, count(*) filter (s = 'student') as student, count(*) filter (s = 'teacher') as teacher, count(*) filter (s = 'caption_only') as caption_only, count(*) filter (s = 'none') as empty,
coalesce(sum(case when s = 'teacher' then event_id % 60 end), 0)::bigint as teacher_seconds, round(100.0 * count(*) filter (s = 'student') / count(*), 1) as saved_pct from (select *, {_SOURCE} s from events) group by event_type""")
def k12_distillation(t):
    e = t("events").select("event_type", F.expr(_SOURCE).alias("source"), (F.col("event_id") % 60).alias("seconds"))
    return P.distillation(e, "event_type")


@query("""select doc_id, concat_ws(chr(10) || chr(10), case when t <> '' then '# ' || t end, case when doc_id % 3 > 0 then '*' || case doc_id % 3 when 1 then 'Ada' else 'Ada, Bo' end || '*' end,
nullif(concat_ws(' · ', case when doc_id % 2 = 0 then '2020' end, case when doc_id % 4 > 1 then source end, case when doc_id % 5 = 0 then 'DOI: 10.1/' || doc_id end), ''), case when doc_id % 7 > 0 then '## Abstract' || chr(10) || chr(10) || 'On ' || lang end, nullif(text, '')) as text
from (select *, case when doc_id % 6 > 0 then 'Title ' || doc_id else '' end t from documents)""")
def b2_front_page(t):
    e = F.expr
    page = P.front_page(
        e("case when doc_id % 6 > 0 then 'Title ' || doc_id else '' end"),
        e("slice(array('Ada', 'Bo'), 1, cast(doc_id % 3 as int))"),
        e("case when doc_id % 2 = 0 then 2020 end"),
        e("case when doc_id % 4 > 1 then source end"),
        e("case when doc_id % 5 = 0 then '10.1/' || doc_id end"),
        e("case when doc_id % 7 > 0 then 'On ' || lang end"),
        F.col("text"),
    )
    return t("documents").select("doc_id", page.alias("text"))


_STATS = ("case when o_orderkey % 50 = 0 then '_' else '' end || o_orderkey as slug", "o_orderkey % 5 as n_pages", "case when o_orderkey % 3 = 0 then '' else o_orderpriority end as title")
_RECORDS = ("cast(p_partkey * 2 as {s}) as slug", "cast(p_size as bigint) as n_pages", "p_name as title")


@query(f"""select slug, coalesce(nullif(s.n_pages, 0), p.n_pages, 0) as n_pages, coalesce(nullif(s.title, ''), p.title, '') as title
from (select {', '.join(_STATS)} from orders) s full join (select {', '.join(_RECORDS).format(s='varchar')} from part) p using (slug) where not starts_with(slug, '_')""")
def a17_collect_papers(t):
    return P.collect_papers(t("orders").selectExpr(*_STATS), t("part").selectExpr(*[c.format(s="string") for c in _RECORDS]))
