"""Queries over markdown: paragraphs, boilerplate, tables, running lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexflume.operators import markdown as M
from lexflume.plans.registry import query

#: Tables made from prose, for both engines.
MD = "replace(replace(replace(replace(text, '. ', chr(10) || '| '), ' s', ' | '), ' w', '|' || chr(10) || '|---|:-:|' || chr(10) || '| '), ' t', '<br>')"
_LINES = f"select doc_id, unnest(string_split({MD}, chr(10))) line, generate_subscripts(string_split({MD}, chr(10)), 1) pos from documents"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_CELLS = "list_transform(string_split(regexp_extract(" + _STRIP.format("{}") + r", '(?s)^\|(.*?)\|?$', 1), '|'), lambda c: " + _STRIP.format("c") + ")"
_BLOCKS = f"""l as (select *, regexp_matches(line, '^\\s*\\|') t from ({_LINES})),
m as (select *, case when t is distinct from lag(t) over (partition by doc_id order by pos) then 1 else 0 end turn from l),
n as (select *, sum(turn) over (partition by doc_id order by pos) as block from m),
b as (select doc_id, block, first(t) t, list(line order by pos) ls from n group by doc_id, block)"""
_SEP = "'^(-{2,}|:?-+:?)$'"
_TOGETHER = "select d.doc_id, coalesce(array_to_string(x.ls, chr(10)), '') as text from documents d left join (select doc_id, flatten(list(ls order by block)) ls from z group by doc_id) x using (doc_id)"


def _md(t):
    return t("documents").select("doc_id", F.expr(MD).alias("md"))


@query(f"""with {_BLOCKS} select doc_id, block::bigint as block, t as is_table, len(ls)::bigint as n_lines, array_to_string(list_transform(ls, lambda x: len({_CELLS.format('x')})), ',') as widths from b""")
def d1_d3_blocks(t):
    b = M.blocks(_md(t), "doc_id", "md")
    return b.select("doc_id", "block", "is_table", F.size("lines").cast("long").alias("n_lines"), F.array_join(F.transform("lines", lambda x: F.size(M.cells(x)).cast("string")), ",").alias("widths"))


_JUNK = f"""r as (select *, list_filter(list_transform(ls, lambda x: {_CELLS.format('x')}), lambda r: len(list_filter(r, lambda c: c <> '' and not regexp_matches(c, {_SEP}))) > 0) data from b),
s as (select *, list_filter(flatten(data), lambda c: c <> '') full_cells from r),
u as (select *, list_transform(full_cells, lambda c: length(c)) sizes, lower(array_to_string(full_cells, ' ')) body from s),
y as (select *, coalesce(len(ls) < 2 or len(data) = 0 or list_max(list_transform(data, lambda r: len(r))) < 2 or ({' + '.join(f"contains(body, '{w}')::int" for w in M.BANNER)}) >= 2
 or list_sum(sizes) > 250 * len(full_cells) or list_max(sizes) > 0.8 * list_sum(sizes), true) junk from u)"""


@query(f"with {_BLOCKS}, {_JUNK} select doc_id, block::bigint as block, junk from y where t")
def d7_junk_tables(t):
    return M.junk_tables(M.blocks(_md(t), "doc_id", "md").where("is_table")).select("doc_id", "block", "junk")


@query(f"with {_BLOCKS}, {_JUNK}, z as (select doc_id, block, ls from y where not (t and junk)) {_TOGETHER}")
def d8_remove_junk_tables(t):
    return M.remove_junk_tables(_md(t), "doc_id", "md")


_ROW = r"'| ' || array_to_string(list_transform(r, lambda c: replace(replace(c, '|', '\|'), chr(10), ' ')), ' | ') || ' |'"
_EXPAND = f"""flatten(list_transform({{}}, lambda row: list_transform(range(0, list_max(list_transform(row, lambda c: len(regexp_split_to_array(c, '(?i)<br\\s*/?>'))))::bigint),
 lambda k: list_transform(row, lambda c: coalesce({_STRIP.format("regexp_split_to_array(c, '(?i)<br\\s*/?>')[k + 1]")}, '')))))"""


@query(f"""with {_BLOCKS}, p as (select *, list_transform(ls, lambda x: {_CELLS.format('x')}) rs from b),
q as (select *, list_max(list_transform(rs, lambda r: len(r)))::bigint width, coalesce(list_position(list_transform(rs, lambda r: len(list_filter(r, lambda c: c <> '')) > 0 and len(list_filter(r, lambda c: c <> '' and not regexp_matches(c, {_SEP}))) = 0), true), 0) sep from p),
v as (select *, list_transform(rs, lambda r: list_resize(r, width, '')) padded, greatest(sep, 1) pos from q),
h as (select *, case when pos > 1 then {_EXPAND.format('padded[1:pos - 1]')} else [list_transform(range(0, width), lambda i: '')] end head, {_EXPAND.format('padded[pos + 1:]')} body from v),
z as (select doc_id, block, case when t and len(list_filter(ls, lambda x: contains(x, '<br'))) > 0 and len(ls) >= 2 then
 list_concat(list_transform(head, lambda r: {_ROW}), ['| ' || array_to_string(list_transform(range(0, width), lambda i: '---'), ' | ') || ' |'], list_transform(body, lambda r: {_ROW})) else ls end ls from h) {_TOGETHER}""")
def d2_d4_reshape_breaks(t):
    return M.reshape_break_tables(_md(t), "doc_id", "md")


#: Banner lines put between the lines of documents.
BANNERS = "replace(replace(replace(text, '. ', chr(10) || 'Page 3 of 17' || chr(10)), ' und ', chr(10) || '© 2020 The Authors' || chr(10)), ' and ', chr(10) || 'Received 12 May 2020' || chr(10))"


@query(f"select doc_id, array_to_string(list_filter(string_split({BANNERS}, chr(10)), lambda x: not (" + " or ".join(f"regexp_matches(x, '{p}')" for p in (q.replace("'", "''") for q in M.BOILERPLATE)) + ")), chr(10)) as text from documents")
def f1_strip_boilerplate(t):
    return t("documents").select("doc_id", M.strip_boilerplate(F.expr(BANNERS)).alias("text"))


#: Blocks made from sentences, some of them headings, tables and lists.
BLOCKY = "replace(replace(replace(replace(text, '. ', chr(10) || chr(10)), ' s', chr(10) || chr(10) || '## '), ' w', chr(10) || '- '), ' m', chr(10) || chr(10) || '- ')"


@query(rf"""select doc_id, len(ps)::bigint as n, array_to_string(ps, chr(10) || chr(10)) as text from (select doc_id,
list_filter(list_transform(regexp_split_to_array({BLOCKY}, '\n\s*\n'), lambda b: {_STRIP.format('b')}), lambda b: b <> '' and not regexp_matches(b, '^(!\[|\||\*— Page |#{{1,3}} |\*\*Fig|\*\*Table|---)')
 and len(list_filter(string_split(b, chr(10)), lambda x: not regexp_matches(x, '^\s*$') and not regexp_matches(x, '^[#*\->|]'))) > 0) ps from documents)""")
def f6_paragraphs(t):
    p = t("documents").select("doc_id", M.paragraphs(F.expr(BLOCKY)).alias("ps"))
    return p.select("doc_id", F.size("ps").cast("long").alias("n"), F.array_join("ps", "\n\n").alias("text"))


_WITH_REFS = "text || chr(10) || case doc_id % 4 when 0 then '## References' when 1 then '# **Literature cited**' when 2 then 'References' else '### BIBLIOGRAPHY ' end || chr(10) || 'Smith, J. (2019). ' || source"


@query(rf"""select doc_id, case when p > 0 then substr(md, 1, p - 1) else md end as body, case when p > 0 then substr(md, p) else '' end as refs from (select doc_id, md,
case when h = '' then 0 when starts_with(md, h) then 1 else strpos(md, chr(10) || h) + 1 end p from (select doc_id, md, regexp_extract(md, '(?im)^#{{1,4}}\s*\**\s*(?:references?|bibliography|literature\s+cited|works\s+cited)\s*\**\s*$', 0) h from (select doc_id, {_WITH_REFS} md from documents)))""")
def g1_split_references(t):
    md = t("documents").select("doc_id", F.expr(_WITH_REFS).alias("md"))
    body, refs = M.split_references(F.col("md"))
    return md.select("doc_id", body.alias("body"), refs.alias("refs"))


_TABLE = "case conv_id % 3 when 0 then 'Here:' || chr(10) else '' end || '| a | b |' || chr(10) || case turn % 2 when 0 then '|---|---|' || chr(10) else '' end || '| ' || role || ' | ' || case conv_id % 5 when 0 then 'x | y | z' else 'x' end || ' |' || chr(10) || '| 2 | 3 |' || chr(10) || 'end'"


@query(rf"""with p as (select conv_id, turn, list_filter(list_transform(string_split(regexp_extract({_TABLE}, '(?:^|\n)((?:[ \t]*\|[^\n]*\|[ \t]*(?:\n|$))+)', 1), chr(10)), lambda x: trim(x)), lambda x: x <> '') rs from conversations),
q as (select *, list_transform(rs, lambda x: length(x) - length(replace(x, '|', ''))) k from p)
select conv_id, turn, case when len(rs) >= 3 and len(list_filter(rs, lambda x: regexp_matches(x, '^\|[ :\-|]*-[ :\-|]*\|$'))) > 0 and list_max(k) - list_min(k) <= 1 then array_to_string(rs, chr(10)) end as valid from q""")
def d10_valid_table(t):
    return t("conversations").select("conv_id", "turn", M.valid_table(F.expr(_TABLE)).alias("valid"))


_PAGED = "select doc_id // 10 as doc, doc_id % 10 as page, 'A running title of the journal that is long ' || (doc_id // 10) || ' ' || repeat('x', (doc_id % 3)::int) || chr(10) || 'Vol 1' || chr(10) || text || chr(10) || 'page foot' || chr(10) || (doc_id % 10) || ' of 10' as text from documents"


@query(rf"""with p as ({_PAGED}), n as (select doc, count(*) n from p group by doc),
l as (select doc, page, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) pos from p),
s as (select *, {_STRIP.format('line')} s from l),
w as (select doc, s, true whole from s join n using (doc) where length(s) between 2 and 200 group by doc, s, n having count(distinct page) >= greatest(3, floor(n * 0.3))),
e as (select doc, substr(s, 1, 60) stem, true begun from s join n using (doc) where length(s) between 30 and 200 group by doc, stem, n having count(*) >= greatest(3, floor(n * 0.3))),
k as (select s.*, n >= 4 and (coalesce(whole, false) or regexp_matches(s.s, '^[|\s]*(\d+\s*(of|/)\s*\d+|\d+)\s*[|\s]*$') or regexp_matches(s.s, '^(Vol\.?:?\(?\d+\)?|\d+\s+\d+\s*$)') or (length(s.s) >= 30 and coalesce(begun, false))) gone
 from s join n using (doc) left join w on w.doc = s.doc and w.s = s.s left join e on e.doc = s.doc and e.stem = substr(s.s, 1, 60))
select doc, page, coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') as text from k group by doc, page""")
def k1_drop_running_lines(t):
    p = t("documents").selectExpr("doc_id div 10 as doc", "doc_id % 10 as page", "'A running title of the journal that is long ' || (doc_id div 10) || ' ' || repeat('x', cast(doc_id % 3 as int)) || chr(10) || 'Vol 1' || chr(10) || text || chr(10) || 'page foot' || chr(10) || (doc_id % 10) || ' of 10' as text")
    return M.drop_running_lines(p)
