"""Queries of text that is mended, of answers read, of totals and picks over results."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexflume.functions import cleaning as C
from lexflume.operators import rollups
from lexflume.plans.registry import query


def _nest(sql: str, steps, times: int = 1) -> str:
    for _ in range(times):
        for p, r in steps:
            sql = f"regexp_replace({sql}, '{p}', '{r}', 'g')"
    return sql


_BROKEN = "replace(replace(text, 'e', ' fi '), ' t', ' E ffi ')"


@query(f"select doc_id, {_nest(_BROKEN, [(r'(^|[^a-zA-Z])([a-zA-Z])\s+(ff|fi|fl|ffi|ffl)\s+([a-z][a-zA-Z]*)', r'\1\2\3\4'), (r'(^|[^a-zA-Z])(ff|fi|fl|ffi|ffl)\s+([a-z][a-zA-Z]*)', r'\1\2\3')], 5)} as text from documents")
def c6_rejoin_ligatures(t):
    return t("documents").select("doc_id", C.rejoin_ligatures(F.expr(_BROKEN)).alias("text"))


_SPACED = "replace(replace(replace(text, 'th', '- '), ' a', ' ,  .   '), ' s', ' 52[◦] al.,2015for ')"


@query("select doc_id, " + _nest(_SPACED, [(r"([\p{L}\p{N}_])-\s+([\p{L}\p{N}_])", r"\1-\2"), (r"\s+([,.;:])", r"\1"), (" {3,}", "  "), (r"(\b(?:19|20)\d{2})([a-z]{2,})", r"\1 \2"), (r"([A-Za-z.]),((?:19|20)\d{2})", r"\1, \2"), (r"\[[◦°]\]", "°")]) + " as text from documents")
def c7_mend_spacing(t):
    return t("documents").select("doc_id", C.mend_spacing(F.expr(_SPACED)).alias("text"))


@query(r"select doc_id, case when length(s) > 200 then rtrim(substr(s, 1, 199)) || '…' else s end as alt from (select doc_id, translate(trim(regexp_replace(regexp_replace(replace(text, ' a', ' *[b]_ '), '[*_`]+', '', 'g'), '\s+', ' ', 'g')), '[]', '()') s from documents)")
def c21_image_alt(t):
    return t("documents").select("doc_id", C.image_alt(F.expr("replace(text, ' a', ' *[b]_ ')")).alias("alt"))


_ANSWER = "case turn % 3 when 0 then 'Here:' || chr(10) || '```py' || chr(10) || text || '```' when 1 then 'Please do not invent ' || text else text || ' TABLE_UNAVAILABLE' end"


@query(rf"select conv_id, turn, case when regexp_matches(a, '(?s)```[a-zA-Z]*\s*\n(.*?)```') then regexp_replace(regexp_extract(a, '(?s)```[a-zA-Z]*\s*\n(.*?)```', 1), '^\s+|\s+$', '', 'g') end as block, " + " or ".join(f"regexp_matches(a, '{p}')" for p in C.ECHOES) + f" as echo from (select *, {_ANSWER} a from conversations)")
def c29_code_block(t):
    a = t("conversations").select("conv_id", "turn", F.expr(_ANSWER).alias("a"))
    return a.select("conv_id", "turn", C.code_block(F.col("a")).alias("block"), C.is_echo(F.col("a")).alias("echo"))


_FRONT = "text || chr(10) || case doc_id % 4 when 0 then '## **Abstract**' when 1 then '# 1. Intro' when 2 then '### Background' else 'Plain' end || chr(10) || 'Body of ' || doc_id"
_MARKS = "|".join(p.removeprefix("(?i)^") for p in C.BODY)


@query(rf"select doc_id, case when h <> '' and length(cut) <= 4500 then substr(x, length(cut) + 1) else x end as text from (select *, split_part(x, h, 1) cut from (select *, regexp_extract(x, '(?im)^(?:{_MARKS})') h from (select doc_id, {_FRONT} x from documents)))")
def f9_strip_front_matter(t):
    return t("documents").select("doc_id", C.strip_front_matter(F.expr(_FRONT)).alias("text"))


_TITLE = "case doc_id % 5 when 0 then 'R E S E A R C H A R T I C L E of a b c d e f g' when 1 then 'Received: ' || text when 2 then 'Vol. 3 ' || text else text end"


@query(rf"""with t as (select doc_id, regexp_replace({_TITLE}, '^\s+|\s+$', '', 'g') t from documents), k as (select *, list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '') w from t),
n as (select *, lower(case when len(w) >= 4 and len(list_filter(w, lambda x: length(x) > 2)) = 0 then array_to_string(w, '') else regexp_replace(t, '\s+', ' ', 'g') end) n from k)
select doc_id, length(t) between 30 and 400 and not regexp_matches(t, '{C.BANNER}') and not regexp_matches(t, '{C.GENERIC}') and not regexp_matches(n, '{C.GENERIC}') and len(list_filter(w, lambda x: length(x) > 2)) >= 4 as good from n""")
def f2_good_title(t):
    return t("documents").select("doc_id", C.is_good_title(F.expr(_TITLE)).alias("good"))


_TEX = r"'\\documentclass{x}' || chr(10) || '\\begin{document} \\section{One} % note' || chr(10) || replace(replace(replace(translate(text, '$%', ''), ' a', ' \\textbf{\\emph{b}} $x^2$ '), ' s', ' \\cite{k1} {y} '), ' w', ' \\begin{' || case doc_id % 4 when 0 then 'align' when 1 then 'eqnarray*' when 2 then 'gather' else 'multline*' end || '} z \\end{' || case doc_id % 4 when 0 then 'align' when 1 then 'eqnarray*' when 2 then 'gather' else 'multline*' end || '} \\foo ') || '\\end{document} tail'"
_TEX_SQL = _TEX.replace("\\\\", "\\")
_TEX_STEPS = [(r"(?m)(^|[^\\])%[^\n]*$", r"\1"), (r"(?s)^.*?\\begin\{document\}", ""), (r"(?s)\\end\{document\}.*$", ""), (r"(?s)\\begin\{(?:align|eqnarray\*|gather|multline\*)\}.*?\\end\{(?:align|eqnarray\*|gather|multline\*)\}", " "), (r"\$[^$]*\$", " ")]
_TEX_CMDS = [(r"\\cite\{[^{}]*\}", " "), (r"\\[a-zA-Z@]+\s*\*?\s*(?:\[[^\]]*\])?\s*\{([^{}]*)\}", r"\1")]


@query("select doc_id, trim(" + _nest(_nest(_nest(_TEX_SQL, _TEX_STEPS), _TEX_CMDS, 8), [(r"\\[a-zA-Z@]+\*?", " "), ("[{}]", " "), (r"\s+", " ")]) + ") as text from documents")
def a25_c25_strip_latex(t):
    return t("documents").select("doc_id", C.strip_latex(F.expr(_TEX)).alias("text"))


@query("select l_orderkey as page, string_agg(l_shipmode_, ' ' order by l_linenumber, l_shipmode_) as text, count(*) as n from (select *, l_returnflag || l_partkey l_shipmode_ from lineitem where l_quantity >= 15) group by l_orderkey")
def a26_a27_page_words(t):
    w = t("lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("place"), F.expr("l_returnflag || l_partkey").alias("word"), F.col("l_quantity").alias("confidence"))
    return rollups.page_words(w)


@query("select coalesce(o_orderpriority, 'all') as confidence, count(*) filter (o_orderkey % 9 > 0) as success, count(*) filter (o_orderkey % 9 = 0) as cached, sum(case when o_orderkey % 9 > 0 then o_custkey end)::bigint as refs from orders group by rollup (o_orderpriority)")
def k6_k7_k9_totals(t):
    return rollups.totals(t("orders"), "o_orderpriority", F.expr("o_orderkey % 9 > 0"), F.col("o_custkey"))


@query("""select event_type as extractor, count(*) filter (event_id % 10 > 0) as n_ok, count(*) filter (event_id % 10 = 0) as n_err, round(avg(case when event_id % 10 > 0 then (event_id % 1000) / 1000.0 end), 3) as avg_f1, round(avg(event_id % 60), 3) as avg_s from events group by event_type""")
def k20_eval_summary(t):
    e = t("events").select(F.col("event_type").alias("extractor"), (F.col("event_id") % 10 > 0).alias("ok"), (F.col("event_id") % 1000 / 1000).alias("f1"), (F.col("event_id") % 60).alias("seconds"))
    return rollups.eval_summary(e)


@query("""select l_orderkey as figure, arg_max(l_linenumber, {'p': case l_returnflag when 'A' then 3 when 'N' then 2 else 0 end, 'c': l_discount, 'n': -l_linenumber}) as best, count(*) as tried from lineitem group by l_orderkey""")
def o4_o5_cascade_best(t):
    rank = F.expr("case l_returnflag when 'A' then 3 when 'N' then 2 else 0 end")
    return rollups.best_candidate(t("lineitem"), "l_orderkey", "l_linenumber", rank, F.col("l_discount"), -F.col("l_linenumber")).withColumnRenamed("l_orderkey", "figure")


@query("select d.doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def a20_pending(t):
    return rollups.pending(t("documents"), t("labels"), "doc_id")