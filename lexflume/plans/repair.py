"""Queries over repaired text: damage is put into whole texts, and SQL says what must come out."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexflume.functions import repair as P
from lexflume.functions import text as T
from lexflume.plans.registry import query


def _put(column: str, pairs: dict[str, str]) -> str:
    """An expression, of either engine, that replaces strings of a column."""
    for a, b in pairs.items():
        column = f"replace({column}, '{a}', '{b}')"
    return column


def _damaged(good: dict[str, str], bad: dict[str, str]):
    """SQL of texts with good in place of the keys, and the expression with the damage in the same places."""
    return f"select doc_id, {_put('text', good)} as text from documents", _put("text", bad)


# each key stands in many of the texts; what it becomes has a damaged and a sound form
_C3 = {". ": (". B¨ohm, M´endez and Garc´ıa with Konigslow (2021¨ ) said Dvor˘ak, ", ". Böhm, Méndez and Garc´ıa with Königslöw (2021) said Dvorăk, "), ", ": (", Bohm¨, Muller ˆ, ", ", Böhm, Müller, ")}
_C3_SQL, _C3_BAD = _damaged({k: g for k, (_, g) in _C3.items()}, {k: b for k, (b, _) in _C3.items()})


@query(f"select doc_id, trim(translate(text, '¨˘˙˜ˆ', '')) as text from ({_C3_SQL})")
def c3_c4_diacritics(t):
    return t("documents").select("doc_id", F.trim(P.float_diacritics(F.expr(_C3_BAD))).alias("text"))


_C5_SQL, _C5_BAD = _damaged({" the ": " significant field, flowers’ profile_x fower2 ", " de ": " Fields: efficient "}, {" the ": " signifcant feld, fowers’ profile_x fower2 ", " de ": " Fields: efcient "})


@query(_C5_SQL)
def c5_dropped_ligatures(t):
    return t("documents").select("doc_id", P.dropped_ligatures(F.expr(_C5_BAD)).alias("text"))


_C10_SQL, _C10_BAD = _damaged({" the ": " cm·min⁻¹ x² [3] (4) ", " de ": " R_⁺²⁼ [−] "}, {" the ": " cm·min[−][1] x[2] [3] (4) ", " de ": " R_[+2=] [−] "})


@query(_C10_SQL)
def c10_superscripts(t):
    return t("documents").select("doc_id", P.superscripts(F.expr(_C10_BAD)).alias("text"))


_C12 = "'  ' || replace(replace(text, ' ', ' * '), '. ', '[1, 2*] ')"


@query(rf"select doc_id, trim(regexp_replace(regexp_replace(regexp_replace({_C12}, '\[[0-9,*\s\-]+\]', '', 'g'), '\s*\*\s*', ' ', 'g'), '\s+', ' ', 'g'), ' ') as text from documents")
def c12_author_lines(t):
    return t("documents").select("doc_id", P.author_line(F.expr(_C12)).alias("text"))


_C18_SQL, _C18_BAD = _damaged({" the ": " 35°30′59.5″ N 7×7 a × b 3±1 H′_ "}, {" the ": " 35 _◦_ 30 _[′]_ 59.5 _[′′]_ N 7 _×_ 7 a _×_ b 3_±_1 H[′]_ "})


@query(_C18_SQL)
def c17_c18_math_marks(t):
    return t("documents").select("doc_id", P.math_marks(F.expr(_C18_BAD)).alias("text"))


_C9 = "replace(replace(text, chr(10), '<br>  ' || chr(10)), '. ', '. <br/> ') || '<br >'"


@query(r"select doc_id, regexp_replace(" + _C9 + r", '[ \t]*<br\s*/?>[ \t]*(\n|$)', '\1', 'g') as text from documents")
def c9_strip_breaks(t):
    return t("documents").select("doc_id", T.strip_stray_br(F.expr(_C9.replace("chr(10)", "'\\n'"))).alias("text"))


@query("""with w as (select doc_id, list_filter(regexp_split_to_array(text, '[^A-Za-z]+'), lambda x: length(x) > 2) w from documents), k as (select doc_id, list_transform(w, lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))) k from w),
d as (select doc_id, list_filter(k, lambda x, i: list_position(k, x) = i and length(x) <= 80) k from k) select doc_id, array_to_string(k, '|') as keywords from d""")
def c20_keywords(t):
    k = F.transform(F.filter(F.split("text", "[^A-Za-z]+"), lambda x: F.length(x) > 2), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2)))))
    sep = F.expr("case doc_id % 6 when 0 then '; ' when 1 then ' · ' when 2 then ' . ' when 3 then ', ' when 4 then '\\n' else ' • ' end")
    d = t("documents").withColumn("k", k).select("doc_id", F.concat(F.lit("Keywords: "), F.concat_ws("\x01", "k")).alias("r"), sep.alias("s"))
    return d.select("doc_id", F.array_join(P.keywords(F.replace("r", F.lit("\x01"), F.col("s"))), "|").alias("keywords"))


_NUM = "case event_id % 5 when 0 then value / 7.0013 when 1 then value / 1000.7 when 2 then value * 1234.5678 when 3 then event_id * 1.0 else value / 3.3e6 end"


@query(f"select event_id, case when abs(v - round(v)) < 1e-9 then cast(cast(round(v) as bigint) as varchar) else format('{{:.3g}}', v) end as shown from (select event_id, cast({_NUM} as double) v from events)")
def c27_short_numbers(t):
    return t("events").select("event_id", P.short_number(F.expr(f"cast({_NUM.replace('3.3e6', '3.3e6D').replace('7.0013', '7.0013D').replace('1000.7', '1000.7D').replace('1234.5678', '1234.5678D')} as double)")).alias("shown"))


_POS = "cast(doc_id * 7919 % greatest(length(text), 1) as int)"


@query(rf"""with p as (select doc_id, text, {_POS} pos from documents where length(text) > 0), h as (select *, length(regexp_extract(substr(text, 1, pos + 1), '(?s)^(.*[.!?\n])[ \n]', 1)) start, regexp_extract(substr(text, pos + 1), '(?s)^(.*?[.!?\n])(?:[ \n]|$)', 1) rest from p)
select doc_id, regexp_replace(substr(text, start + 1, pos - start) || case when rest = '' then substr(text, pos + 1) else rest end, '^\s+|\s+$', '', 'g') as sentence from h""")
def c28_sentences(t):
    d = t("documents").where("length(text) > 0").withColumn("pos", F.expr(_POS))
    return d.select("doc_id", P.sentence_at(F.col("text"), F.col("pos")).alias("sentence"))


@query(r"select conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') as answer from conversations")
def c30_answers(t):
    log = "concat('main: start\\n1.2.3.4 I x\\n', case turn % 3 when 0 then '<|channel>thought hm <channel|> ' when 1 then 'Examine the Chart:\\n' else '' end, trim(text), case turn % 2 when 0 then '<turn|> more' else '' end, '\\nchat template example: z')"
    return t("conversations").select("conv_id", "turn", P.answer_text(F.expr(log)).alias("answer"))


@query("""select event_id, 2.0 * least(abs(event_id % 180 - user_id % 180), 180 - abs(event_id % 180 - user_id % 180)) + abs(event_id % 256 - user_id % 250) + abs(event_id % 200 - user_id % 256) as distance, cast(event_id % 256 // 24 * 24 + 12 as bigint) as shade from events""")
def c31_colours(t):
    c = lambda k, n: F.col(k) % n
    a, b = {"h": c("event_id", 180), "s": c("event_id", 256), "v": c("event_id", 200)}, {"h": c("user_id", 180), "s": c("user_id", 250), "v": c("user_id", 256)}
    return t("events").select("event_id", P.colour_distance(a, b).alias("distance"), P.quantised(c("event_id", 256)).alias("shade"))


@query("""select l_orderkey, l_linenumber, case l_partkey % 3 when 0 then 'ABCD+CMSY10' when 1 then 'Times' else 'CMR8' end as font, l_partkey % 3 <> 1 as math from lineitem""")
def f12_math_fonts(t):
    li = t("lineitem").selectExpr("l_orderkey", "l_linenumber", "case l_partkey % 3 when 0 then 'ABCD+CMSY10' when 1 then 'Times' else 'CMR8' end as font")
    return li.withColumn("math", P.is_math_font(F.col("font")))


_SAID = "case conv_id % 5 when 0 then 'Assistant: ' when 1 then 'Sure, ' when 2 then '- ' else '' end || case conv_id % 7 when 0 then 'do not invent ' else '' end || replace(text, ',', '. ')"


@query(rf"""with r as (select conv_id, turn, regexp_replace(regexp_replace(split_part(regexp_replace(regexp_replace({_SAID}, '^\s*Assistant:\s*', ''), '^\s+|\s+$', '', 'g'), chr(10), 1), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g') l from conversations),
f as (select *, coalesce(nullif(regexp_extract(l, '^(.+?[.!?])(?:\s|$)', 1), ''), l) s from r), g as (select *, regexp_replace(s, '^[-*•]\s*', '') x from f), n as (select *, len(list_filter(regexp_split_to_array(x, '\s+'), lambda w: w <> '')) k from g)
select conv_id, turn, case when k between 3 and 60 and not regexp_matches(x, '(?i)^(sure|certainly|of course|here is|here''s|i''?ll|i can|let me|this image|this figure)\b') and not contains(lower(x), 'do not invent') then case when regexp_matches(x, '[.!?]$') then x else x || '.' end end as sentence from n""")
def m6_short_sentences(t):
    return t("conversations").select("conv_id", "turn", P.short_sentence(F.expr(_SAID)).alias("sentence"))


_M7 = "case turn % 5 when 0 then 'x ```mermaid' || chr(10) || 'graph LR' || chr(10) || ' A --> B' || chr(10) || '``` y' when 1 then 'graph TD' || chr(10) || repeat('A --> B' || chr(10), cast(conv_id % 90 as int)) when 2 then '```' || chr(10) || 'pie' || chr(10) || 'x' || chr(10) || '```' when 3 then 'MERMAID_UNAVAILABLE graph A --> B' else text end"


@query(f"""select conv_id, turn, case turn % 5 when 0 then 'graph LR' || chr(10) || ' A --> B' when 1 then case when conv_id % 90 between 1 and 60 then 'graph TD' || chr(10) || rtrim(repeat('A --> B' || chr(10), cast(conv_id % 90 as int)), chr(10)) end end as diagram from conversations""")
def m7_diagrams(t):
    return t("conversations").select("conv_id", "turn", P.mermaid(F.expr(_M7.replace("chr(10)", "'\\n'"))).alias("diagram"))


@query(r"""select conv_id, turn, case turn % 5 when 0 then '$$' || conv_id || ' + x$$' when 1 then '$a_1$' when 2 then null when 3 then null else null end as formula from conversations""")
def m8_formulas(t):
    said = "case turn % 5 when 0 then concat('so $$ ', conv_id, ' + x $$ and $y$') when 1 then 'Assistant: with $a_1 $ .' when 2 then 'LATEX_UNAVAILABLE $$ab$$' when 3 then '$$ $$ x' else 'none' end"
    return t("conversations").select("conv_id", "turn", P.latex(F.expr(said)).alias("formula"))


_HEADS = "case doc_id % 5 when 0 then '# **Effects of olive cover crops on soil ' || doc_id || '**' when 1 then 'Cite this article: Fox A (2020). Growing several kinds of grass ' || doc_id || '. Agron J 12' when 2 then 'Corrigendum to \"The old title\"' when 3 then '**Growing many kinds of grass in hills ' || doc_id || '**' else '# Abstract' || chr(10) || 'A first long line that is nothing else but ' || doc_id end"
_MD = f"'Soil & Tillage Research ' || (doc_id % 300) || ' (2024) 1' || chr(10) || {_HEADS} || chr(10) || 'Copyright by them ' || (1990 + doc_id % 30) || case doc_id % 3 when 0 then ' doi: 10.1016/j.x.' || doc_id || '.' when 1 then ' 10.5555/abc' || doc_id || ',' else '' end || chr(10) || text"
_MD_SPARK = _MD.replace("chr(10)", "'\\n'")


@query("""select doc_id, case doc_id % 5 when 0 then 'Effects of olive cover crops on soil ' || doc_id when 1 then 'Growing several kinds of grass ' || doc_id when 2 then 'Corrigendum: The old title' when 3 then 'Growing many kinds of grass in hills ' || doc_id else 'Soil & Tillage Research ' || (doc_id % 300) || ' (2024) 1' end as title,
case doc_id % 3 when 0 then '10.1016/j.x.' || doc_id when 1 then '10.5555/abc' || doc_id end as doi, cast(1990 + doc_id % 30 as int) as year, 'Soil & Tillage Research' as journal from documents""")
def g4_g5_metadata(t):
    return t("documents").select("doc_id", P.metadata(F.expr(_MD_SPARK)).alias("m")).select("doc_id", "m.*")


_REF = "case doc_id % 4 when 0 then 'Fox, A. 2019. Growing several kinds of grass. J. Agr. 3' when 1 then 'Fox, A. n.d. Soil 12, 33. Xy ab. A sentence with rather many words in it. X' when 2 then 'Anon. n.d' else 'Lee B. 2001a. Ab' end"


@query("""select doc_id, case when doc_id % 7 = 0 then 'A given title ' || doc_id when doc_id % 4 = 0 then 'Growing several kinds of grass' when doc_id % 4 = 1 then 'A sentence with rather many words in it' end as title,
case when doc_id % 5 = 0 then 1999 when doc_id % 4 = 0 then 2019 end::int as year from documents""")
def g20_reference_titles(t):
    raw, year = F.expr(_REF), F.expr("case doc_id % 5 when 0 then '1999-01' when 1 then '3000' else '' end")
    return t("documents").select("doc_id", P.reference_title(F.expr("case when doc_id % 7 = 0 then 'A given title ' || doc_id else 'short' end"), raw).alias("title"), P.reference_year(year, raw).alias("year"))


_IMG = "text || '\n![](images/f' || doc_id || '.png)\n\n' || case doc_id % 4 when 0 then '**Fig. ' || doc_id || '.** — Bold one' when 1 then 'Figure ' || doc_id || ') Plain one ' when 2 then repeat('x', 600) || '\nFigure 1. Too far' else '' end"


@query("select doc_id, case when doc_id % 4 < 2 then doc_id::varchar end as number, case doc_id % 4 when 0 then 'Bold one' when 1 then 'Plain one' end as caption from documents")
def g21_captions_after_images(t):
    c = P.caption_after(F.expr(_IMG.replace("\n", "\\n")), F.expr("'f' || doc_id || '.png'"))
    return t("documents").select("doc_id", c.alias("c")).select("doc_id", "c.*")


@query("""select conv_id, turn, case turn % 4 when 0 then 'Crops | x' end as title, case turn % 4 when 2 then null when 3 then null else 'Year;A;B' end as header, case turn % 4 when 0 then '2019;' || conv_id || ';2/2020;3;4' when 1 then '2021;5;' end as rows from conversations""")
def g24_table_answers(t):
    said = "case turn % 4 when 0 then concat('TITLE | Crops | x <0x0A> Year | A | B <0x0A> 2019 | ', conv_id, ' | 2 <0x0A> | | <0x0A>2020|3|4|5') when 1 then 'Year | A | B\\n2021 | 5' when 2 then 'TITLE | only' else '' end"
    a = t("conversations").select("conv_id", "turn", P.table_answer(F.expr(said)).alias("a"))
    return a.select("conv_id", "turn", "a.title", F.when(F.col("a").isNotNull(), F.array_join("a.header", ";")).alias("header"), F.when(F.col("a").isNotNull(), F.array_join(F.transform("a.rows", lambda r: F.array_join(r, ";")), "/")).alias("rows"))


_PAGES = "'⟦' || (doc_id % 9) || '/9⟧⟦' || (doc_id % 9 + 1) || '/9⟧' || text || '⟦5/9⟧\n\n\n\nend'"


@query(r"""with a as (select doc_id, regexp_replace(""" + _PAGES.replace("\n", "' || chr(10) || '") + r""", '⟦([0-9]+)/([0-9]+)⟧', chr(10) || chr(10) || '---' || chr(10) || chr(10) || '*— Page \1 of \2 —*' || chr(10) || chr(10), 'g') t from documents),
b as (select doc_id, regexp_replace(regexp_replace(t, '\n{4,}', repeat(chr(10), 3), 'g'), '(\*— Page [0-9]+ of [0-9]+ —\*)\s*\n+\s*---\s*\n+\s*(\*— Page [0-9]+ of [0-9]+ —\*)', '\1' || chr(10) || chr(10) || '\2', 'g') t from a)
select doc_id, regexp_replace(t, '(?m)^---\s*\n+\s*---\s*\n+(\*— Page)', '---' || chr(10) || chr(10) || '\1', 'g') as text from b""")
def b4_page_marks(t):
    return t("documents").select("doc_id", P.page_marks(F.expr(_PAGES.replace("\n", "\\n"))).alias("text"))


_CHART = """select o_orderkey fig, ['a', 'b', 'c'] cats, [o_custkey % 90 / 7.0, 2.0, o_custkey * 1.5]::double[] vals, o_custkey % 3 k, o_custkey c from orders"""
_FMT = "case when abs({0} - round({0})) < 1e-9 then cast(cast(round({0}) as bigint) as varchar) else format('{{:.3g}}', {0}::double) end"


@query(f"""with c as ({_CHART}) select fig, case k when 0 then '| Category | min | Q1 | median | Q3 | max |' || chr(10) || '|---|---|---|---|---|---|' || chr(10) || array_to_string(list_transform(['a', 'b', 'c'], lambda x: '| ' || x || ' | 1 | 2.5 | ' || {_FMT.format("(c % 90 / 7.0)")} || ' | 4 | 5 |'), chr(10))
when 1 then '| Slice | Fraction | Percent |' || chr(10) || '|---|---|---|' || chr(10) || '| ? | 0.25 | 25% |' || chr(10) || '| ? | 0.755 | 75.5% |'
else '| Category | Value |' || chr(10) || '|---|---|' || chr(10) || '| a | ' || {_FMT.format("vals[1]")} || ' |' || chr(10) || '| b | 2 |' || chr(10) || '| c | ' || {_FMT.format("vals[3]")} || ' |' end as md from c""")
def d9_chart_tables(t):
    o = t("orders").selectExpr("o_orderkey as fig", "array('a', 'b', 'c') as cats", "array(cast(o_custkey % 90 / 7.0D as double), 2.0D, o_custkey * 1.5D) as vals", "o_custkey % 3 as k")
    box = F.struct(F.lit(1.0).alias("low"), F.lit(2.5).alias("q1"), F.get("vals", F.lit(0)).alias("median"), F.lit(4.0).alias("q3"), F.lit(5.0).alias("high"))
    boxes, percents = F.when(F.col("k") == 0, F.array(box, box, box)), F.when(F.col("k") == 1, F.array(F.lit(25.0), F.lit(75.5)))
    return o.select("fig", P.chart_table(F.col("cats"), F.col("vals"), boxes, percents).alias("md"))


@query("""with s as (select user_id line, event_id, case event_type when 'click' then 'super' when 'view' then 'sub' else 'body' end role, 't' || event_id % 7 x from events),
r as (select *, case when role = lag(role) over (partition by line order by event_id) then 0 else 1 end b from s), i as (select *, sum(b) over (partition by line order by event_id) run from r),
g as (select line, run, role, string_agg(x, '' order by event_id) x from i group by all)
select line, string_agg(case role when 'super' then '<sup>' || x || '</sup>' when 'sub' then '<sub>' || x || '</sub>' else x end, '' order by run) as text from g group by line""")
def g16_a11_rendered_lines(t):
    from lexflume.operators.layout import rendered_lines

    s = t("events").selectExpr("user_id as line", "event_id as span", "case event_type when 'click' then 'super' when 'view' then 'sub' else 'body' end as role", "'t' || event_id % 7 as text")
    return rendered_lines(s)


@query("""with s as (select user_id page, event_id pos, value v from events), t as (select *, (coalesce(lag(v) over w, 0) + v + coalesce(lead(v) over w, 0)) / 3 m from s window w as (partition by page order by pos)),
p as (select *, m > lag(m) over w and m >= lead(m) over w peak from t window w as (partition by page order by pos)) select page, pos, round(m, 6) as smooth from p where peak""")
def w6_smoothed_peaks(t):
    from lexflume.operators.layout import smoothed_peaks

    p = smoothed_peaks(t("events").selectExpr("user_id as page", "event_id as pos", "value as v"))
    return p.select("page", "pos", F.round("smooth", 6).alias("smooth"))


_BOX = "event_id as id, user_id as fig, (event_id * 37 % 400) * 1.0 as y, (event_id * 91 % 600) * 1.0 as x"


@query(f"select fig, id, row_number() over (partition by fig order by floor(y / 30), x, id) as place from (select {_BOX} from events)")
def o6_w1_node_order(t):
    w = Window.partitionBy("fig").orderBy(F.floor(F.col("y") / 30), "x", "id")
    return t("events").selectExpr(*[c.strip() for c in _BOX.split(", ")]).select("fig", "id", F.row_number().over(w).cast("long").alias("place"))
