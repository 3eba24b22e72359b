"""Queries over the driver's tables, each with the SQL that gives the same rows.

Where a table lacks what an operator is for, its input is made from other columns by expressions that both engines share.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexflume.functions import text as T
from lexflume.operators import linking, metrics, pages, policies, rollups
from lexflume.plans.registry import query

#: Dirty text made from clean: both engines read these expressions.
DIRTY = "replace(replace(replace(text, 'the ', 't­he '), 'fi', 'ﬁ'), ' and ', ' – ')"
_LIG = "replace(replace(replace(replace(replace(replace(replace({}, 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ﬅ', 'st'), 'ﬆ', 'st')"
_NORMAL = r"trim(regexp_replace(regexp_replace(lower(" + _LIG + r"), '[^\x00-\x7f]', ' ', 'g'), '\s+', ' ', 'g'))"
_TOKENS = "regexp_extract_all(" + _NORMAL + ", '[a-z0-9]+')"


@query("select substr(sha256(text), 1, 16) as sha, min(doc_id) as doc_id from documents group by 1")
def a1_dedupe_by_content(t):
    return pages.first_by_content(t("documents"), "text", "doc_id")


@query("""with p as (select doc_id, case doc_id % 3 when 0 then '' when 1 then text else translate(text, 'aeiou', '') end cheap, text costly from documents)
select doc_id, case when length(trim(cheap)) >= 100 then cheap when length(trim(costly)) > length(trim(cheap)) then costly else cheap end as text,
 not length(trim(cheap)) >= 100 as fell_back from p""")
def a8_auto_text(t):
    p = t("documents").select("doc_id", F.expr("case doc_id % 3 when 0 then '' when 1 then text else translate(text, 'aeiou', '') end").alias("cheap"), F.col("text").alias("costly"))
    return p.select("doc_id", pages.choose_text(F.col("cheap"), F.col("costly")).alias("text"), (F.length(F.trim("cheap")) < 100).alias("fell_back"))


@query("select c.conv_id, c.turn, b.item_id, case when length(coalesce(c.text, '')) >= length(coalesce(b.text, '')) then coalesce(c.text, '') else b.text end as text from conversations c full join benchmark b on c.conv_id = b.item_id")
def a9_compare_text(t):
    j = t("conversations").alias("c").join(t("benchmark").alias("b"), F.expr("c.conv_id = b.item_id"), "full")
    return j.select("conv_id", "turn", "item_id", pages.longer(F.coalesce("c.text", F.lit("")), F.coalesce("b.text", F.lit(""))).alias("text"))


@query("""select l_orderkey, l_linenumber, case when f = 0 and o <> 0 and l_discount * 40 >= 1.5 then ((-o % 360) + 360) % 360 end as rotation
from (select *, (l_linenumber % 2) * 90 f, (l_suppkey % 4) * 90 o from lineitem)""")
def a29_rotation_fix(t):
    i = t("lineitem").select("l_orderkey", "l_linenumber", ((F.col("l_linenumber") % 2) * 90).alias("f"), ((F.col("l_suppkey") % 4) * 90).alias("o"), (F.col("l_discount") * 40).alias("c"))
    return i.select("l_orderkey", "l_linenumber", policies.rotation(F.col("f"), F.col("o"), F.col("c")).alias("rotation"))


@query("select source, doc_id, length(text) as size from documents where length(text) < 100")
def a30_low_confidence_pages(t):
    return rollups.low_pages(t("documents")).select("source", "doc_id", F.length("text").alias("size"))


@query(f"select doc_id, replace({DIRTY}, '­', '') as text from documents")
def c1_clean_soft_hyphens(t):
    return t("documents").select("doc_id", T.clean_soft_hyphens(F.expr(DIRTY)).alias("text"))


@query("select doc_id, " + _LIG.format(f"translate({DIRTY}, '{T.PUNCT_FROM}{T.DROPPED}', '" + T.PUNCT_TO.replace("'", "''") + "')") + " as text from documents")
def c2_unicode_punct(t):
    return t("documents").select("doc_id", T.normalize_unicode_punct(F.expr(DIRTY)).alias("text"))


@query(r"select doc_id, regexp_replace(replace(text, '.', chr(10) || chr(10)), '\n{3,}', chr(10) || chr(10), 'g') as text from documents")
def c8_collapse_blank_lines(t):
    return t("documents").select("doc_id", T.collapse_blank_lines(F.expr("replace(text, '.', chr(10) || chr(10))")).alias("text"))


@query(r"""select doc_id, regexp_replace(regexp_replace(regexp_replace(d, '([A-Za-z]{2,})[\x{AD}-]\n([a-z])', '\1\2', 'g'), '([A-Za-z]{2,})[\x{AD}-]\n([a-z])', '\1\2', 'g'), '([A-Za-z]{2,})[\x{AD}-]\n([a-z])', '\1\2', 'g') as text
from (select doc_id, replace(text, 'th', 'th-' || chr(10)) d from documents)""")
def c16_dehyphenate(t):
    return t("documents").select("doc_id", T.dehyphenate(F.expr("replace(text, 'th', 'th-' || chr(10))")).alias("text"))


@query("select doc_id, len(" + _TOKENS.format("text") + ") as n_tokens, array_to_string(" + _TOKENS.format("text") + ", ' ') as tokens from documents")
def c23_tokenize(t):
    return t("documents").select("doc_id", T.tokens(F.col("text")).alias("k")).select("doc_id", F.size("k").cast("long").alias("n_tokens"), F.array_join("k", " ").alias("tokens"))


@query(r"""select p_partkey, trim(regexp_replace(lower(regexp_replace(p_name, '[^a-zA-Z0-9 ]', ' ', 'g')), '\s+', ' ', 'g')) as title_key,
substr(regexp_replace(lower(p_name || ', B., 2020. ' || p_type), '[^a-z0-9]', '', 'g'), 1, 80) as prefix_key from part""")
def c24_keys(t):
    return t("part").select("p_partkey", T.title_key(F.col("p_name")).alias("title_key"), T.prefix_key(F.expr("concat(p_name, ', B., 2020. ', p_type)")).alias("prefix_key"))


@query(r"""with s as (select event_id, case event_id % 4 when 0 then event_id || '%' when 1 then (event_id % 90) || ',' || (event_id % 7) when 2 then '1,' || (100 + event_id % 900) || '.5' else 'n' || event_id end l from events)
select event_id, l as label, case when m = '' then null when m not like '%.%' and regexp_full_match(m, '[^,]*,[^,]*') then try_cast(replace(m, ',', '.') as double) else try_cast(replace(m, ',', '') as double) end as number
from (select *, regexp_extract(replace(trim(l), '%', ''), '^(-?\d[\d.,]*)$', 1) m from s)""")
def c26_parse_number(t):
    e = F.expr("case event_id % 4 when 0 then concat(event_id, '%') when 1 then concat(event_id % 90, ',', event_id % 7) when 2 then concat('1,', 100 + event_id % 900, '.5') else concat('n', event_id) end")
    return t("events").select("event_id", e.alias("label")).withColumn("number", T.parse_number(F.col("label")))


@query("""select doc_id, case when length(t) > 280 then rtrim(substr(t, 1, 279)) || '…' else t end as alt
from (select doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) t from documents)""")
def c22_truncate_alt(t):
    return t("documents").select("doc_id", T.truncate(F.col("text")).alias("alt"))


@query("select p_partkey, case when i < 26 then chr((65 + i)::int) else chr((64 + i // 26)::int) || chr((65 + i % 26)::int) end as ident from (select p_partkey, p_partkey % 700 i from part)")
def c32_next_ident(t):
    return t("part").select("p_partkey", T.next_ident(F.col("p_partkey") % 700).alias("ident"))


@query(r"""select p_partkey, s as title, s = '' or regexp_matches(s, '(?i)\b\d+\s*(\(\d+\))?\s*[,;]\s*[ep]?\d') or (len(w) <= 3 and len(list_filter(w, lambda x: x like '%.' and length(x) <= 6)) > 0) as journal_like
from (select *, list_filter(regexp_split_to_array(s, '\s+'), lambda x: x <> '') w from (select p_partkey, case p_partkey % 3 when 0 then 'J. Bio. ' || p_size || ', ' || p_partkey when 1 then p_name else 'J. ' || p_brand end s from part))""")
def f4_journal_like(t):
    s = F.expr("case p_partkey % 3 when 0 then concat('J. Bio. ', p_size, ', ', p_partkey) when 1 then p_name else concat('J. ', p_brand) end")
    return t("part").select("p_partkey", s.alias("title")).withColumn("journal_like", T.journal_like(F.col("title")))


@query(r"select doc_id, len(list_filter(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda p: regexp_matches(trim(p), '^\p{Ll}')))::bigint as n_broken from documents")
def g14_broken_sentences(t):
    return t("documents").select("doc_id", pages.broken_sentences(F.expr("replace(text, chr(10), chr(10) || chr(10))")).cast("long").alias("n_broken"))


@query("""with s as (select event_id, (event_id % 9)::int a, (event_id % 9 + event_id % 80)::int b from events)
select event_id, list_sort(list_distinct(case when b - a > 50 then [a, 7] else list_concat(range(a, b + 1), [7]) end))::varchar as nums from s""")
def g17_expand_range(t):
    spec = F.expr("concat(event_id % 9, '-', event_id % 9 + event_id % 80, ', 7b')")
    return t("events").select("event_id", F.concat(F.lit("["), F.array_join(T.expand_range(spec), ", "), F.lit("]")).alias("nums"))


_REFS = "select o_custkey as doc, 'C' || (o_orderkey % 17) as surname, year(o_orderdate) as year, o_orderkey as ref_no from orders"
_CITES = "select o.o_custkey as doc, l_orderkey, l_linenumber, 'c' || (l_partkey % 17) as surname, year(l_shipdate) as year from lineitem join orders o on l_orderkey = o.o_orderkey"


@query(f"""with r as (select doc, lower(surname) s, year y, min(ref_no) ref_no from ({_REFS}) group by all)
select c.doc, l_orderkey, l_linenumber, surname, year, r.ref_no from ({_CITES}) c left join r on c.doc = r.doc and lower(c.surname) = r.s and c.year = r.y""")
def j1_link_citations(t):
    refs = t("orders").select(F.col("o_custkey").alias("doc"), F.expr("concat('C', o_orderkey % 17)").alias("surname"), F.year("o_orderdate").cast("long").alias("year"), F.col("o_orderkey").alias("ref_no"))
    cites = t("lineitem").join(t("orders"), F.expr("l_orderkey = o_orderkey")).select(F.col("o_custkey").alias("doc"), "l_orderkey", "l_linenumber", F.expr("concat('c', l_partkey % 17)").alias("surname"), F.year("l_shipdate").cast("long").alias("year"))
    return linking.link_citations(cites, refs)


_CAPS = "select l_orderkey as page, l_linenumber as caption, l_quantity * 5 as x0, l_quantity * 5 + 100 as x1, (l_partkey % 600) * 1.0 as y0, (l_partkey % 600) + 20.0 as y1 from lineitem where l_linenumber % 3 = 1"
_REGS = "select l_orderkey as page, l_linenumber as region, l_linenumber % 2 = 0 as is_image, l_quantity * 4 as x0, l_quantity * 4 + 150 as x1, (l_suppkey % 50) * 8.0 as y0, (l_suppkey % 50) * 8.0 + 120.0 as y1 from lineitem where l_linenumber % 3 <> 1"


@query(f"""with c as ({_CAPS}), r as ({_REGS}),
a as (select c.page, c.caption, r.region, row_number() over (partition by c.page, c.caption order by c.y0 - r.y1, r.region) n from c join r on c.page = r.page
  where r.y1 <= c.y0 + 20 and least(c.x1, r.x1) - greatest(c.x0, r.x0) >= 0.3 * (c.x1 - c.x0)),
d as (select c.page, c.caption, r.region, ((c.x0+c.x1)/2 - (r.x0+r.x1)/2) * ((c.x0+c.x1)/2 - (r.x0+r.x1)/2) + ((c.y0+c.y1)/2 - (r.y0+r.y1)/2) * ((c.y0+c.y1)/2 - (r.y0+r.y1)/2) q from c join r on c.page = r.page where r.is_image),
e as (select *, row_number() over (partition by page, caption order by q, region) n from d)
select c.page, c.caption, coalesce(a.region, e.region) as region, case when a.region is not null then 'above' when e.region is not null then 'nearest' else 'unpaired' end as how
from c left join a on a.n = 1 and c.page = a.page and c.caption = a.caption left join e on e.n = 1 and c.page = e.page and c.caption = e.caption""")
def j7_pair_captions(t):
    li = t("lineitem")
    caps = li.where("l_linenumber % 3 = 1").selectExpr("l_orderkey page", "l_linenumber caption", "l_quantity * 5 x0", "l_quantity * 5 + 100 x1", "(l_partkey % 600) * 1.0D y0", "(l_partkey % 600) + 20.0D y1")
    regs = li.where("l_linenumber % 3 <> 1").selectExpr("l_orderkey page", "l_linenumber region", "l_linenumber % 2 = 0 is_image", "l_quantity * 4 x0", "l_quantity * 4 + 150 x1", "(l_suppkey % 50) * 8.0D y0", "(l_suppkey % 50) * 8.0D + 120.0D y1")
    return linking.pair_captions(caps, regs)


@query("""select user_id as doc, event_id as pos, (select max(m.event_id) from events m where m.user_id = e.user_id and m.event_type = 'error' and m.event_id < e.event_id) as marker from events e where event_type <> 'error'""")
def j13_w5_last_marker(t):
    e = t("events").select(F.col("user_id").alias("doc"), F.col("event_id").alias("pos"), "event_type")
    return linking.last_marker(e.where("event_type <> 'error'"), e.where("event_type = 'error'").withColumn("marker", F.col("pos")))


@query("""with p as (select doc_id // 10 as doc, doc_id % 10 as page, text from documents), n as (select doc, count(distinct page) n from p group by doc having count(distinct page) >= 4),
l as (select doc, page, trim(unnest(string_split(text, chr(10)))) line from p),
k as (select doc, line, count(distinct page) k from l where length(line) between 2 and 200 group by doc, line)
select k.doc, line, k from k join n on k.doc = n.doc where k >= greatest(3, floor(n * 0.3))""")
def k1_repeated_lines(t):
    return pages.repeated_lines(t("documents").select(F.expr("doc_id div 10").alias("doc"), (F.col("doc_id") % 10).alias("page"), "text"))


_STATS = "select source as slug, lang, doc_id % 40 as n_pages, length(text) % 9 as n_figures, length(text) % 9 * (doc_id % 3) // 3 as n_captioned, (doc_id % 13) / 10.0 as coverage from documents"


@query(f"""with s as ({_STATS}) select lang, count(*) as n_papers, sum(n_pages)::bigint as total_pages, sum(n_figures)::bigint as total_figures,
round(coalesce(avg(nullif(coverage, 0)), 0)::double, 3) as mean_coverage, case when sum(n_figures) <> 0 then round(100.0 * sum(n_captioned) / sum(n_figures), 1) else 0 end::double as pct_captioned
from s group by lang""")
def k4_k5_corpus_aggregate(t):
    s = t("documents").selectExpr("lang", "doc_id % 40 n_pages", "length(text) % 9 n_figures", "(length(text) % 9 * (doc_id % 3)) div 3 n_captioned", "(doc_id % 13) / 10.0D coverage")
    return s.groupBy("lang").agg(F.count(F.lit(1)).alias("n_papers"), F.sum("n_pages").alias("total_pages"), F.sum("n_figures").cast("long").alias("total_figures"), F.round(F.coalesce(F.avg(F.nullif("coverage", F.lit(0.0))), F.lit(0.0)), 3).alias("mean_coverage"), policies.pct(F.sum("n_captioned"), F.sum("n_figures")).cast("double").alias("pct_captioned"))


@query("select source, list_sort(list(n_chars))[len(list(n_chars)) // 2 + 1] as upper_median from documents group by source")
def k8_upper_median(t):
    return metrics.upper_medians(t("documents"), "source", "n_chars")


@query("""with d as (select case when length(text) % 5 = 0 then 'extract' when conf >= 0.85 then 'skip' when conf >= 0.55 then 'validate' else 'replace' end decision from (select text, (doc_id % 100) / 100.0 conf from documents))
select decision, count(*) as n, (count(*) * case decision when 'extract' then 60 when 'skip' then 0 when 'validate' then 40 else 80 end)::double as seconds from d group by decision""")
def k11_p14_table_policy_cost(t):
    d = t("documents").select(policies.for_table(F.length("text") % 5 != 0, (F.col("doc_id") % 100) / 100.0).alias("p")).select("p.*")
    return d.groupBy("decision").agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("seconds"))


@query("select event_type as color, (user_id % 10)::int as cluster, count(*) as n, round(avg(value), 4) as mean, min(value) as lo, max(value) as hi from events group by all")
def k14_scatter_summary(t):
    return rollups.scatter_summary(t("events").select(F.col("event_type").alias("color"), (F.col("user_id") % 10).cast("int").alias("cluster"), "value"))


@query("select user_id as fig, event_type as color, round(100.0 * count(*) / sum(count(*)) over (partition by user_id), 2)::double as pct from events group by 1, 2")
def k15_pie_spans(t):
    return rollups.pie_shares(t("events").select(F.col("user_id").alias("fig"), F.col("event_type").alias("color")))


@query("select user_id as series, (event_id % 12)::int as x, median(value)::double as y from events group by 1, 2")
def k17_line_medians(t):
    return rollups.line_medians(t("events").select(F.col("user_id").alias("series"), (F.col("event_id") % 12).cast("int").alias("x"), "value"))


@query("select slug, n_issues, coverage, n_pages from (select doc_id as slug, doc_id % 5 as n_issues, (doc_id % 13) / 10.0 as coverage, doc_id % 40 as n_pages from documents) where n_issues > 0 order by n_issues desc, coverage, n_pages, slug limit 10")
def o1_worst_papers(t):
    return rollups.worst_papers(t("documents").selectExpr("doc_id slug", "doc_id % 5 n_issues", "(doc_id % 13) / 10.0D coverage", "doc_id % 40 n_pages"))


#: Every conversation's turns with every benchmark text of their remainder; rows without a partner meet an empty text.
_PAIRS = "select c.conv_id, c.turn, b.item_id, coalesce(c.text, '') as a, coalesce(b.text, '') || ' ' || coalesce(c.text, '') as b from conversations c full join benchmark b on c.conv_id % 200 = b.item_id % 200"


def _pairs(t):
    j = t("conversations").alias("c").join(t("benchmark").alias("b"), F.expr("c.conv_id % 200 = b.item_id % 200"), "full")
    text = lambda c: F.coalesce(c, F.lit(""))
    return j.select("c.conv_id", "c.turn", "b.item_id", text("c.text").alias("a"), F.concat(text("b.text"), F.lit(" "), text("c.text")).alias("b"))


@query(f"""with p as ({_PAIRS}), s as (select *, list_distinct({_TOKENS.format('a')}) x, list_distinct({_TOKENS.format('b')}) y from p),
m as (select *, len(list_intersect(x, y)) i, len(x) nx, len(y) ny from s), q as (select *, case when nx > 0 then i / nx else 0 end::double p, case when nx > 0 and ny > 0 then i / ny else 0 end::double r from m)
select conv_id, turn, item_id, case when nx + ny - i > 0 then round(i / (nx + ny - i), 4) else 0 end::double as jaccard, round(p, 4) as "precision", round(r, 4) as recall,
case when p + r > 0 then round(2 * p * r / (p + r), 4) else 0 end::double as f1, case when length(b) > 0 then round(length(a) / length(b), 3) else 0 end::double as char_ratio from q""")
def t1_t2_t4_u1_u2_word_metrics(t):
    return metrics.word_metrics(_pairs(t), "a", "b").drop("a", "b")


@query(f"""with p as (select concat_ws('-', conv_id, turn, item_id) id, a, b from ({_PAIRS})), x as (select id, unnest({_TOKENS.format('a')}) w from p), y as (select id, unnest({_TOKENS.format('b')}) w from p),
nx as (select id, w, count(*) n from x group by all), ny as (select id, w, count(*) n from y group by all),
m as (select ny.id, sum(ny.n) n, sum(least(ny.n, coalesce(nx.n, 0))) k from ny left join nx using (id, w) group by ny.id)
select p.id, case when n > 0 then round(greatest(0, 1 - k / n), 4) else 1 end::double as wer from p left join m using (id)""")
def t3_u3_bag_wer(t):
    return metrics.bag_wer(_pairs(t).withColumn("id", F.concat_ws("-", "conv_id", "turn", "item_id")), "id", "a", "b")


@query("""with e as (select *, case when event_type = lag(event_type) over (partition by user_id order by event_id) then 0 else 1 end s from events),
r as (select *, sum(s) over (partition by user_id order by event_id) run from e) select user_id, run::bigint as run, event_type, count(*) as n, min(event_id) as first_id from r group by all""")
def w3_runs(t):
    return rollups.runs_of(t("events"), "user_id", "event_id", "event_type")


@query("""with s as (select user_id, event_type, max(value) score from events group by all), r as (select *, row_number() over (partition by user_id order by score desc, event_type) n, lead(score) over (partition by user_id order by score desc, event_type) runner_up from s)
select user_id, event_type as kind, score, round(score - coalesce(runner_up, 0), 6) as margin from r where n = 1""")
def w8_v20_top_and_margin(t):
    s = t("events").groupBy(F.col("user_id").alias("fig"), F.col("event_type").alias("kind")).agg(F.max("value").alias("score"))
    return rollups.top_and_margin(s).withColumnRenamed("fig", "user_id")


@query("""with c as (select user_id fig, event_id run_order, case event_type when 'click' then 'ok' when 'view' then 'partial' else 'failed' end status, round(value / (value + 10), 6) conf from events),
f as (select fig, min(run_order) stop from c where status = 'ok' and conf >= 0.8 group by fig), u as (select c.* from c left join f using (fig) where stop is null or run_order <= stop),
r as (select *, count(*) over (partition by fig) n_runs, row_number() over (partition by fig order by case status when 'ok' then 3 when 'partial' then 2 else 0 end desc, conf desc, run_order) k from u)
select fig, run_order, status, conf, n_runs from r where k = 1""")
def p1_cascade(t):
    status = F.expr("case event_type when 'click' then 'ok' when 'view' then 'partial' else 'failed' end")
    return rollups.cascade(t("events").select(F.col("user_id").alias("fig"), F.col("event_id").alias("run_order"), status.alias("status"), F.round(F.col("value") / (F.col("value") + 10), 6).alias("conf")))


@query(r"""with s as (select doc_id, regexp_replace(text, '\s+', ' ', 'g') raw, case doc_id % 3 when 0 then 'verified' when 1 then 'mismatch' else 'not_found' end verdict from documents)
select doc_id, case when raw = '' then 'skip' when verdict = 'verified' then 'skip' when verdict = 'mismatch' then 'replace' when length(raw) < 30 then 'extract' when length(regexp_replace(raw, '[^\p{L}]', '', 'g')) / greatest(1, length(raw)) < 0.55 then 'extract' else 'skip' end as decision from s""")
def p13_reference_policy(t):
    s = t("documents").select("doc_id", F.regexp_replace("text", r"\s+", " ").alias("raw"), F.expr("case doc_id % 3 when 0 then 'verified' when 1 then 'mismatch' else 'not_found' end").alias("verdict"))
    return s.select("doc_id", policies.for_reference(F.col("raw"), F.col("verdict"))["decision"].alias("decision"))


@query("""with g as (select user_id kind, value v, row_number() over (partition by user_id order by value, event_id) r from events where event_type = 'click'), h as (select user_id kind, value v, row_number() over (partition by user_id order by value, event_id) r from events where event_type = 'view')
select kind, count(*) as n, round(avg(abs(g.v - h.v)), 4) as mae from g join h using (kind, r) group by kind""")
def t6_rank_error(t):
    side = lambda k: t("events").where(F.col("event_type") == k).select(F.col("user_id").alias("kind"), "value", F.col("event_id").alias("id"))
    return rollups.rank_error(side("click"), side("view"))


@query("""select l_orderkey, l_linenumber, least(2, floor((l_quantity * 10 + 30) / 600.0 * 3))::bigint as col, round(l_discount * 2.5 + 7, 6) as value,
least(1.0, greatest(0.0, (l_quantity - 10) / 30.0))::double as scaled from lineitem""")
def g12_g27_v6_geometry(t):
    q = F.col("l_quantity")
    geometry = [rollups.column_of(q * 10 + 30, 600.0, 3).cast("long").alias("col"), F.round(rollups.calibrated(F.col("l_discount"), 2.5, 7), 6).alias("value"), rollups.clamped(q, 10, 40).cast("double").alias("scaled")]
    return t("lineitem").select("l_orderkey", "l_linenumber", *geometry)


_SPANS = "select l_orderkey as line, l_linenumber as span, (6 + l_quantity % 5)::double as size, (l_partkey % 8)::double as baseline from lineitem"


@query(f"""with s as ({_SPANS}), m as (select line, list_sort(list(size))[count(*) // 2 + 1] med, list_sort(list(baseline))[count(*) // 2 + 1] base from s group by line)
select s.line, span, case when size <= 0.85 * med and base - baseline >= 0.15 * med then 'super' when size <= 0.85 * med and baseline - base >= 0.15 * med then 'sub' else 'body' end as role from s join m using (line)""")
def g15_span_roles(t):
    return rollups.span_roles(t("lineitem").selectExpr("l_orderkey line", "l_linenumber span", "cast(6 + l_quantity % 5 as double) size", "cast(l_partkey % 8 as double) baseline"))


@query("""with f as (select p_partkey fig, p_size num, case when p_partkey % 3 = 0 then ' ' else p_name end caption from part), c as (select ps num, min(n) caption from (select s_suppkey % 50 + 1 ps, s_name n from supplier) group by ps)
select fig, f.num, coalesce(nullif(trim(f.caption), ''), c.caption) as caption from f left join c on f.num = c.num""")
def j8_backfill_captions(t):
    f = t("part").select(F.col("p_partkey").alias("fig"), F.col("p_size").alias("num"), F.expr("case when p_partkey % 3 = 0 then ' ' else p_name end").alias("own"))
    return rollups.backfilled(f, t("supplier").select((F.col("s_suppkey") % 50 + 1).alias("num"), F.col("s_name").alias("text")).withColumnRenamed("num", "num"))


@query("""with x as (select distinct user_id d, event_id % 50 m from events where event_type = 'view'), y as (select distinct user_id d, event_id % 50 m from events where event_type = 'click')
select d as doc, m as marker from x where not exists (select 1 from y where y.d = x.d and y.m = x.m)""")
def u4_orphan_markers(t):
    side = lambda k: t("events").where(F.col("event_type") == k).select(F.col("user_id").alias("doc"), (F.col("event_id") % 50).alias("marker"))
    return rollups.orphans(side("view"), side("click"), "doc", "marker")


@query("""select user_id as fig, (event_id % 6)::int as bar, coalesce(sum(value) filter (event_type = 'click'), 0)::double as click, coalesce(sum(value) filter (event_type = 'view'), 0)::double as "view", round(sum(value), 4)::double as total
from events where event_type in ('click', 'view') group by 1, 2""")
def k16_stacked_matrix(t):
    return rollups.stacked_matrix(t("events").select(F.col("user_id").alias("fig"), (F.col("event_id") % 6).cast("int").alias("bar"), F.col("event_type").alias("kind"), "value"), ["click", "view"])


@query("""with s as (select user_id fig, count(*) n, count(*) filter (event_type = 'click') ok, count(*) filter (event_type = 'view') partial from events group by 1)
select fig, case when ok = n then 'ok' when ok + partial > 0 then 'partial' else 'failed' end as status, round((0.95 * ok + 0.5 * partial) / n, 6)::double as confidence from s""")
def k18_multipanel_rollup(t):
    return rollups.panel_status(t("events").select(F.col("user_id").alias("fig"), F.expr("case event_type when 'click' then 'ok' when 'view' then 'partial' end").alias("status")))


@query("""select event_type as kind, (user_id % 3)::int as cond, count(*) as n, round(avg((value > 20)::int), 6)::double as accuracy from events
group by grouping sets ((event_type, (user_id % 3)::int), (event_type), ((user_id % 3)::int), ())""")
def k19_accuracy_by_kind(t):
    return rollups.accuracies(t("events").select(F.col("event_type").alias("kind"), (F.col("user_id") % 3).cast("int").alias("cond"), (F.col("value") > 20).cast("int").alias("hit")))


@query("""with s as (select user_id, event_type, max(value) / 100 score from events group by all), r as (select *, row_number() over (partition by user_id order by score desc, event_type) n from s)
select user_id, string_agg(event_type, '>' order by n) as ladder from r where n <= 3 and score >= 0.15 group by user_id""")
def o3_specialist_ladder(t):
    s = t("events").groupBy(F.col("user_id").alias("fig"), F.col("event_type").alias("kind")).agg((F.max("value") / 100).alias("score"))
    return rollups.ladder(s).withColumnRenamed("fig", "user_id")


@query("""with n as (select l_orderkey fig, l_linenumber node, l_quantity * 10 x, (l_partkey % 100) * 5.0 y from lineitem where l_linenumber <= 4), p as (select l_orderkey fig, l_linenumber pt, l_quantity * 10 px, (l_suppkey % 100) * 5.0 py from lineitem where l_linenumber > 4),
d as (select p.fig, pt, node, (px - x) * (px - x) + (py - y) * (py - y) d2 from p join n on p.fig = n.fig), r as (select *, row_number() over (partition by fig, pt order by d2, node) k from d where d2 <= 6400)
select fig, pt, node from r where k = 1""")
def j14_nearest_node(t):
    li = t("lineitem")
    n = li.where("l_linenumber <= 4").selectExpr("l_orderkey fig", "l_linenumber node", "l_quantity * 10 x", "(l_partkey % 100) * 5.0D y")
    return rollups.nearest_nodes(li.where("l_linenumber > 4").selectExpr("l_orderkey fig", "l_linenumber pt", "l_quantity * 10 px", "(l_suppkey % 100) * 5.0D py"), n)