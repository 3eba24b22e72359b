"""What a figure shows, whether its extraction is credible, which of several extractions wins, what comes next.

Features of images (counts of bars, circles, boxes and colours, axes and the like) are columns here; how they are
measured is another matter. Everything is an expression over one row, or a ranking of the few candidates of a figure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.functions.text import let

# Words that tell what kind a figure is, kinds in the order in which they win ties.
KEYWORDS = {
    "flow_diagram": ("workflow", "flowchart", "flow chart", "flow diagram", "pipeline", "process diagram", "process flow", "step", "scheme", "schema", "framework", "decision tree"),
    "schematic": ("schematic", "diagram of", "conceptual model", "concept map", "structure of", "architecture", "model structure", "components", "overview of the", "illustration of"),
    "map": ("map of", "map showing", "geographic", "study area", "study site", "study location", "location of", "site map", "aerial", "satellite", "spatial distribution", "region", "country", "watershed", "basin"),
    "bar_chart": ("bar chart", "bar plot", "bar graph", "histogram", "frequency", "proportion of", "proportions of", "percentage of", "mean of", "average", "colonies per", "kg per", "mg per", "ha-1", "yield", "log-transformed", "log10"),
    "stacked_bar_chart": ("stacked bar", "stacked-bar", "stacked column", "land use", "land cover", "cover type", "composition", "proportion of", "share of", "breakdown of"),
    "box_plot": ("box plot", "boxplot", "box-and-whisker", "whisker", "quartile", "median", "interquartile"),
    "line_plot": ("line plot", "line graph", "time series", "trend", "over time", "over the years", "annual", "monthly", "evolution", "trajectory"),
    "scatter_plot": ("scatter", "scatterplot", "regression", "correlation", "ordination", "rda", "pca", "nmds", "biplot", "non-metric multidimensional", "principal component"),
    "pie_chart": ("pie chart", "pie", "donut", "doughnut", "share of", "composition"),
    "photo": ("photograph", "photo of", "image of", "view of", "picture of", "field photograph", "aerial photo", "ground photograph"),
    "equation": ("equation", "formula", "mathematical expression"),
    "table_as_image": ("table", "matrix"),
    "data_plot": ("effect estimate", "estimate of", "ci", "confidence interval", "error bar"),
}
# Phrases that settle the kind, in order, with the reason given.
STRONG = (
    (r"\b(workflow|flowchart|pipeline)\b", "flow_diagram", "strong-hint:workflow/flowchart/pipeline"),
    (r"\bbox\s*plots?\b|\bbox-and-whisker\b", "box_plot", "strong-hint:boxplot"),
    (r"\bnmds\b|\brda\d?\b|\bpca\b|\bordination\b", "scatter_plot", "strong-hint:ordination"),
    (r"\bmap\s+(of|showing)\b|\bstudy\s+area\b|\baerial\s+photo", "map", "strong-hint:map/study area"),
    (r"\bphotograph\b|\bphoto\s+of\b", "photo", "strong-hint:photograph"),
    (r"\b(stacked|grouped)\s+bar\b", "stacked_bar_chart", "strong-hint:stacked/grouped bar"),
    (r"\bland\s+(use|cover)\s+composition\b|\bcomposition\s+by\b", "stacked_bar_chart", "strong-hint:composition"),
)
# What a status is worth.
STATUS = {"ok": 4.0, "partial": 2.0, "no_bars": 0.3, "no_axis": 0.3, "ocr_failed": 0.1, "unsupported": 0.0, "error": 0.0}
# Prompts by caption, in order, and the form of their answers.
PROMPTS = (
    (r"(?i)\b(algorithm|pseudo[- ]?code)\b", "algorithm", "pseudocode"),
    (r"(?i)\b(gel|blot|western|northern|southern|electrophore\w+|PAGE)\b", "gel_blot", "alt_text"),
    (r"(?i)\b(code\s+(listing|snippet|sample)|source\s+code|function\s+definition|class\s+definition|listing\s+\d+|^listing\b)\b", "code_listing", "code"),
    (r"(?i)\b(equation|formula|mathematical\s+expression)\b", "equation", "latex"),
    (r"(?i)\b(decision\s+tree|classification\s+tree)\b", "decision_tree", "mermaid"),
    (r"(?i)\bsankey\b", "sankey", "mermaid"),
    (r"(?i)\b(screenshot|user\s+interface|UI\b|web\s+page)\b", "screenshot", "alt_text"),
    (r"(?i)\b(micrograph|microscopy|histolog\w+|fluoresce\w+|SEM|TEM|H&E)\b", "microscopy", "alt_text"),
)
# Verbs of captions that say something, and words that only announce a figure.
VERBS = ("shows", "depicts", "illustrates", "presents", "displays", "compares", "summarises", "summarizes", "describes", "indicates", "represents", "demonstrates", "highlights", "plots", "visualises", "visualizes")
OPENERS = ("fig", "figure", "fig.", "image", "graphic", "plot", "chart", "diagram")
NUMBERED = r"(?i)^\s*(?:figure|fig\.?|fig)\s*\d+[a-z]?\s*[:.\-—)]?\s*"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def thousandths(c: Column) -> Column:
    return F.floor(c * 1000 + 0.5) / 1000


def scale(x: Column, low: float, high: float) -> Column:
    """x between low and high as 0 to 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - low) / (high - low)))


def keyword_counts(text: Column) -> Column:
    """How many words of each kind a lower-cased text holds, in the order of KEYWORDS; a word of two kinds is sought once."""
    words = list(dict.fromkeys(w for ws in KEYWORDS.values() for w in ws))
    held = F.array(*[F.contains(text, F.lit(w)).cast("int") for w in words])
    count = lambda h, ws: sum((F.get(h, F.lit(words.index(w))) for w in ws[1:]), F.get(h, F.lit(words.index(ws[0]))))
    return let(held, lambda h: F.array(*[count(h, ws) for ws in KEYWORDS.values()]))


def _reason(text: Column, i: Column) -> Column:
    """The first three words of the i-th kind that a text holds, as a reason."""
    words = F.get(F.array(*[F.array(*map(F.lit, ws)) for ws in KEYWORDS.values()]), i)
    return F.concat(F.lit("keyword-match:"), F.array_join(F.slice(F.filter(words, lambda k: F.contains(text, k)), 1, 3), ","))


def most_keywords(text: Column) -> Column:
    """Struct (n, i, kind, reason), n negative: the kind with most words, the earlier of equals."""

    def best(t: Column, counts: Column) -> Column:
        n = F.array_max(counts)
        return let((F.array_position(counts, n) - 1).cast("int"), lambda i: F.struct((-n).alias("n"), i.alias("i"), F.get(F.array(*map(F.lit, KEYWORDS)), i).alias("kind"), _reason(t, i).alias("reason")))

    return let(text, lambda t: let(keyword_counts(t), lambda c: best(t, c)))


def classify(caption: Column, ocr: Column) -> Column:
    """Struct (kind, reason) from the caption, or where there is none from the text in the figure."""
    some = lambda c: F.length(F.coalesce(c, F.lit(""))) > 0
    text = _strip(F.lower(F.when(some(caption), caption).when(some(ocr), ocr).otherwise("")))
    say = lambda kind, reason: F.struct(F.lit(kind).alias("kind"), F.lit(reason).alias("reason"))

    def kind_of(t: Column) -> Column:
        out = F.when(t == "", say("unknown", "no-caption-no-ocr"))
        for pattern, kind, reason in STRONG:
            out = out.when(t.rlike(pattern), say(kind, reason))
        named = lambda b: F.when(b["n"] == 0, say("unknown", "no-keyword-match")).otherwise(F.struct(b["kind"].alias("kind"), b["reason"].alias("reason")))
        return out.otherwise(let(most_keywords(t), named))

    return let(text, kind_of)


def decorative(w: Column, h: Column, f: dict[str, Column]) -> Column:
    """Why an image is no figure, or null: thin, tiny, or a banner or few colours without structure."""
    plain = ~(f["axes"] | (f["rects"] >= 3) | (f["bars"] >= 2) | (f["circles"] >= 1) | (f["text_share"] > 0.04))
    return F.when((h < 40) | (w < 40), "thin").when(w * h < 6000, "tiny").when(((f["aspect"] > 8) | (f["aspect"] < 0.125)) & plain, "banner").when((f["colours"] < 4) & plain, "monochrome")


def specialists(caption: Column, ocr: Column, f: dict[str, Column]) -> Column:
    """Array of structs (kind, score, cap), one a kind: how well it fits features f, with has for whether there are any.

    f has has, axes, bars, colours, circles, density, rects, aspect, text_share, math, gray and decor.
    """
    text = F.lower(F.concat_ws(" ", F.coalesce(caption, F.lit("")), F.coalesce(ocr, F.lit(""))))
    return let(let(text, keyword_counts), lambda counts: _specialists(caption, ocr, f, counts))


def _specialists(caption: Column, ocr: Column, f: dict[str, Column], counts: Column) -> Column:
    o = F.coalesce(ocr, F.lit(""))
    with_data = lambda c: F.when(f["has"], c).otherwise(0.0)
    less = lambda c, *r: with_data(1.0 - scale(c, *r))
    more = lambda c, *r: with_data(scale(c, *r))
    axis = F.when(~f["has"], 0.5).when(f["axes"], 1.0).otherwise(0.0)
    no_axis = F.when(~f["has"], 0.5).when(~f["axes"], 1.0).otherwise(0.0)
    circle = F.when(f["circles"] == 1, 1.0).when((f["circles"] == 2) & (f["bars"] == 0), 0.7).when(f["circles"] >= 3, 0.2).otherwise(0.0)
    circle = with_data(circle * F.when(f["bars"] >= 3, 0.2).otherwise(1.0))
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    digits = F.length(o) - F.length(F.regexp_replace(o, "[0-9]", ""))
    photo = more(f["colours"], 60, 250) * less(f["text_share"], 0.03, 0.20) * flag(f["bars"] <= 1)
    seen = _words(F.coalesce(caption, F.lit("")))
    parts = {
        "bar_chart": [(0.30, more(f["bars"], 2, 12)), (0.30, None), (0.15, F.when(o.rlike("[0-9]"), 1.0).otherwise(0.3)), (0.25, axis)],
        "stacked_bar_chart": [(0.30, more(f["bars"], 2, 12)), (0.25, None), (0.20, more(f["colours"], 6, 30)), (0.25, axis)],
        "pie_chart": [(0.55, circle), (0.35, None), (0.10, flag(F.contains(o, F.lit("%"))))],
        "line_plot": [(0.25, more(f["density"], 0.005, 0.05)), (0.20, None), (0.15, less(f["rects"], 0, 6)), (0.10, less(f["bars"], 0, 6)), (0.30, axis)],
        "scatter_plot": [(0.30, more(f["rects"], 10, 100)), (0.20, None), (0.15, less(f["bars"], 0, 4)), (0.10, scale(F.regexp_count(o, F.lit(r"\b[0-9]+(?:\.[0-9]+)?\b")), 4, 20)), (0.25, axis)],
        "box_plot": [(0.25, more(f["rects"], 2, 8)), (0.45, None), (0.30, axis)],
        "flow_diagram": [(0.25, more(f["rects"], 3, 15)), (0.35, None), (0.20, more(f["density"], 0.005, 0.03)), (0.20, no_axis)],
        "schematic": [(0.30, more(f["rects"], 3, 15)), (0.50, None), (0.20, no_axis)],
        "map": [(0.55, None), (0.25, more(f["colours"], 10, 80)), (0.20, less(f["bars"], 0, 4))],
        "photo": [(0.65, None), (0.35, photo)],
        "equation": [(0.30, None), (0.25, flag(f["has"] & (f["aspect"] > 2.5))), (0.30, flag(o.rlike("[=∑∫√≤≥±·×÷]") | f["has"] & f["math"])), (0.15, no_axis)],
        "table_as_image": [(0.30, None), (0.30, more(f["density"], 0.008, 0.04)), (0.25, scale(digits / F.greatest(F.lit(1), F.length(o)), 0.05, 0.30)), (0.15, flag(f["has"] & f["gray"]))],
        "decorative": [(0.70, flag(f["has"] & f["decor"])), (0.30, None)],
    }
    out = []
    for kind, terms in parts.items():
        cap = F.least(F.lit(1.0), F.get(counts, F.lit(list(KEYWORDS).index(kind))) / 3.0) if kind in KEYWORDS else F.lit(0.0)
        score = sum((F.lit(w) * (cap if x is None else x) for w, x in terms), F.lit(0.0))
        if kind == "decorative":  # a proper caption speaks against it
            score = score * F.when(F.size(seen) >= 4, 0.4).otherwise(1.0)
        out.append(F.struct(F.lit(kind).alias("kind"), thousandths(score).alias("score"), cap.alias("cap")))
    return F.array(*out)


def mixture(scores: Column, decisive: float = 0.66) -> Column:
    """Struct (kind, confidence, margin) of the specialists' scores: a caption that is decisive comes first."""
    return let(scores, lambda s: _mixture(s, decisive))


def _mixture(scores: Column, decisive: float) -> Column:
    def of(ranked: Column, cap: Column) -> Column:
        top = F.greatest(cap["score"], -cap["n"])
        rest = F.filter(ranked, lambda x: x["kind"] != cap["kind"])
        named = F.struct(cap["kind"].alias("kind"), top.alias("confidence"), thousandths(top + F.get(rest, F.lit(0))["n"]).alias("margin"))
        one, two = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
        seen = F.struct(one["kind"].alias("kind"), (-one["n"]).alias("confidence"), thousandths(two["n"] - one["n"]).alias("margin"))
        return F.when(-cap["n"] >= decisive, named).otherwise(seen)

    ranked = F.sort_array(F.transform(scores, lambda x, i: F.struct((-x["score"]).alias("n"), i.alias("i"), x["kind"].alias("kind"))))
    cap = F.array_min(F.transform(scores, lambda x, i: F.struct((-x["cap"]).alias("n"), i.alias("i"), x["kind"].alias("kind"), x["score"].alias("score"))))
    return let(ranked, lambda r: let(cap, lambda c: of(r, c)))


def hybrid(caption: Column, ocr: Column, scores: Column, least: int = 2) -> Column:
    """Struct (kind, confidence, margin): by words alone where some kind has two, otherwise by the mixture."""
    best = most_keywords(F.lower(F.concat_ws(" ", F.coalesce(caption, F.lit("")), F.coalesce(ocr, F.lit("")))))
    score = lambda b: thousandths(F.least(F.lit(1.0), -b["n"] / 3.0))
    return let(best, lambda b: F.when(-b["n"] >= least, F.struct(b["kind"].alias("kind"), score(b).alias("confidence"), score(b).alias("margin"))).otherwise(mixture(scores)))


def credibility(bars: Column, percents: Column, boxes: Column, samples: Column, clusters: Column, cells: Column) -> Column:
    """From -1 to 1, how plausible extracted data are.

    bars: how many; percents of wedges; boxes (median, q1, q3, low, high); samples: how many of each series; clusters
    (n, x_min, x_max, y_min, y_max, x_mean, y_mean); cells: rows of a matrix. What is null or empty says nothing.
    """
    some = lambda a, c: F.when(F.coalesce(F.size(a), F.lit(0)) > 0, c).otherwise(0.0)
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    n_boxes, med = F.size(boxes), F.transform(boxes, lambda b: b["median"])
    spread = (F.array_max(med) - F.array_min(med)) / F.coalesce(F.nullif(F.array_max(F.transform(med, F.abs)), F.lit(0.0)), F.lit(1.0))
    height = lambda b: F.coalesce(F.nullif(F.abs(b["q3"] - b["q1"]), F.lit(0.0)), F.lit(1.0))
    whiskers = F.size(F.filter(boxes, lambda b: (F.abs(b["high"] - b["q3"]) / height(b) > 0.20) | (F.abs(b["q1"] - b["low"]) / height(b) > 0.20)))
    total, markers = add(percents), F.aggregate(clusters, F.lit(0).cast("long"), lambda s, c: s + c["n"])
    means = F.transform(clusters, lambda c: F.struct(F.round(c["x_mean"], 2).alias("x"), F.round(c["y_mean"], 2).alias("y")))
    full = F.aggregate(F.transform(cells, lambda r: F.size(F.filter(r, lambda v: v != 0))), F.lit(0), lambda s, x: s + x)
    terms = (
        F.when(bars >= 3, 0.3).when(bars == 1, -0.5).otherwise(0.0),
        some(percents, F.when(F.size(percents) >= 3, 0.3).when(F.size(percents) < 2, -0.5).otherwise(0.0) + F.when(total.between(95, 105), 0.2).otherwise(-0.3)),
        some(boxes, F.when(n_boxes >= 3, 0.2).otherwise(0.0) + F.when(spread < 0.15, -0.6).when(spread >= 0.5, 0.3).otherwise(0.0) + F.when(whiskers >= F.greatest(F.lit(1), F.floor(n_boxes / 2)), 0.3).otherwise(-0.6)),
        some(samples, F.when(F.exists(samples, lambda x: x >= 4), 0.2).otherwise(-0.3)),
        some(clusters, F.when(markers >= 15, 0.4).when(markers >= 5, 0.2).otherwise(0.0) + F.when(F.exists(clusters, lambda c: (c["x_max"] > c["x_min"]) & (c["y_max"] > c["y_min"])), 0.1).otherwise(0.0) - F.when(F.size(F.array_distinct(means)) < F.size(means), 0.3).otherwise(0.0)),
        some(cells, F.when((F.size(cells) >= 2) & (full >= 4), 0.3).otherwise(-0.3)),
    )
    return thousandths(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sum(terms, F.lit(0.0)))))


def quality(status: Column, confidence: Column, credible: Column) -> Column:
    worth = F.element_at(F.create_map(*[F.lit(x) for kv in STATUS.items() for x in kv]), status)
    base = F.coalesce(worth, F.lit(0.0)) + F.least(F.lit(1.0), F.coalesce(confidence, F.lit(0.0)))
    return base + F.when(status.isin("ok", "partial"), credible).otherwise(0.0)


def arbitrate(candidates: DataFrame) -> DataFrame:
    """(fig, kind, quality, why) from candidates (fig, kind, run, quality, hint): the best extraction of each figure.

    The hinted kind goes before it where all have failed, and where it is among three that are close. A figure has a
    candidate per kind, so they are gathered into one row.
    """
    g = candidates.groupBy("fig").agg(F.array_sort(F.collect_list(F.struct((-F.col("quality")).alias("n"), "run", "kind"))).alias("r"), F.first("hint").alias("hint"))
    top, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    hinted = lambda among: F.get(F.filter(among, lambda x: x["kind"] == F.col("hint")), F.lit(0))
    failed, close = -top["n"] < 0.5, (second["n"] - top["n"]) < 0.3
    pick = F.when(failed, hinted(F.col("r"))).when(close, hinted(F.slice("r", 1, 3)))
    g = g.withColumn("p", F.coalesce(pick, top)).withColumn("why", F.when(F.col("p.kind") == top["kind"], "highest").when(failed, "all failed").otherwise("close call"))
    return g.select("fig", "p.kind", (-F.col("p.n")).alias("quality"), "why")


def reflect(status: Column, confidence: Column, reason: Column, bars: Column, expected: Column, extractor: Column, ladder: Column, retried: Column) -> Column:
    """Struct (action, kind, gain): what to do with an extraction that came out like this; ladder has the kinds to try."""
    say = lambda action, kind=None, gain=0.0: F.struct(F.lit(action).alias("action"), (kind if kind is not None else F.lit(None).cast("string")).alias("kind"), F.lit(gain).alias("gain"))
    other = F.get(F.filter(ladder, lambda k: ~F.startswith(extractor, F.split_part(k, F.lit("/"), F.lit(1)))), F.lit(0))
    free = F.get(F.filter(ladder, lambda k: k.rlike("pie|diagram|schematic")), F.lit(0))
    first = F.get(ladder, F.lit(0))
    next_ = lambda kind: F.when(kind.isNotNull(), say("next_kind", kind)).otherwise(say("give_up"))
    missed = (confidence < 0.7) & (bars > 0) & (expected >= bars + 2)
    label = F.lower(F.coalesce(reason, F.lit(""))).rlike("label|missing")
    out = F.when((status == "ok") & missed & ~retried, say("retry", gain=0.2)).when(status == "ok", say("accept"))
    out = out.when((status == "partial") & label & ~retried, say("retry", gain=0.1)).when(status == "partial", say("accept"))
    out = out.when(status == "no_bars", next_(other)).when(status == "no_axis", next_(free))
    return out.when((status == "ocr_failed") & ~retried, say("retry", gain=0.15)).when(status == "unsupported", next_(first)).otherwise(say("give_up"))


def assess_caption(c: Column) -> Column:
    """From 0 to 1, whether a caption does without a model's description."""
    c = _strip(F.coalesce(c, F.lit("")))
    body = _strip(F.regexp_replace(c, NUMBERED, ""))
    n, low = F.size(_words(body)), F.lower(body)
    score = F.when(n >= 12, 0.30).when(n >= 8, 0.15).otherwise(0.0) + F.when(body.rlike(r"[.?!]$"), 0.20).otherwise(0.0)
    score = score + F.when(F.exists(F.array(*[F.lit(v) for v in VERBS]), lambda v: F.contains(low, v)), 0.20).otherwise(0.0)
    score = score + F.when(F.get(_words(low), F.lit(0)).isin(*OPENERS), 0.0).otherwise(0.15) + F.when(body.rlike(r"\b[0-9]+(?:\.[0-9]+)?\b"), 0.15).otherwise(0.0)
    return F.when((F.size(_words(c)) < 6) | (n < 5), 0.0).otherwise(thousandths(score))


def alt_text(caption: Column, teacher: Column, enough: float = 0.55, most: int = 280) -> Column:
    """Struct (alt, source): the caption if it is good enough, a model's answer if there is one, the caption, nothing."""
    short = lambda c: F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 1), F.lit("…"))).otherwise(c)
    tidy = lambda c: short(F.array_join(_words(F.coalesce(c, F.lit(""))), " "))
    say = lambda c, source: F.struct(c.alias("alt"), F.lit(source).alias("source"))
    return F.when(assess_caption(caption) >= enough, say(tidy(caption), "student")).when(F.length(_strip(teacher)) > 0, say(tidy(teacher), "teacher")).when(F.length(_strip(caption)) > 0, say(tidy(caption), "caption_only")).otherwise(say(F.lit(""), "empty"))


def for_figure(status: Column) -> Column:
    """Struct (decision, cost): what a model should do about a figure, by the status of its extraction."""
    say = lambda d, cost: F.struct(F.lit(d).alias("decision"), F.lit(cost).alias("cost"))
    return F.when(status == "ok", say("validate", 40.0)).when(status == "partial", say("validate", 60.0)).otherwise(say("extract", 120.0))


def prompt_for(caption: Column) -> Column:
    """Struct (subkind, form) of the prompt that a caption calls for."""
    say = lambda a, b: F.struct(F.lit(a).alias("subkind"), F.lit(b).alias("form"))
    out = F.when(F.coalesce(caption, F.lit("")) == "", say("generic", "alt_text"))
    for pattern, kind, form in PROMPTS:
        out = out.when(caption.rlike(pattern), say(kind, form))
    return out.otherwise(say("generic", "alt_text"))


def trimmed_answer(raw: Column, form: Column) -> Column:
    """A model's answer cut to its first fenced block, or put between signs of LaTeX, as its form asks."""
    raw = _strip(raw)
    fence = r"(?s)(```[A-Za-z0-9_]*\s*\n.*?\n```)"
    bare = ~F.contains(raw, F.lit("$$")) & ~F.startswith(raw, F.lit("$"))
    cut = F.when(form.isin("code", "pseudocode", "mermaid") & raw.rlike(fence), F.regexp_extract(raw, fence, 1))
    return F.coalesce(cut, F.when((form == "latex") & bare & (raw != ""), F.concat(F.lit("$$ "), F.regexp_replace(raw, r"\$+$", ""), F.lit(" $$"))), raw)


def verdict(answer: Column) -> Column:
    """Struct (verdict, note) from the first line of a model's check."""
    line = _strip(F.split_part(_strip(F.coalesce(answer, F.lit(""))), F.lit("\n"), F.lit(1)))
    note = _strip(F.regexp_replace(F.substring(line, 5, 1 << 30), "^[:\\-– ]+", ""))
    say = lambda v, n: F.struct(F.lit(v).alias("verdict"), n.alias("note"))
    return F.when(F.lower(line).startswith("ok"), say("ok", F.lit(""))).when(F.lower(line).startswith("flag"), say("flag", note)).otherwise(say("skipped", F.lit("non-conforming output")))


def shape(fill: Column, roundness: Column, corners: Column) -> Column:
    """A node's shape from the share of its box that it fills, its circularity and its corners."""
    return F.when((roundness > 0.85) & (corners >= 5), "circle").when((corners == 4) & (fill < 0.65), "diamond").when((corners == 4) & (fill < 0.92), "rounded").when((corners >= 5) & (fill > 0.78), "rounded").otherwise("rect")


def real_label(c: Column) -> Column:
    return ~c.startswith("Node ") & (F.length(_strip(c)) >= 2) & c.rlike(r"\p{L}")


def diagrams(nodes: DataFrame, edges: DataFrame, least: float = 0.3) -> DataFrame:
    """(fig, status, mermaid) from nodes (fig, id, label, shape) and edges (fig, src, dst, directed, label).

    A figure under the least share of real labels is no diagram. Nodes and edges of a figure are gathered into its row.
    """
    safe = F.array_join(_words(F.translate("label", "[](){}|", "       ")), " ")
    safe = F.when(safe == "", F.col("id")).otherwise(safe)
    ends = {"diamond": ("{", "}"), "circle": ("((", "))"), "rounded": ("(", ")"), "parallelogram": ("[/", "/]")}
    text = F.concat("id", F.lit("["), safe, F.lit("]"))
    for k, (a, b) in ends.items():
        text = F.when(F.col("shape") == k, F.concat("id", F.lit(a), safe, F.lit(b))).otherwise(text)
    n = nodes.groupBy("fig").agg(F.array_sort(F.collect_list(F.struct("id", F.concat(F.lit("    "), text).alias("t")))).alias("n"), F.avg(F.when(real_label(F.col("label")), 1.0).otherwise(0.0)).alias("real"))
    arrow = F.when(F.col("directed"), "-->").otherwise("---")
    named = F.when(F.length("label") > 0, F.concat(F.lit("|"), "label", F.lit("|")))
    e = edges.groupBy("fig").agg(F.array_sort(F.collect_list(F.struct("src", "dst", F.concat(F.lit("    "), "src", F.lit(" "), arrow, F.coalesce(named, F.lit("")), F.lit(" "), "dst").alias("t")))).alias("e"))
    lines = lambda c: F.transform(F.coalesce(c, F.array().cast("array<struct<t:string>>")), lambda x: x["t"])
    j = n.join(e.withColumn("e", F.transform("e", lambda x: F.struct(x["t"].alias("t")))), "fig", "left").withColumn("n", F.transform("n", lambda x: F.struct(x["t"].alias("t"))))
    body = F.array_join(F.concat(F.array(F.lit("```mermaid"), F.lit("flowchart LR")), lines(F.col("n")), lines(F.col("e")), F.array(F.lit("```"))), "\n")
    fine = F.col("real") >= least
    return j.select("fig", F.when(fine, "ok").otherwise("no_nodes").alias("status"), F.when(fine, body).alias("mermaid"))
