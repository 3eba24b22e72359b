"""Expressions that put right what extraction did to text, read models' answers, and format what was measured."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexflume.functions.cleaning import BANNER, code_block, is_echo, is_good_title
from lexflume.functions.text import expand_ligatures, journal_like, let, normalise_math_glyphs

# Diacritics that stand alone and the combining marks they stand for; vowels that bear them.
DIACRITICS = {"¨": "̈", "˘": "̆", "˙": "̇", "˜": "̃", "´": "́", "ˆ": "̂"}
TRAILING = "¨˘˙˜ˆ"
VOWELS = "aeiouyAEIOUY"
# Names and words whose diacritics are lost for good, and what they are.
KNOWN = {
    "Schodl": "Schödl", "Konigslow": "Königslöw", "Konïgsl ow": "Königslöw", "Konïgslow": "Königslöw", "Universitat": "Universität", "Universitatsmedizin": "Universitätsmedizin",
    "Bathe": "Bäthe", "Bohm": "Böhm", "Hohenheim": "Hohenheim", "Ernahrung": "Ernährung", "Bundesamt fur": "Bundesamt für", "fur Kartographie": "für Kartographie", "Geodasie": "Geodäsie",
    "Schaffer": "Schäffer", "Schafer": "Schäfer", "Kohler": "Köhler", "Mockel": "Möckel", "Muller": "Müller", "Danhardt": "Dänhardt", "Batary": "Batáry", "Baden-Bohm": "Baden-Böhm",
    "baden-bohm": "baden-böhm", "Pollath": "Polláth", "Tscharntke": "Tscharntke",
}
# Words that lost the rest of a ligature, and what they are.
DROPPED = {
    "fower": "flower", "fowers": "flowers", "fowering": "flowering", "fowered": "flowered", "Fower": "Flower", "Fowering": "Flowering", "Fowers": "Flowers", "wildfower": "wildflower",
    "Wildfower": "Wildflower", "wildfowers": "wildflowers", "Wildfowers": "Wildflowers", "sunfower": "sunflower", "sunfowers": "sunflowers", "mayfower": "mayflower",
    "fora": "flora", "foral": "floral", "forist": "florist", "fuid": "fluid", "fuids": "fluids", "fush": "flush", "fux": "flux", "fuxes": "fluxes",
    "fexible": "flexible", "fexibility": "flexibility", "fexed": "flexed", "fexing": "flexing", "fexion": "flexion", "fourishing": "flourishing", "fourish": "flourish", "fourished": "flourished",
    "overfow": "overflow", "underfow": "underflow", "signifcant": "significant", "signifcantly": "significantly", "signifcance": "significance", "insignifcant": "insignificant",
    "Signifcant": "Significant", "Signifcantly": "Significantly", "Signifcance": "Significance", "feld": "field", "felds": "fields", "feldwork": "fieldwork", "Field": "Field",
    "frst": "first", "Frst": "First", "fnd": "find", "fnds": "finds", "fnal": "final", "fnally": "finally", "fnding": "finding", "fndings": "findings",
    "defne": "define", "defned": "defined", "defnition": "definition", "defnitions": "definitions", "defnitely": "definitely",
    "classifcation": "classification", "classifcations": "classifications", "identifcation": "identification", "identifcations": "identifications",
    "modifcation": "modification", "modifcations": "modifications", "verifcation": "verification", "unifcation": "unification", "magnifcation": "magnification",
    "simplifcation": "simplification", "amplifcation": "amplification", "specifc": "specific", "specifcs": "specifics", "specifcally": "specifically",
    "specifcation": "specification", "specifcations": "specifications", "scientifc": "scientific", "Scientifc": "Scientific", "pacifc": "pacific", "Pacifc": "Pacific",
    "terrifc": "terrific", "horrifc": "horrific", "efcient": "efficient", "efciency": "efficiency", "efcacy": "efficacy", "inefcient": "inefficient",
    "sufcient": "sufficient", "sufciently": "sufficiently", "difcult": "difficult", "difculty": "difficulty", "difculties": "difficulties", "profcient": "proficient", "profciency": "proficiency",
    "profle": "profile", "profles": "profiles", "benefcial": "beneficial", "benefciary": "beneficiary", "sacrifce": "sacrifice", "sacrifced": "sacrificed", "orifce": "orifice",
}
# Characters and their superscripts.
SUPERSCRIPTS = ("0123456789+-=−", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁻")
# Families of mathematical fonts; how answers begin that say nothing; what logs of models print.
MATH_FONTS = ("CMSY", "CMR", "CMMI", "CMEX", "CMTI")
FILLERS = r"(?i)^(sure|certainly|of course|here is|here's|i'?ll|i can|let me|this image|this figure)\b"
NOISE = r"^\d+\.\d+\.\d+\.\d+ [IWE] |^\s*(?:common_|load:|llama_|main:|WARN|warn|init_audio:|encoding mtmd|mtmd batch|WARNING)|^\s*(?:You are a helpful assistant|Hi there|Hello|How are you\?|<\|think\|>|<\|turn>system|<\|turn>user|<\|turn>model)\s*$|^(?:<\|turn>|<turn\|>|terminate called|https://github\.com/ggml-org)|/lib/|/build/bin/"
HEADER = r"(?im)^(flowchart|graph|sequenceDiagram|classDiagram|stateDiagram|erDiagram|gantt|pie|journey|gitGraph)\b"
_LETTER = "A-Za-zÀ-ÿĀ-ž"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _where(c: Column, sign: str, f) -> Column:
    """f of a text that holds the sign; others are not searched."""
    return let(c, lambda x: F.when(F.contains(x, F.lit(sign)), f(x)).otherwise(x))


def float_diacritics(c: Column) -> Column:
    """Diacritics that stand before their vowel, or after the word it is in, set on it; known words mended; others dropped."""
    def put(x: Column, pairs: list[tuple[str, str]]) -> Column:
        for a, b in pairs:
            x = F.replace(x, F.lit(a), F.lit(b))
        return x

    for d, mark in DIACRITICS.items():
        c = _where(c, d, lambda x, d=d, mark=mark: put(x, [(d + v, unicodedata.normalize("NFC", v + mark)) for v in VOWELS]))
    for d in TRAILING:
        # the look ahead reads a word once, so those that no mark follows are left at once
        word = f"(?<![{_LETTER}])(?=[{_LETTER}]{{2}})(?=[{_LETTER}]*+{d}(?![a-zA-Z]))([{_LETTER}]*[{VOWELS}])([{_LETTER}]*){d}"
        c = _where(c, d, lambda x, d=d, word=word: F.regexp_replace(x, word, f"$1{DIACRITICS[d]}$2"))
        c = _where(c, DIACRITICS[d], lambda x, d=d: put(x, [(v + DIACRITICS[d], unicodedata.normalize("NFC", v + DIACRITICS[d])) for v in VOWELS]))
    c = F.regexp_replace(known_words(c), f" ?[{TRAILING}] ?(?![a-zA-Z])", "")
    return F.regexp_replace(c, r"([0-9]{4}[a-z]?) \)", "$1)")


def known_words(c: Column) -> Column:
    for bad, good in KNOWN.items():
        if bad != good:
            c = _where(c, bad, lambda x, bad=bad, good=good: F.regexp_replace(x, rf"(?U)\b{bad}\b", good))
    return c


def dropped_ligatures(c: Column) -> Column:
    """Whole words looked up in one map, however many there are."""
    words = F.create_map(*[F.lit(x) for kv in DROPPED.items() for x in kv])
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(?U)\w+|\W+"), F.lit(0)), lambda w: F.coalesce(F.element_at(words, w), w)), "")


def superscripts(c: Column) -> Column:
    """Digits and signs in brackets right after a letter, digit or bracket, as superscripts."""
    c = F.regexp_replace(c, r"(?<=[A-Za-z0-9_\)\]°µͰ-Ͽ])\[([+\-=−0-9]{1,3})\]", "$1")
    parts = F.regexp_extract_all(c, F.lit("[^]*|[^]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(F.startswith(p, F.lit("")), F.translate(p, SUPERSCRIPTS[0] + "", SUPERSCRIPTS[1])).otherwise(p)), "")


def author_line(c: Column) -> Column:
    return _strip(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\[[0-9,*\s\-]+\]", ""), r"\s*\*\s*", " "), r"\s+", " "))


def math_marks(c: Column) -> Column:
    """Marks of italics and brackets around signs of formulas and coordinates dropped, degrees set close."""
    c = normalise_math_glyphs(c)
    for pattern, put in (
        (r"_\[([′″°·×]{1,3})\]_", "$1"), (r"\[([′″°·×]{1,3})\](?=_)", "$1"), (r"(?<=[0-9)])\s*_([×°·])_\s*(?=[0-9(])", "$1"), (r"\s_×_\s", " × "), ("_±_", "±"),
        (r"(?<=[0-9])_([×÷±])_(?=[0-9])", "$1"), (r"([0-9]+)\s*°\s*([0-9]+)\s*′\s*([0-9]+(?:\.[0-9]+)?)\s*″\s*([NSEW])", "$1°$2′$3″ $4"),
    ):
        c = F.regexp_replace(c, pattern, put)
    return c


def is_math_font(c: Column) -> Column:
    return c.rlike("|".join(MATH_FONTS))


def keywords(raw: Column, most: int = 80) -> Column:
    """A list of keywords, parted by the strongest separator that it holds; without case, each once, the first stays."""
    return let(expand_ligatures(F.regexp_replace(raw, "(?i)^(?:keywords?|key\\s*words?)\\s*[:. \\s]*", "")), lambda c: _distinct(_keywords(c), most))


def _keywords(c: Column) -> Column:
    has = lambda p: c.rlike(p)
    flat = lambda x: F.regexp_replace(x, r"\s*\n\s*", " ")
    tidy = lambda parts: F.filter(F.transform(parts, lambda p: F.btrim(F.trim(F.regexp_replace(p, "[  \\s]+", " ")), F.lit(",;."))), lambda p: p != "")
    lines = F.filter(F.split(c, "\n"), lambda x: F.length(_strip(x)) > 0)
    parts = F.when(has(r"\S\s+\.\s+\S"), F.split(flat(F.regexp_replace(c, r"\s+\.\s+", "; ")), ";")).when(has("·"), F.split(flat(c), "·")).when(has(r"•| \| "), F.split(c, r"[•|]|\s*\n\s*")).when(has(";"), F.split(c, "[;\n]"))
    parts = parts.when(has(",") & F.forall(lines, lambda x: F.contains(x, F.lit(","))), F.split(flat(c), ",")).when(has(","), F.split(c, "[,\n]"))
    # only lines part them: a line that begins in lower case goes on with the one before
    joined = F.split(F.regexp_replace(F.array_join(tidy(F.split(c, "\n")), "\n"), r"\n(?=\p{Ll})", " "), "\n")
    return F.coalesce(tidy(parts), F.filter(joined, lambda p: p != ""))


def _distinct(words: Column, most: int) -> Column:
    """Words of at most that many characters, without case the first of equal ones, in their order; by two sorts, so time
    grows with the number of words and not with its square."""
    keyed = F.transform(F.filter(words, lambda p: F.length(p) <= most), lambda p, i: F.struct(F.lower(p).alias("k"), i.alias("i"), p.alias("p")))
    firsts = lambda s: F.filter(s, lambda x, j: F.coalesce(x["k"] != F.get(s, j - 1)["k"], F.lit(True)))
    return let(F.sort_array(keyed), lambda s: F.transform(F.sort_array(F.transform(firsts(s), lambda x: F.struct(x["i"].alias("i"), x["p"].alias("p")))), lambda x: x["p"]))


def _digits(a: Column, magnitude: Column) -> Column:
    """The first three digits of a, which is positive and has that power of ten, as a number; what decides is the exact
    value of the double. Powers of ten up to 22 are exact, and so is a product with the error of its rounding."""
    power = F.concat(F.lit("1e"), F.abs(2 - magnitude).cast("string")).cast("double")

    def small(x: Column, u: Column) -> Column:  # x * u is p + e
        half = lambda v: let(v * 134217729.0, lambda c: c - (c - v))
        error = lambda p: let(half(x), lambda h: let(half(u), lambda k: ((h * k - p) + h * (u - k) + (x - h) * k) + (x - h) * (u - k)))
        beyond = lambda p: let(error(p), lambda e: F.when(e > 0, F.floor(p) + 1.0).when(e < 0, F.floor(p).cast("double")).otherwise(F.rint(p)))
        return let(x * u, lambda p: F.when(p - F.floor(p) == 0.5, beyond(p)).otherwise(F.rint(p)))

    def large(x: Column, u: Column) -> Column:  # the middle between two neighbours is exact
        return let(F.floor(x / u), lambda k: let((k + 0.5) * u, lambda m: F.when(x > m, k + 1.0).when(x < m, k.cast("double")).otherwise(F.rint(k + 0.5))))

    return let(power, lambda u: F.when(magnitude <= 2, small(a, u)).otherwise(large(a, u)))


def short_number(v: Column) -> Column:
    """A number as text: whole ones without a point, others with three digits; nothing for null."""
    plain = lambda x: F.regexp_replace(x.cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
    power = lambda n: F.concat(F.lit("1e"), n.cast("string")).cast("double")

    def said(r: Column, m: Column) -> Column:
        """r digits from the power of ten m down; 1,000 of them are a power more."""
        exp = F.when(r >= 1000, m + 1).otherwise(m)
        sci = F.concat(plain(F.when(r >= 1000, r / 1000).otherwise(r / 100)), F.lit("e"), F.when(exp < 0, "-").otherwise("+"), F.lpad(F.abs(exp).cast("string"), 2, "0"))
        return F.when((exp < -4) | (exp >= 3), sci).otherwise(plain(F.when(m <= 2, r / power(2 - m)).otherwise(r * power(m - 2))))

    def short(x: Column) -> Column:
        digits = let(F.floor(F.log10(F.abs(x)) + 1e-12), lambda m: let(_digits(F.abs(x), m), lambda r: said(r, m)))
        return F.when(x.isNull(), "").when(F.abs(x - F.rint(x)) < 1e-9, F.rint(x).cast("long").cast("string")).otherwise(F.concat(F.when(x < 0, "-").otherwise(""), digits))

    return let(v.cast("double"), short)


def sentence_at(c: Column, pos: Column) -> Column:
    """The sentence that holds the character at pos (from 0): from the last end of one before to the next."""
    head = F.regexp_replace(c.substr(F.lit(1), pos + 1), r"(?s)^.*[.!?\n](?=[ \n])", "")
    tail = c.substr(pos + 1, F.length(c))
    end = F.regexp_extract(tail, r"(?s)^(.*?[.!?\n])(?:[ \n]|\z)", 1)
    return _strip(F.concat(head.substr(F.lit(1), F.greatest(F.length(head) - 1, F.lit(0))), F.when(end == "", tail).otherwise(end)))


def answer_text(c: Column) -> Column:
    """What a model answered, out of the log it is in: no colours, no log lines, no template, the part after its thoughts."""
    c = F.regexp_replace(c, "\x1b\\[[0-9;]*[A-Za-z]", "")
    c = F.regexp_replace(c, r"(?s)chat template example:.*$", "")
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, r"\s+$", "")), lambda x: ~x.rlike(NOISE))
    body = _strip(F.array_join(lines, "\n"))
    said = _strip(F.regexp_extract(body, r"(?s)<channel\|>\s*(.*?)(?:<turn\|>|\z)", 1))
    bare = _strip(F.regexp_replace(F.regexp_replace(body, r"^<\|channel>(thought|answer)\s*", ""), r"(?s)<turn\|>.*$", ""))
    rest = F.regexp_extract(bare, r"(?is)(?:Examine|Analyze|Look at|Inspect|Study)\s+the\s+(?:Image|Chart|Figure)[^\n]*\n(.*)$", 1)
    return F.when(said != "", said).when(rest != "", _strip(rest)).otherwise(bare)


def unwrapped(c: Column) -> Column:
    """A model's answer without the names of who speaks."""
    return _strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)\A(?:.*\n)?[ \t]*Assistant\s*:\s*", ""))


def short_sentence(raw: Column, most: int = 60) -> Column:
    """The first sentence of an answer, or null where it says nothing, repeats the prompt, or is too short or long."""
    line = _strip(F.split_part(unwrapped(raw), F.lit("\n"), F.lit(1)))
    first = F.regexp_extract(line, r"^(.+?[.!?])(?:\s|$)", 1)
    text = F.regexp_replace(F.regexp_replace(F.when(first != "", _strip(first)).otherwise(line), r"^[-*•]\s*", ""), r"\s+", " ")
    n = F.size(F.filter(F.split(text, r"\s+"), lambda x: x != ""))
    return F.when(~text.rlike(FILLERS) & ~is_echo(text) & n.between(3, most), F.when(text.rlike(r"[.!?]$"), text).otherwise(F.concat(text, F.lit("."))))


def mermaid(raw: Column, lines: int = 60, most: int = 4000) -> Column:
    """The diagram in an answer, without its fence, or null where it has no arrow or is too long."""
    text = unwrapped(raw)
    fence = r"(?is)```mermaid\s*\n(.*?)```"
    other = code_block(text)
    block = F.when(text.rlike(fence), F.regexp_extract(text, fence, 1)).when(other.rlike(HEADER), other).when(text.rlike(HEADER), text)
    block = _strip(block)
    fine = block.rlike(r"-->|---|==>|-\.->") & (F.length(block) - F.length(F.replace(block, F.lit("\n"), F.lit(""))) <= lines) & (F.length(block) <= most)
    return F.when(fine & ~F.contains(text, F.lit("MERMAID_UNAVAILABLE")), block)


def latex(raw: Column) -> Column:
    """The first formula in an answer, with its signs, or null."""
    text = unwrapped(raw)
    wide, thin = _strip(F.regexp_extract(text, r"\$\$([^$]+)\$\$", 1)), F.regexp_extract(text, r"\$([^$\n]{2,200})\$", 1)
    found = F.when(F.length(wide).between(2, 1000), F.concat(F.lit("$$"), wide, F.lit("$$"))).when(thin != "", F.concat(F.lit("$"), _strip(thin), F.lit("$")))
    return F.when(~F.contains(text, F.lit("LATEX_UNAVAILABLE")), found)


def title(md: Column, within: int = 80) -> Column:
    """A paper's title: what it is to be cited by, what it corrects, its first good heading or bold line, its first long line."""
    lines = F.transform(F.slice(F.split(md, "\n"), 1, within), _strip)
    cited = F.regexp_replace(F.regexp_extract(F.substring(md, 1, 3000), r"(?s)Cite\s+this\s+article:?[^.]{0,400}?\([0-9]{4}\)\.\s+([^.]+?)\.\s*[A-Z][^.]+?[0-9]", 1), r"\s+", " ")
    wrong = F.regexp_extract(F.substring(md, 1, 2000), "(?:Corrigendum|Erratum)\\s+to\\s+[\"“]([^\"”]+)[\"”]", 1)
    bare = lambda x: _strip(F.regexp_replace(x, r"\*+|_+", ""))
    heads = F.transform(lines, lambda x: F.when(x.rlike(r"^#{1,3}\s+."), bare(F.regexp_extract(x, r"^#{1,3}\s+(.+)", 1))).when(x.rlike(r"^\*{2}[^*].*?\*{2}\s*$"), bare(F.regexp_extract(x, r"^\*{2}([^*].*?)\*{2}\s*$", 1))))
    good = F.get(F.filter(heads, lambda x: F.coalesce(is_good_title(x), F.lit(False))), F.lit(0))
    long = F.get(F.filter(lines, lambda x: F.length(x).between(31, 299) & ~x.rlike(BANNER)), F.lit(0))
    return F.when(F.length(_strip(cited)).between(16, 299), _strip(cited)).when(wrong != "", F.concat(F.lit("Corrigendum: "), _strip(wrong))).otherwise(F.coalesce(good, long, F.lit("")))


# Where a paper's year, DOI and journal stand.
YEARS = (r"(?i)(?:published|copyright)\D{0,20}((?:19|20)[0-9]{2})(?![0-9])(?!s)", r"\(((?:19|20)[0-9]{2})\)", r"©\s*((?:19|20)[0-9]{2})(?![0-9])(?!s)", r"\b((?:19|20)[0-9]{2})\b(?!s)")
LINKED_DOI = r"(?i)(?:https?://(?:dx\.)?doi\.org/|doi[:\s]+)(10\.[0-9]{4,9}/[-._;()/:A-Z0-9]+)"
BARE_DOI = r"\b(10\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+)"
JOURNAL = r"^([A-Z][A-Za-z &,]{4,70}?(?:Journal|Research|Science|Studies|Letters|Reports|Review|Ecology|Agronomy|Biology|Soil|Environment|Sustainability|Management|Systems|Conservation|Tillage|Use))\s+(?:[0-9]+|\([0-9]{4}\))"


def metadata(md: Column) -> Column:
    """Struct (title, doi, year, journal) of a paper's markdown."""
    some = lambda x: F.nullif(x, F.lit(""))
    tail = lambda x: F.regexp_replace(x, "[.,;]+$", "")
    head = F.substring(md, 1, 4000)
    bare = tail(F.regexp_extract(md, BARE_DOI, 1))
    doi = F.coalesce(some(tail(F.regexp_extract(head, LINKED_DOI, 1))), F.when(F.length(bare).between(9, 99), bare))
    year = F.coalesce(*[some(F.regexp_extract(head, p, 1)) for p in YEARS]).cast("int")
    names = F.transform(F.slice(F.split(md, "\n"), 1, 25), lambda x: F.regexp_extract(_strip(F.regexp_replace(x, "[#*_>]+", "")), JOURNAL, 1))
    journal = F.regexp_replace(F.get(F.filter(names, lambda x: x != ""), F.lit(0)), ",+$", "")
    return F.struct(title(md).alias("title"), doi.alias("doi"), year.alias("year"), journal.alias("journal"))


def reference_title(given: Column, raw: Column) -> Column:
    """A reference's title: the field if there is one, what follows the year, its longest sentence that is no journal."""
    after = _strip(F.regexp_extract(raw, r"\b(?:19|20)[0-9]{2}\b[).,]?\s*(.{15,250}?)(?<=[a-z])\.", 1))
    fine = (F.length(after) > 12) & F.contains(after, F.lit(" ")) & ~journal_like(after)
    runs = F.filter(F.transform(F.split(raw, r"(?<=[a-z])\.\s+"), _strip), lambda x: F.length(x).between(16, 249) & ~journal_like(x) & (F.size(F.split(x, r"\s+")) >= 4) & ~x.rlike(r"^[A-Z][a-z]+,\s"))
    longest = F.get(F.array_sort(F.transform(runs, lambda x, i: F.struct((-F.length(x)).alias("n"), i.alias("i"), x.alias("x")))), F.lit(0))["x"]
    return F.when(F.length(given) > 8, given).when(fine, after).otherwise(longest)


def reference_year(given: Column, raw: Column) -> Column:
    y = F.substring(given, 1, 4).try_cast("int")
    return F.when((y > 1500) & (y < 2100), y).otherwise(F.nullif(F.regexp_extract(raw, r"\b((?:19|20)[0-9]{2})\b", 1), F.lit("")).cast("int"))


def caption_after(md: Column, file: Column, within: int = 600) -> Column:
    """Struct (number, caption) of the bold or plain caption that soon follows an image, or nulls."""
    mark = F.concat(file, F.lit(")"))
    at = F.position(mark, md)
    tail = F.when(at > 0, md.substr(at + F.length(mark), F.lit(within)))
    bold, plain = r"\*\*\s*Fig(?:ure|\.)?\s*([0-9]+)\s*[.)]?\s*\*\*\s*[—\-:]?\s*([^\n]+)", r"(?im)^\s*Fig(?:ure|\.)?\s+([0-9]+)\s*[.)]\s*([^\n]+)"
    pick = lambda k: F.when(tail.rlike(bold), F.regexp_extract(tail, bold, k)).when(tail.rlike(plain), F.regexp_extract(tail, plain, k))
    return F.struct(pick(1).alias("number"), _strip(pick(2)).alias("caption"))


def page_marks(c: Column) -> Column:
    """Tokens of page boundaries, as ⟦n/t⟧, made visible; a rule between two of them, or doubled, goes."""
    c = F.regexp_replace(c, "⟦([0-9]+)/([0-9]+)⟧", "\n\n---\n\n*— Page $1 of $2 —*\n\n")
    c = F.regexp_replace(c, "\n{4,}", "\n\n\n")
    c = F.regexp_replace(c, r"(\*— Page [0-9]+ of [0-9]+ —\*)\s*\n+\s*---\s*\n+\s*(\*— Page [0-9]+ of [0-9]+ —\*)", "$1\n\n$2")
    return F.regexp_replace(c, r"(?m)^---\s*\n+\s*---\s*\n+(\*— Page)", "---\n\n$1")


def colour_distance(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Of two colours (h, s, v), h from 0 to 180 around: twice the hues' distance and those of the others."""
    h = F.abs(a["h"] - b["h"])
    return 2.0 * F.least(h, 180 - h) + F.abs(a["s"] - b["s"]) + F.abs(a["v"] - b["v"])


def quantised(c: Column, step: int = 24) -> Column:
    return F.floor(c / step) * step + step // 2


def chart_table(categories: Column, values: Column, boxes: Column, percents: Column) -> Column:
    """Extracted data as a markdown table: box statistics if there are as many as categories, wedges, or values."""
    row = lambda *cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    table = lambda head, rows: F.array_join(F.concat(F.array(*map(F.lit, head)), rows), "\n")
    fits = lambda a: (F.size(a) > 0) & (F.size(a) == F.size(categories))
    box = F.zip_with(categories, boxes, lambda c, b: row(c, *[short_number(b[k]) for k in ("low", "q1", "median", "q3", "high")]))
    wedge = F.transform(percents, lambda p: row(F.lit("?"), short_number(p / 100), F.concat(short_number(p), F.lit("%"))))
    bar = F.zip_with(categories, values, lambda c, v: row(c, short_number(v)))
    out = F.when(fits(boxes), table(("| Category | min | Q1 | median | Q3 | max |", "|---|---|---|---|---|---|"), box))
    return out.when(F.size(percents) > 0, table(("| Slice | Fraction | Percent |", "|---|---|---|"), wedge)).when(fits(values), table(("| Category | Value |", "|---|---|"), bar))


def table_answer(raw: Column) -> Column:
    """Struct (title, header, rows) of a model's table, rows parted by its sign for a new line; null where there is none."""
    rows = F.filter(F.transform(F.split(raw, r"\s*<0x0A>\s*|\n"), _strip), lambda x: x != "")
    titled = F.upper(F.get(rows, F.lit(0))).startswith("TITLE")
    named = F.when(titled, F.nullif(_strip(F.regexp_extract(F.get(rows, F.lit(0)), r"(?i)^TITLE\s*[|:]\s*(.+)$", 1)), F.lit("")))
    body = F.transform(F.when(titled, F.slice(rows, 2, F.greatest(F.size(rows), F.lit(1)))).otherwise(rows), lambda r: F.transform(F.split(r, r"\|"), _strip))
    head = F.get(body, F.lit(0))
    data = F.filter(F.slice(body, 2, F.greatest(F.size(body), F.lit(1))), lambda r: F.exists(r, lambda x: x != ""))
    even = F.transform(data, lambda r: F.slice(F.concat(r, F.array_repeat(F.lit(""), F.size(head))), F.lit(1), F.size(head)))
    return F.when((F.size(body) > 1) & (F.size(data) > 0), F.struct(named.alias("title"), head.alias("header"), even.alias("rows")))
