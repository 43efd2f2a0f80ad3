"""Text expressions: cleaning, language, sentences, clauses, tokens, labels. JVM-side throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x{1c}-\x{1f}]"
DOT_MARK = "․"

# Language markers, abbreviations, connectors and stop words.
MARKERS = {
    "fr": ["mais", "bien", "très", "tres", "le", "la", "les", "était"],
    "de": ["aber", "und", "der", "die", "das", "sehr", "nicht", "war", "für"],
    "es": ["pero", "que", "el", "la", "los", "las", "muy", "fue"],
    "it": ["ma", "che", "il", "la", "i", "le", "molto", "era"],
    "pt": ["mas", "que", "o", "a", "os", "as", "muito", "foi"],
    "nl": ["maar", "en", "het", "de", "een", "zeer", "was", "niet"],
}
ABBREVIATIONS = "Mr|Mrs|Ms|Dr|St|Mt|Jr|Sr|vs|approx|e\\.g|i\\.e|a\\.m|p\\.m"
OPENERS = {
    "en": "but(?!\\s+also)|although|even though|whereas|except",
    "fr": "mais(?!\\s+aussi)|bien que|sauf",
    "de": "obwohl|außer",
    "es": "pero|aunque|excepto|salvo",
    "it": "ma(?!\\s+anche)|però|anche se|tranne|eccetto",
    "pt": "mas(?!\\s+também)|porém|embora|exceto",
    "nl": "hoewel|behalve",
}
AFTER_MARK = {
    "en": "however|though|unfortunately|sadly|apart from|other than|yet|nevertheless|nonetheless|on the other hand",
    "fr": "cependant|toutefois|pourtant|malheureusement|par contre|en revanche",
    "de": "aber|jedoch|leider|allerdings|trotzdem|sondern",
    "es": "sin embargo|lamentablemente|desafortunadamente|no obstante",
    "it": "tuttavia|purtroppo",
    "pt": "contudo|entretanto|infelizmente|no entanto",
    "nl": "maar(?!\\s+ook)|echter|helaas",
}
ISSUE_STOPWORDS = (
    "a an the and or but is are was were be been being to of in on for with at by from as it its that this these those very "
    "too so just only also not no can could will would should had have has there their them they you your we our my me i he "
    "she his her about into over under again then than when while during before after up down out off"
).split()
PLACE_STOPWORDS = (
    "the a an and or of in on at by beach island zanzibar tanzania nature reserve national park garden gardens museum house "
    "st street road old new private"
).split()
GENERIC_PLACE_WORDS = (
    "spice farm farms tour tours adventure center centre aquarium lodge restaurant bar shop cave rock bay hill forest safari"
).split()

# Patterns of ends of sentences, runs that cleaning changes, and clause separators.
SENTENCE_END = (
    "(?U)(?:(?<=[.!?…])|(?<=[.!?…][\"'”’)\\]])(?<!\\([!?]\\)))[\\s\\x{1c}-\\x{1f}]+|\\n+"
    "|(?<=[a-zà-ÿ]{2}[.!?])(?=[A-ZÀ-Ý])"
)
COMMA_RUN = r"(?:[ \t]*,){3,}[ \t]*"
BLANK_RUN = "[ \\t\u00a0]+"
LINE_RUN = rf"(?U)\n{SPACE}*\n+"
MARK_SEPARATOR = r"\s*;\s*\s+[–—-]\s+"
ANY_MARK_SEPARATOR = r"\s*;\s*|\s+[–—-]\s+"
CLAUSE_ENDS = "[ ,;:–—\\-\\n]+"


def strip(c: Column) -> Column:
    """White space at both ends, in the Unicode sense, goes."""
    return F.regexp_replace(c, f"(?U)^{SPACE}+|{SPACE}+$", "")


def not_blank(c: Column) -> Column:
    return c.isNotNull() & c.rlike(r"(?U)[^\s\x{1c}-\x{1f}]")


def clean_text(c: Column) -> Column:
    c = F.regexp_replace(c, "''", "'")
    c = F.regexp_replace(c, COMMA_RUN, "")
    c = F.regexp_replace(c, r"\r\n?", "\n")
    c = F.regexp_replace(c, BLANK_RUN, " ")
    return strip(F.regexp_replace(c, LINE_RUN, "\n"))


def detect_lang(c: Column) -> Column:
    words = F.slice(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("([A-Za-zÀ-ÿ]+)"), 1), 1, 30)
    out = F.lit("en")
    for lang, markers in reversed(MARKERS.items()):
        out = F.when(F.arrays_overlap(words, F.array(*map(F.lit, markers))), lang).otherwise(out)
    return out


def sentences(c: Column) -> Column:
    """Sentences of cleaned text; the dots of abbreviations are marks until ``unmark``."""
    marked = F.regexp_replace(c, rf"(?iU)\b({ABBREVIATIONS})\.", f"$1{DOT_MARK}")
    return F.filter(F.split(marked, SENTENCE_END, -1), not_blank)


def unmark(c: Column) -> Column:
    return F.regexp_replace(c, DOT_MARK, ".")


def separator(lang: str, semicolons: bool = False) -> str:
    """Pattern before which a clause ends. By default a plain semicolon or dash does not separate."""
    last = ANY_MARK_SEPARATOR if semicolons else MARK_SEPARATOR
    return rf"(?iU)(?:\s*[,;:]\s*|\s+)(?=(?:{OPENERS[lang]})\b)|\s*[,;]\s*(?=(?:{AFTER_MARK[lang]})\b)|{last}"


def _words(c: Column) -> Column:
    return F.size(F.filter(F.split(c, rf"(?U){SPACE}+"), lambda w: w != ""))


def _count(c: Column, mark: str) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, f"\\{mark}", ""))


def sentence_clauses(sentence: Column, lang: Column, min_words: int = 3, semicolons: bool = False) -> Column:
    """Clauses of one sentence: cut at separators outside parentheses, short pieces joined."""
    marked = F.regexp_replace(sentence, separator("en", semicolons), "\x01$0\x02")
    for code in OPENERS:
        if code != "en":
            marked = F.when(lang == code, F.regexp_replace(sentence, separator(code, semicolons), "\x01$0\x02")).otherwise(marked)
    parts = F.transform(F.split(marked, "\x01", -1), lambda p: F.when(
        F.instr(p, "\x02") > 0, F.struct(F.split(p, "\x02", 2)[0].alias("gap"), F.split(p, "\x02", 2)[1].alias("body"))
    ).otherwise(F.struct(F.lit("").alias("gap"), p.alias("body"))))
    kind = "array<struct<gap:string,body:string>>"

    def last(a: Column) -> Column:
        return F.element_at(a, -1)

    def but_last(a: Column) -> Column:
        return F.slice(a, F.lit(1), F.size(a) - 1)

    def cut(acc: Column, p: Column) -> Column:
        inside = acc["depth"] > 0
        whole = F.concat(p["gap"], p["body"])
        joined = F.concat(but_last(acc["out"]), F.array(F.struct(
            last(acc["out"])["gap"].alias("gap"), F.concat(last(acc["out"])["body"], whole).alias("body"))))
        return F.struct(
            (acc["depth"] + _count(whole, "(") - _count(whole, ")")).alias("depth"),
            F.when((F.size(acc["out"]) > 0) & inside, joined).otherwise(F.concat(acc["out"], F.array(p))).alias("out"))

    pieces = F.aggregate(parts, F.struct(F.lit(0).alias("depth"), F.array().cast(kind).alias("out")), cut, lambda a: a["out"])

    def drop_blank(acc: Column, p: Column) -> Column:
        gap = F.concat(acc["held"], p["gap"])
        return F.when(not_blank(p["body"]), F.struct(
            F.lit("").alias("held"), F.concat(acc["out"], F.array(F.struct(gap.alias("gap"), p["body"].alias("body")))).alias("out")
        )).otherwise(F.struct(F.concat(gap, p["body"]).alias("held"), acc["out"].alias("out")))

    kept = F.aggregate(pieces, F.struct(F.lit("").alias("held"), F.array().cast(kind).alias("out")), drop_blank, lambda a: a["out"])

    def merge(acc: Column, p: Column) -> Column:
        text = F.when(acc["carry"].isNull(), p["body"]).otherwise(F.concat(acc["carry"], p["gap"], p["body"]))
        none = F.lit(None).cast("string").alias("carry")
        return (
            F.when(_words(text) >= min_words, F.struct(none, F.concat(acc["out"], F.array(text)).alias("out")))
            .when(F.size(acc["out"]) > 0, F.struct(none, F.concat(
                but_last(acc["out"]), F.array(F.concat(last(acc["out"]), p["gap"], text))).alias("out")))
            .otherwise(F.struct(text.alias("carry"), acc["out"].alias("out"))))

    start = F.struct(F.lit(None).cast("string").alias("carry"), F.array().cast("array<string>").alias("out"))
    merged = F.aggregate(kept, start, merge, lambda a: F.when(
        a["carry"].isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(a["carry"]))))
    # most sentences have no separator and need none of the folds
    found = F.when(F.instr(marked, "\x01") == 0, F.array(sentence)).otherwise(merged)
    return F.filter(F.transform(found, lambda t: unmark(F.regexp_replace(t, f"^{CLAUSE_ENDS}|{CLAUSE_ENDS}$", ""))), lambda t: t.rlike(r"(?U)\w"))


def split_clauses(text: Column, lang: Column, min_words: int = 3, semicolons: bool = False) -> Column:
    """array<struct<sentence_no, text>>; sentences count from 1 and only if a clause is left."""
    # text and language are bound by a one-row lambda, so each is worked out once a review
    bound = F.transform(F.array(F.struct(sentences(text).alias("s"), F.split(lang, "-")[0].alias("l"))), lambda x: F.filter(
        F.transform(x["s"], lambda s: sentence_clauses(s, x["l"], min_words, semicolons)), lambda c: F.size(c) > 0))
    per = F.element_at(bound, 1)
    return F.flatten(F.transform(per, lambda cs, i: F.transform(
        cs, lambda c: F.struct((i + 1).cast("int").alias("sentence_no"), c.alias("text")))))


def issue_tokens(c: Column) -> Column:
    return F.array_except(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z']+)"), 1)), F.array(*map(F.lit, ISSUE_STOPWORDS)))


def normalize_place(c: Column) -> Column:
    return strip(F.regexp_replace(F.lower(c), "[^a-z0-9 ]+", " "))


def place_tokens(c: Column, generic: bool = True) -> Column:
    """Words of more than two letters without stop words; ``generic=False`` also drops common kinds."""
    stop = PLACE_STOPWORDS + ([] if generic else GENERIC_PLACE_WORDS)
    words = F.array_distinct(F.split(normalize_place(c), " +"))
    return F.array_except(F.filter(words, lambda w: F.length(w) > 2), F.array(*map(F.lit, stop)))


def label_key(c: Column) -> Column:
    return F.translate(F.lower(c), "–", "-")


def html_escape(c: Column, quotes: bool = True) -> Column:
    """``quotes=False`` leaves quotation marks, as is enough between tags."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *((('"', "&quot;"), ("'", "&#x27;")) if quotes else ())):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def hue(c: Column) -> Column:
    """Colour angle of an id: the first six digits of its MD5, modulo 360."""
    return (F.conv(F.substring(F.md5(c.cast("string")), 1, 6), 16, 10).cast("long") % 360).cast("int")


def colour(c: Column) -> Column:
    """CSS colour of a cluster id: its hue, and grey for 0 (no cluster)."""
    return F.when(c == 0, "#999999").otherwise(F.concat(F.lit("hsl("), hue(c).cast("string"), F.lit(",70%,50%)")))


def format_eta(seconds: float) -> str:
    s = int(max(0, seconds))
    h, m = s // 3600, s % 3600 // 60
    return f"{h}h {m}m" if h else f"{m}m {s % 60}s" if m else f"{s}s"
