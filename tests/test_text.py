"""Text expressions against an independent model in plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clausewise.functions import text as X
from clausewise.functions.arrays import chunk, merge_near_duplicates
from clausewise.functions.replies import importance, parse_answer, parse_issues, parse_judgements

#: Texts with their clauses as (sentence, clause).
CASES = [
    ("The food was good but the service was slow. Mr. Ali was kind!", [(1, "The food was good"), (1, "but the service was slow."), (2, "Mr. Ali was kind!")]),
    ("nice view (small but lovely room), however the sea was rough; unfortunately it rained",
     [(1, "nice view (small but lovely room)"), (1, "however the sea was rough"), (1, "unfortunately it rained")]),
    ("ok but bad. Short, but very very long clause here although it ends", [(1, "ok but bad."), (2, "Short, but very very long clause here"), (2, "although it ends")]),
    ('not only cheap but also clean. tour.The guide "Great." Next (!) stop wow (!) nice',
     [(1, "not only cheap but also clean."), (2, "tour."), (3, 'The guide "Great."'), (4, "Next (!) stop wow (!) nice")]),
    ("a; b; c ; - d plain - dash but one two three", [(1, "a; b; c"), (1, "d plain - dash"), (1, "but one two three")]),
    ("\U0001f600\n\n!!!\nbut", [(1, "but")]),
    ("but but but but", [(1, "but but but but")]),
    ("e.g. this, but e.g. that one here", [(1, "e.g. this, but e.g. that one here")]),
    ("one two three , but (four but five) six seven eight but nine ten eleven", [(1, "one two three"), (1, "but (four but five) six seven eight"), (1, "but nine ten eleven")]),
    ("It rained; - we still went out, yet the sea (which was calm, but cold) was lovely",
     [(1, "It rained; - we still went out"), (1, "yet the sea (which was calm, but cold) was lovely")]),
    ("café été, but naïve people came here", [(1, "café été, but naïve people came here")]),
    ("", []), ("   ", []),
]


def test_clauses_of_cases(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string").select("i", X.split_clauses(F.col("t"), F.lit("en")).alias("c")).collect()
    for r in rows:
        assert [(c["sentence_no"], c["text"]) for c in r["c"]] == CASES[r["i"]][1]


#: Sentences of seven languages with their expected clauses: parentheses that hide separators, pieces
#: under three words that join a neighbour, openers that need no mark and others that need one.
LANGUAGES = [
    ("en", "The beach was lovely, but the staff (rude, but rarely seen) ignored us. Nice though.",
     ["1|The beach was lovely", "1|but the staff (rude, but rarely seen) ignored us.", "2|Nice though."]),
    ("en", "Dr. Smith liked it although it rained; however the tour (which, however, was short) cost too much! We left early, but ok.",
     ["1|Dr. Smith liked it", "1|although it rained", "1|however the tour (which, however, was short) cost too much!", "2|We left early, but ok."]),
    ("fr", "La plage est belle mais la mer est sale. Le guide parlait vite, cependant il connaissait bien les lieux.",
     ["1|La plage est belle", "1|mais la mer est sale.", "2|Le guide parlait vite", "2|cependant il connaissait bien les lieux."]),
    ("fr", "Le repas est bon mais aussi un peu cher pour le lieu.", ["1|Le repas est bon mais aussi un peu cher pour le lieu."]),
    ("de", "Der Strand war schön, aber das Wasser war leider kalt. Wir kamen wieder, obwohl es viel regnete.",
     ["1|Der Strand war schön", "1|aber das Wasser war leider kalt.", "2|Wir kamen wieder", "2|obwohl es viel regnete."]),
    ("es", "La playa es bonita pero el agua estaba muy sucia. Nos gustó mucho, sin embargo el precio es alto.",
     ["1|La playa es bonita", "1|pero el agua estaba muy sucia.", "2|Nos gustó mucho", "2|sin embargo el precio es alto."]),
    ("it", "Il mare è bello ma la spiaggia è molto sporca. Tornerei volentieri, tuttavia costa troppo per tutti.",
     ["1|Il mare è bello", "1|ma la spiaggia è molto sporca.", "2|Tornerei volentieri, tuttavia costa troppo per tutti."]),
    ("pt", "A praia é linda, porém o serviço foi muito lento. Gostamos do passeio, no entanto choveu o dia todo.",
     ["1|A praia é linda", "1|porém o serviço foi muito lento.", "2|Gostamos do passeio", "2|no entanto choveu o dia todo."]),
    ("nl", "Het strand was mooi, maar het water was erg koud. De gids was aardig, echter hij sprak te snel.",
     ["1|Het strand was mooi", "1|maar het water was erg koud.", "2|De gids was aardig", "2|echter hij sprak te snel."]),
]


def test_clauses_of_seven_languages(spark):
    rows = spark.createDataFrame([(i, lang, text) for i, (lang, text, _) in enumerate(LANGUAGES)], "i int, lang string, text string")
    for r in rows.select("i", X.split_clauses(F.col("text"), F.col("lang"), 3).alias("c")).collect():
        assert [f"{c['sentence_no']}|{c['text']}" for c in r["c"]] == LANGUAGES[r["i"]][2]


@pytest.mark.parametrize("lang", ["en", "fr"])
def test_properties_of_clauses(spark, lang):
    """Clauses stand in the text in order, are not cut inside parentheses, have three words unless they are
    alone, and begin with a connector where they are not the first of a sentence."""
    rng = random.Random(5)
    words = ["but", "but also", "however", "mais", "cependant", "nice", "nice,", "the", "sea", "sea;", "(small", "room)", "view:", "late.", "stop!", "Mr.", "été", "été,", "It"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(250)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("c", X.split_clauses(F.col("t"), F.lit(lang))).collect()
    connector = re.compile(rf"(?:{X.OPENERS[lang]}|{X.AFTER_MARK[lang]})\b", re.I)
    several = 0
    for r in rows:
        at, of = 0, {}
        for c in r["c"]:
            at = r["t"].index(c["text"], at) + len(c["text"])
            of.setdefault(c["sentence_no"], []).append(c["text"])
        assert list(of) == list(range(1, len(of) + 1))
        for clauses in of.values():
            several += len(clauses) > 1
            assert len(clauses) == 1 or all(len(c.split()) >= 3 for c in clauses), r["t"]
            for k, c in enumerate(clauses[1:], 1):
                before = " ".join(clauses[:k])
                assert connector.match(c) and before.count("(") <= before.count(")"), r["t"]
    assert several > 20


def test_clean_text(spark):
    cases = {"wasn''t": "wasn't", "crowded.,,,,,,": "crowded.", "a\r\nb\rc": "a\nb\nc", " a  \t b ": "a b", "a\n \n\n b": "a\n b", "": ""}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", X.clean_text(F.col("t")).alias("c")).collect()
    assert {r["t"]: r["c"] for r in rows} == cases


def test_detect_lang(spark):
    cases = {"I was here": "it", "the view": "en", "la playa": "fr", "x " * 29 + "und": "de", "x " * 30 + "und": "en", "": "en", "it was": "nl"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", X.detect_lang(F.col("t")).alias("c")).collect()
    assert {r["t"]: r["c"] for r in rows} == cases


def test_near_duplicates_keep_the_first(spark):
    lists = [["dirty beach sand", "dirty beach sand here", "queue"], ["海", "海"], []]
    rows = spark.createDataFrame([(x,) for x in lists], "t array<string>").select(merge_near_duplicates(F.col("t")).alias("k"), chunk(F.col("t"), 2).alias("c")).collect()
    assert [r["k"] for r in rows] == [["dirty beach sand", "queue"], ["海", "海"], []]
    assert [len(r["c"]) for r in rows] == [2, 1, 0]


def test_replies(spark):
    raw = ['{"issues":[{"issue":"a","importance":"7"},{"issue":" "}]}', "none", '```json\n{"summary":"s","actions":["x"]}\n```']
    rows = spark.createDataFrame([(x,) for x in raw], "t string").select(parse_issues(F.col("t")).alias("i"), parse_answer(F.col("t")).alias("a")).collect()
    assert [(i["issue"], i["importance"]) for i in rows[0]["i"]] == [("a", 7)] and rows[1]["a"]["summary"] == "none"
    assert rows[2]["a"]["summary"] == "s" and rows[2]["a"]["actions"] == ["x"]
    got = spark.createDataFrame([("2.5",), ("3.5",), ("11",), ("-1",), ("x",), (None,), ("NaN",)], "t string").select(importance(F.col("t")).alias("v"))
    assert [r["v"] for r in got.collect()] == [2, 4, 10, 0, 0, 0, 0]
    judged = spark.createDataFrame([('```json\n[{"index":1,"reason":"r","action_items":["a"]}]\n```',)], "t string").select(parse_judgements(F.col("t")).alias("j"))
    assert judged.first()["j"][0]["index"] == 1
