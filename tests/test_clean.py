"""Micro cases of the cleaning cascade and the text functions."""

import pytest
from pyspark.sql import functions as F

from logosmill.functions import text as T
from logosmill.operators import clean

CASES = [
    ("12", None, "digits_only"),
    ("00:01:23,456 --> 00:01:25,789", None, "empty_after"),
    ("Υπότιτλοι από την ομάδα μας", None, "credits"),
    ("ΥΠΌΤΙΤΛΟΙ από την ομάδα μας", None, "credits"),
    ("14 Ιανουαρίου - Γεννήθηκε ο ποιητής", None, "almanac"),
    ("Η λέξη μπορεί να αναφέρεται σε πολλά", None, "navigation"),
    ("[ΜΟΥΣΙΚΗ] Πάμε μια βόλτα τώρα", "Πάμε μια βόλτα τώρα", None),
    ("- ΝΙΚΟΣ: Πού είσαι τώρα;", "Πού είσαι τώρα;", None),
    ("10:30 το πρωί φεύγουμε όλοι μαζί για διακοπές", "30 το πρωί φεύγουμε όλοι μαζί για διακοπές", None),
    ("1) Πρώτα πρέπει να φύγουμε", "Πρώτα πρέπει να φύγουμε", None),
    ("Πού πας τώρα?", "Πού πας τώρα;", None),
    ("Δεν ξέρω....ίσως αύριο", "Δεν ξέρω... ίσως αύριο", None),
    ("&quot;Καλημέρα σε όλους&quot;", '"Καλημέρα σε όλους"', None),
    ("Δες το www.example.gr για όλα αυτά", "Δες το για όλα αυτά", None),
    ("Αααααα τι ωραία μέρα", None, "repeated_char"),
    ("Θέλω vα πάω σπίτι", "Θέλω να πάω σπίτι", None),
    ("Καλά παιδιά", None, "word_count"),
    ("Αυτό είναι ένα very long english sentence here", None, "not_greek"),
    ("ΜΗΝ ΠΑΣ ΕΚΕΙ ΤΩΡΑ", None, "capitals"),
    ("ΜΗΝ ΠΑΣ ΕΚΕΙ", "ΜΗΝ ΠΑΣ ΕΚΕΙ", None),
    ("Το 2020 και το 2021 ήταν δύσκολα", None, "digits"),
    ("Είχαμε μαζί μας 2 μικρά παιδιά και 3 μεγάλους σκύλους στο σπίτι", None, "numbers"),
    ("Γράψε στο a.b@example.gr αμέσως τώρα", "Γράψε στο αμέσως τώρα", None),
    ("", None, "empty"),
    (None, None, "empty"),
]


def test_cascade(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _, _) in enumerate(CASES)], "i int, line string")
    got = {r.i: (r.clean, r.drop_reason) for r in clean.cascade(df).collect()}
    assert got == {i: (c, d) for i, (_, c, d) in enumerate(CASES)}


def test_invariants_and_empty(spark):
    empty = spark.createDataFrame([], "i int, line string, raw2 int")
    assert clean.cleaned(empty).count() == 0
    df = spark.createDataFrame([("  α" * 50,), ("λέξη άλλη  τρίτη ;",)], "line string")
    rows = clean.cleaned(df).collect()
    assert [r.line for r in rows] == ["λέξη άλλη τρίτη;"]


@pytest.mark.parametrize(("word", "n"), [("και", 1), ("καλημέρα", 4), ("ουρανός", 3), ("πού", 2), ("είμαι", 3)])
def test_syllables(spark, word, n):
    assert spark.range(1).select(T.syllables(F.lit(word)).alias("n")).first().n == n


def test_small_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(T.strip_accents(F.lit("Έλα είμαι προϋπόθεση"))) == "Ελα ειμαι προυποθεση"
    assert one(T.prompt(F.lit("Καλά"), F.lit("ειμαι"), F.lit("είμαι"))) == "Καλά <XBU>ειμαι<XBC>είμαι<XEC>"
    assert one(T.prompt(F.lit(None).cast("string"), F.lit("α"), F.lit("β"))) == "<XBU>α<XBC>β<XEC>"
    assert one(T.space_punctuation(F.lit("Ναι,όχι (ίσως)."))) == "Ναι , όχι ( ίσως ) ."
    assert one(T.greek_ratio(F.lit("αβab"))) == 0.5 and one(T.greek_ratio(F.lit("12"))) == 0.0
    assert one(T.unescape_all(F.lit("&lt;&Auml;&#960;&amp;lt;"))) == "<Äπ&lt;"
    p = one(T.softmax(F.array(F.lit(1.0), F.lit(2.0), F.lit(700.0))))
    assert abs(sum(p) - 1) < 1e-12 and p[2] > 0.99


def test_entities_as_the_library_reads_them(spark):
    import html
    import random

    rng = random.Random(1)
    cases = ["&" + n for n in html.entities.html5] + [f"&#{n};" for n in (*range(300), 0xD800, 0xFDD0, 0xFFFE, 0x1F600, 0x10FFFF, 0x110000, 10**12)] + [f"&#x{n:x}" for n in (*range(300), 0x110000, 0xFFFFFFFFFF)]
    cases += ["&notit;", "&notin;", "&amp;lt;", "&", "& amp;", "&#;", "&#x;", "&αβγ;", "&AMPx", "&#00065;"]
    cases += ["".join(rng.choice(["&amp;", "&lt", "&#65", "&#x3b1;", "a", "é", ";", "&", "#", " ", "&eacute;", "&copy"]) for _ in range(12)) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in cases], "x string")
    assert [(r.x, r.y) for r in df.select("x", T.unescape_all(F.col("x")).alias("y")).collect() if r.y != html.unescape(r.x)] == []
