"""Language labels on short texts of known languages."""

import pytest

from logosmill.llm import language as LG

COMMON = {
    "it": "il la che di e un una per non con gli della è del nel sono più anche ma come si lo questo le da",
    "el": "ο η το του της την τον και να δεν που με για από σε είναι θα ότι στο στη στην μας πως όταν αλλά γιατί τη αν μου ενώ πριν",
    "fr": "le la les de des et un une que est dans pour qui pas nous avec il elle sur ce plus du sa leur cette",
    "de": "der die das und ist nicht ein eine mit dem den von zu auf für es sie wir haben als wie aber auch er so",
    "es": "el la los las de que y en un una es por con no para su más del este como pero se lo hay muy",
    "en": "the of and to a in is that it was for with as his they be at this have from not but by we she there",
    "ru": "и в не на что он она как это по но они мы его для был так же из от который нет там с",
}
WORDS = [(k, w) for k, v in COMMON.items() for w in v.split()]
GREEK = ["Όταν γυρίσαμε, ο κόσμος άρχισε να κρατάει τον δρόμο για την πόλη και δεν ήξερε γιατί."] * 20
MODEL = LG.LanguageModel(WORDS, ["They took it from the house because there was no way that it was for the people."] * 5, GREEK)


@pytest.mark.parametrize(("text", "lang"), [
    ("There was no house that they took from the people with this.", "en"), ("Nous avons une maison dans la ville et elle est plus grande que cette rue.", "fr"),
    ("Der Mann ist nicht mit dem Hund auf die Straße und das ist so.", "de"), ("No hay una casa en la ciudad que es más grande para los hombres.", "es"),
    ("La casa della città è più grande e non sono anche con gli uomini.", "it"), ("Она была в городе и не что он как это по дороге.", "ru"),
    ("Otan gyrisame, o kosmos arxise na krataei ton dromo gia tin poli kai den ixere giati.", "el"), ("ΟΤΑΝ ΓΥΡΙΣΑΜΕ Ο ΚΟΣΜΟΣ", "el"),
])
def test_whole_texts(text, lang):
    segs = MODEL.segments(text)
    assert [s[2] for s in segs] == [lang] and 0 < segs[0][3] <= 1


def test_passages():
    segs = MODEL.segments("Ο κόσμος άρχισε να κρατάει τον δρόμο: «There was no house that they took from the people with this.» Και μετά ήρθε στο laptop.")
    assert [s[2] for s in segs][:3] == ["el", "en", "el"] and segs[1][1] >= 6
    assert all(s[1] < 6 or s[2] in ("el", "en") for s in segs)
    assert MODEL.segments("12 -- !") == []


@pytest.mark.parametrize(("label", "lang"), [("EL", "el"), ("ell", "el"), ("el_GR", "el"), ("Greek", "el"), ("eng", "en"), ("bg", "other"), (" und ", ""), (None, ""), ("", ""), ("unknown", ""), ("deu", "de")])
def test_labels(label, lang):
    assert LG.label_language(label) == lang


def test_operator(spark):
    rows = [
        (1, "Ο κόσμος άρχισε να κρατάει τον δρόμο.", "el"), (2, "Ο κόσμος άρχισε να κρατάει τον δρόμο.", None), (3, "There was no house that they took from the people.", "fr"),
        (4, "Ο κόσμος άρχισε να κρατάει τον δρόμο. There was no house that they took from the people.", "el"), (5, None, None), (6, "", "und"), (7, "12:40", ""),
        (8, "1. Κηπονόνι 2. Ατιμιδούβης 3. Γητοκέντος 4. Στηχροτόζος", "und"), (3, "There was no house that they took from the people.", "fr"),
    ]
    df = spark.createDataFrame(rows, "rec_id bigint, text string, lang string")
    got = sorted(map(tuple, LG.label_languages(df, MODEL, WORDS, output="found").distinct().collect()))
    assert got == [(2, "el"), (3, "en"), (4, "el"), (4, "en")]
    docs = {r.rec_id: r for r in LG.label_languages(df, MODEL, WORDS, output="documents").collect()}
    assert docs[1].label_ok and not docs[3].label_ok and set(docs) == {1, 2, 3, 4, 8}
    segs = LG.label_languages(df, MODEL, WORDS).where("rec_id = 4").orderBy("segment").collect()
    assert [s.lang for s in segs] == ["el", "en"] and segs[1].first_word == 7
    assert LG.label_languages(df.limit(0), MODEL, WORDS).count() == 0


def test_passages_of_few_common_words(spark):
    texts = ["She found the stonish garment near Weatherford because the clothless farmer was broodful.", "The careless painter drove the woodish carriage when they reached the harbour near Millington."]
    model = LG.LanguageModel(WORDS, texts * 5, GREEK)
    few = "careless found broodful stonish garment near Millington".split()
    assert sum("en" in model.lexicon.get(w.lower(), ()) for w in few) * 8 < 8 and model.speaks(few, "en")
    assert not model.speaks("xqzv wkjh bvcx zzgq pqxw jfkd hgqz".split(), "en")
    # one passage of 17 words with two common ones, one of 9 with one, one of 8 with none
    passages = ["She drove stonish careless garment near Weatherford because she reached woodish broodful harbour carriage painter near Millington", "She found broodful stonish garment near Weatherford harbour carriage", "careless painter found woodish carriage near Millington harbour"]
    line = "Ο κόσμος άρχισε να κρατάει τον δρόμο για την πόλη και δεν ήξερε γιατί όταν γυρίσαμε. "
    rows = [(i, line + p, "el") for i, p in enumerate(passages)] + [(9, line + "Xqzv wkjh bvcx zzgq pqxw jfkd hgqz vkxj.", "el")]
    df = spark.createDataFrame(rows, "rec_id bigint, text string, lang string")
    got = sorted(map(tuple, LG.label_languages(df, model, WORDS, output="found").distinct().collect()))
    assert got == [(i, x) for i in range(3) for x in ("el", "en")]


def test_fit_counts_every_text(spark):
    """Over more texts than the 6,000 and 2,000 that a sample once took: the same sums as over all texts at hand, copies once."""
    import numpy as np

    english = [f"The house number{i} was for the people that they took from there at dawn." for i in range(9000)]
    greek = [f"Ο κόσμος άρχισε να κρατάει τον δρόμο με {a}{b}{c}{d}." for a in "βγδζθλμνπρ" for b in "αειουηω" for c in "κτσφχψξ" for d in "αειουηω"]
    short = ["Es ist so, das ist es.", "Der sfortunat ist da, sfortunat und sfortunat und sfortunat."]  # the one has a single run of three plain letters
    seen = ["Ο κόσμος είπε kosmos."]
    texts = english + greek + short + seen
    rows = [(i, t) for i, t in enumerate(texts + texts[:50] + [None, ""])]
    model = LG.fit_language_model(spark.createDataFrame(rows, "rec_id bigint, text string"), WORDS)
    every = LG.LanguageModel(WORDS, texts, texts)
    assert np.allclose(model.table, every.table, atol=1e-5) and np.allclose(model.odds, every.odds, atol=1e-5)
    for w in "the house number7 number sfortunat kosmos dawn ist unheard".split():
        assert np.allclose(model.score(w), every.score(w), atol=1e-4), w
    assert set(model.keys.tolist()) <= set(every.keys.tolist()) and {LG.word_key(w) for w in ("sfortunat", "kosmos", "dawn")} <= set(model.keys.tolist())


def test_spellings():
    words = ["ουρανοσ", "αυτοευρυχωροσ", "ξεχνουυ", "ψηφιωβ", "a1β"]
    want = {}
    for w in words:
        for v in range(8):
            want[LG.greeklish(w, v)] = want.get(LG.greeklish(w, v), 0) + 3 / 8
    assert LG.spellings(words, [3] * len(words)) == want
