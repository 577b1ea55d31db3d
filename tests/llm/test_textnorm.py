"""The consistent form and the vectorised words against plain Python."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logosmill.llm import lookalikes, textnorm as N

CASES = [
    ("Θέλω vα πάω", "Θέλω να πάω"),
    ("μετá τo σπíτι", "μετά το σπίτι"),
    ("τον εμπο​βάλο﻿", "τον εμποβάλο"),
    ("ϖοτέ ϰαι ϵίναι µου", "ποτέ και είναι μου"),
    ("Ｔｈｅｙ ｗｅｎｔ．", "They went."),
    ("κάτι άλλο τώρα\tκαι\nμετά", "κάτι άλλο τώρα\tκαι\nμετά"),
    ("άέ", "άέ"),
    ("Ξέρω", "Ξέρω"),
    ("👩‍👧 και α‍β", "👩‍👧 και αβ"),
    ("«α» – ’β’ “γ” … 5²", "«α» – ’β’ “γ” … 5²"),
    ("The сuсumber", "The cucumber"),
    ("WiFi στο Google", "WiFi στο Google"),
    ("καфές", "καφές"),
    ("", ""),
]


@pytest.mark.parametrize(("raw", "want"), CASES)
def test_cases(raw, want):
    assert N.consistent(raw) == want
    assert N.consistent(want) == want


ALPHABET = st.sampled_from(list("αβγάώςσΣΆaoeipvABЖаеоыß éíñ.,;«»…-'\t\n 09²́̈​‍­ 　Ｇｏ．µϐΩ👍👩ﬁ"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), max_size=8))
def test_batch_equals_plain(texts):
    cb = N.CharBatch(N.to_string_array(pa.array(texts, pa.string())))
    words = cb.words()
    want = [(i, w) for i, t in enumerate(texts) for w in N.words_of(t)]
    assert list(zip(cb.word_row.tolist(), words)) == want
    if want:
        assert (cb.hashes() == N.word_hash([w for _, w in want])).all()
    changed = [N.consistent(t) != t for t in texts]
    assert all(d for d, c in zip(cb.dirty, changed) if c)


@settings(max_examples=200, deadline=None)
@given(st.text(ALPHABET, max_size=60))
def test_idempotent(text):
    once = N.consistent(text)
    assert N.consistent(once) == once


def test_slices_cover_all():
    arr = N.to_string_array(pa.array(["x" * n for n in (0, 5, 3_000_000, 1, 0)]))
    got = list(N.slices(arr))
    assert got[0][0] == 0 and got[-1][1] == 5 and all(a[1] == b[0] for a, b in zip(got, got[1:]))


def test_operator_nulls_and_clashes(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "vα Τo", "t"), (3, "vα Τo", "t"), (None, "γεια", "")], "rec_id bigint, text string, k string")
    rows = {r.rec_id: r for r in lookalikes.normalize_lookalikes(df).collect()}
    assert rows[1].consistent_text is None and not rows[1].changed and rows[2].consistent_text == ""
    assert rows[3].consistent_text == "να Το" and rows[3].mixed_words == 2 and not rows[None].changed
    assert lookalikes.normalize_lookalikes(df, changed_only=True).count() == 2
    assert lookalikes.normalize_lookalikes(df.limit(0)).count() == 0
    assert N.whole_script_confusable("KAI") and not N.whole_script_confusable("ψ")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("αβκάΚΑΙςξKAIaoevpxsßéñАВсоежї ,.09")), max_size=30), max_size=8))
def test_whole_script_counts_equal_plain(texts):
    cb = N.CharBatch(N.to_string_array(pa.array(texts, pa.string())), resolve=False)
    got = lookalikes.whole_script_counts(cb)
    assert [(g, 0) for g, d in zip(got.tolist(), cb.suspicious()) if not d] == [lookalikes._counts(t)[::-1] for t, d in zip(texts, cb.suspicious()) if not d]


def test_whole_script_words_in_every_row(spark):
    rows = [(1, "Πήγα KAI γύρισα."), (2, "Πήγα και γύρισα."), (3, "Πήγα KAI vα έρθω TO BIBAIO."), (4, None), (5, "Он KAI τώρα KAI 12"), (6, "WiFiκd KAI")]
    got = {r.rec_id: r for r in lookalikes.normalize_lookalikes(spark.createDataFrame(rows, "rec_id bigint, text string")).collect()}
    assert [got[i].whole_script_words for i in (1, 2, 3, 4, 5)] == [1, 1, 3, 0, 3]
    assert [got[i].changed for i in (1, 2, 3, 4, 5)] == [False, False, True, False, False] and got[1].consistent_text == rows[0][1]
    assert (got[6].mixed_words, got[6].whole_script_words) == (1, 1)


def test_long_text(spark):
    long = "λέξη vα " * 60_000
    df = spark.createDataFrame([(1, long)], "rec_id bigint, text string")
    r = lookalikes.normalize_lookalikes(df).first()
    assert r.changed and r.mixed_words == 60_000 and len(r.consistent_text) == len(long)


def test_binary_rows():
    v, off = np.array([1, 2, 3], np.int64), np.array([0, 2, 2, 3])
    x, o = N.unbinary_rows(N.binary_rows(v, off))
    assert x.tolist() == [1, 2, 3] and o.tolist() == [0, 2, 2, 3]


@pytest.mark.parametrize(("word", "want"), [
    ("gօօgle", "google"), ("ɡoogle", "google"), ("Ꭺthens", "Athens"), ("ᴀbc", "abc"), ("ԁоmain", "domain"), ("ꓮΘΗΝΑ", "ΑΘΗΝΑ"), ("հայo", "հայօ"),
    ("ʃɪp", "ʃɪp"), ("カラー", "カラー"), ("ırmak", "ırmak"), ("東京タワー", "東京タワー"), ("ΚΑΙ", "ΚΑΙ"), ("KAI", "KAI"),
])
def test_scripts_beyond_the_three(word, want):
    assert N.consistent(word) == want and N.consistent(want) == want


def test_script_sets():
    assert N.script_set("a") == N.L and N.script_set("ω") == N.G and N.script_set("1") == 0 and N.script_set("օ") == N.BIT["Armenian"]
    assert N.script_set("ー") == N.BIT["Hiragana"] | N.BIT["Katakana"] and N.resolved("ラー")[0] == N.BIT["Katakana"] and N.resolved("gօ")[0] == 0
