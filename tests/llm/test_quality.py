"""Quality statistics: chunked counts equal whole counts; verdicts."""

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logosmill.llm import quality as Q
from logosmill.llm.textnorm import CharBatch, to_string_array

COMMON = [("el", w) for w in "ο η το και να δεν που με για από σε είναι θα του της τον την μας".split()] + [("en", "the"), ("en", "of"), ("en", "and")]
HASHES = Q.common_hashes(COMMON)


def whole(text):
    s, n = Q.batch_stats(CharBatch(to_string_array(pa.array([text]))), HASHES)
    return s[0].tolist(), n[0].tolist()


def chunked(text, sizes):
    """Stretches of these sizes, their states merged in any tree."""
    parts, rest = [], text
    for k in sizes:
        first, *more = Q.pieces_of(rest, k)
        if not more:
            break
        parts.append(first)
        rest = "".join(more)
    totals = Q.script_totals(text)
    states = [Q.stretch_state(x, HASHES, 7, lambda _: totals) for x in [*parts, rest]]
    while len(states) > 1:
        i = random.Random(len(states)).randrange(len(states) - 1)
        states[i : i + 2] = [Q.merge(states[i], states[i + 1])]
    s, n = Q.finish(states)[0]
    return s.tolist(), n.tolist()


TEXT = st.text(st.sampled_from(list("αβκσςάοη Ξ.,;|-/\t\n19)• Q<>=abcи\u0301\u00a0\u200b\u200dＡ")), max_size=80)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.lists(st.integers(1, 30), max_size=6))
def test_chunks_merge_to_the_whole(text, sizes):
    assert chunked(text, sizes) == whole(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=6), st.integers(1, 60))
def test_size_of_a_chunk_changes_nothing(texts, chunk):
    arr = to_string_array(pa.array(texts, pa.large_string()))
    for a, b in zip(Q.text_counts(arr, HASHES, chunk), Q.text_counts(arr, HASHES, 10**6)):
        assert a.tolist() == b.tolist()


def test_chunks_on_the_tables():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/wiki_articles.parquet")["text"].to_pylist()
    texts += pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    texts += ["\n".join(" " * 37 + f"{i}. Πόλη" for i in range(10, 38)), "α" * 5000, " " * 3000 + "1. Πόλη", "\n" * 2500]
    arr = to_string_array(pa.array(texts, pa.large_string()))
    want = [x.tolist() for x in Q.text_counts(arr, HASHES, 1 << 16)]
    for chunk in (50, 1000):
        assert [x.tolist() for x in Q.text_counts(arr, HASHES, chunk)] == want


@pytest.mark.parametrize(("text", "kind"), [
    ("Και όμως, ο βαλούρος τόπος ξενίποσε τον πόλεμο στη Μοβίχα.", "prose"),
    ("Έλα εδώ!", "prose"), ("Συγγνώμη.", "prose"), ("[ΓΕΛΙΑ] Δεν παχόπω τον τίτλο και την πόλη.", "prose"),
    ("1. Κηπονόνι 2. Ατιμιδούβης 3. Γητοκέντος 4. Στηχροτόζος", "list"),
    ("Βουζίπημα, Σιματόκης, Μοράνθος, Ροδούτα, Μεδρίβα, Κιρολήνης", "list"),
    ("Εκογόθο\t3862\t3995\tΛουνούγη\t955\t1232", "table"), ("Χρακάκι   3252   4051   Θοτιφόζη   3373   3141", "table"),
    ("Θοβρίβημα | 3325 | 4098 | Ζαβιβόκη | 4426", "table"), ("____________________", "junk"), ("28e4315ef99c8c 7bd64ea3d", "junk"),
    ("&nbsp; || </tr> ]] style= ]] ]] [[ </tr> }}", "junk"), ("εξξλυ ηψς θωγτχ ζγβ ξηκχμψρχινψ θωψοψρνπσβ", "junk"),
    ("21:16:55,482 --> 03:39:20,611 --> 14:21:36,613 -->", "junk"), ("", "prose"),
    ("Τίτλος\n1. Χητόγο (1896)\n2. Αγεζόφας\n3. Εμουφεβίφος του πόνου\n4. Σοθότι", "list"),
    ("Ο Χρήστος ήρθε και μίλησε με την πόλη.\nΤι έγινε με τον κόσμο;\nΟ δρόμος είναι μακρύς και δεν τελειώνει.\n1. Χητόγο\n2. Αγεζόφας", "prose"),
])
def test_verdicts(text, kind):
    assert Q.KINDS[Q.verdict([whole(text)[1]])[0]] == kind


def test_operator(spark):
    long = "Ο τόπος είναι μακριά και δεν τον ξέρω.\n" * 4000 + "τέλος χωρίς τελεία"
    df = spark.createDataFrame([(1, long, 5), (1, long, 6), (None, long, 5), (2, None, 5), (3, "", 5), (4, "Έλα.", 5), (4, "Έλα.", 5)], "rec_id bigint, text string, words int")
    rows = Q.text_quality(df, COMMON, chunk=500, span=1700).collect()
    got = {r.rec_id: r for r in rows}
    assert sorted(str(r.rec_id) for r in rows) == ["1", "1", "2", "3", "4", "4", "None"] and got[2].words == 0 and got[3].kind == "prose"
    s, n = Q.batch_stats(CharBatch(to_string_array(pa.array([long]))), HASHES)
    for k in (1, None):
        assert got[k].words == s[0][Q.WORDS] and got[k].lines == 4001 and got[k].chars == s[0][Q.CHARS]
    assert abs(got[1].stop_line_share - 4000 / 4001) < 1e-12 and abs(got[1].common_share - s[0][Q.COMMON] / s[0][Q.WORDS]) < 1e-12
    assert Q.text_quality(df.limit(0), COMMON).count() == 0
