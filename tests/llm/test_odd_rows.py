"""Every operator on null ids, texts, labels and sources, empty, very long and repeated texts, empty tables and clashing columns."""

import pytest

from logosmill.llm import components, language, leakage, lookalikes, mixing, neardup, overlap, packing, quality, truncation

COMMON = [("el", "και"), ("el", "το"), ("el", "να"), ("en", "the"), ("en", "of"), ("en", "and")]
BASE = " ".join(f"λέξη{i} και" for i in range(15)) + "."
LONG = "Ο τόπος είναι μακριά και δεν τον ξέρω κανείς ακόμα. " * 4000
#: Columns that the operators use inside, as extra ones.
CLASH = ["k", "t", "s", "c", "b", "n", "h", "rep", "words", "id", "source", "near", "k1", "k2", "part", "salt", "_t", "key", "range", "e"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, BASE, "train", "el", "a"), (2, BASE, "val", None, "a"), (None, BASE, "test", "", None), (3, None, "train", "el", "a"), (4, "", "val", "en", "b"), (5, LONG, "train", "el", "b"), (5, LONG, "train", "el", "b"), (6, " \n \t", None, "zz", "b"), (7, "α", "train", "el", "")]
    extra = ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame([(*r, *("x" for _ in CLASH)) for r in rows], f"rec_id bigint, text string, split_name string, lang string, src string, {extra}")


def test_pairs(odd):
    for df, want in ((odd, {(1, 2)}), (odd.limit(0), set())):
        assert {(r.train_id, r.eval_id) for r in overlap.overlap_pairs(*overlap.split_overlaps(df)).collect()} == want
        assert {(r.train_id, r.eval_id) for r in overlap.overlap_pairs(*overlap.split_overlaps(df, with_spans=True)).collect()} == want
        links, group = neardup.alike_classes(df)
        assert {(r.id_a, r.id_b) for r in neardup.alike_pairs(links, group).collect()} == want and components.connected_components(links).count() == 0


def test_rows_as_they_are(odd):
    text = {r.rec_id: r for r in lookalikes.normalize_lookalikes(odd).collect()}
    assert text[3].consistent_text is None and text[4].consistent_text == "" and not text[5].changed
    stats = quality.text_quality(odd, COMMON).collect()
    assert len(stats) == 9 and {r.kind for r in stats if r.rec_id in (3, 4, 6)} == {"prose"} and sum(r.words == 40_000 for r in stats) == 2
    assert quality.text_quality(odd.limit(0), COMMON).count() == lookalikes.normalize_lookalikes(odd.limit(0)).count() == 0


def test_languages(odd):
    model = language.fit_language_model(odd, COMMON)
    got = {(r.rec_id, r.lang) for r in language.label_languages(odd, model, COMMON, output="found").collect()}
    assert got == {(2, "el"), (None, "el")}
    assert language.label_languages(odd, model, COMMON, output="segments").where("rec_id in (3, 4, 6)").count() == 0
    assert language.label_languages(odd.limit(0), language.fit_language_model(odd.limit(0), COMMON), COMMON).count() == 0


def test_mix(odd, spark):
    targets = spark.createDataFrame([(1, "a", 0.5, 2, "words", 1.0), (1, "b", 0.5, 1, "words", 1.0), (1, None, 0.0, 1, "words", 1.0)], "mix_id int, source_name string, target_share double, max_repeats int, size_unit string, total_factor double")
    usage, shares = mixing.mix_sources(odd.withColumnRenamed("source", "old").withColumnRenamed("src", "source_name"), targets)
    assert {r.rec_id for r in usage.collect()} == {1, 2, 5, 6} and shares.count() == 3  # a text of blanks is a record without words


def test_documents(odd, spark):
    items = spark.createDataFrame([(1, BASE), (2, None), (None, BASE), (3, "")], "item_id bigint, text string")
    assert {(r.rec_id, r.item_id) for r in leakage.leaked_items(odd, items, doc_id="rec_id").collect()} == {(1, 1), (2, 1), (None, 1)}
    assert leakage.leaked_items(odd, items.limit(0), doc_id="rec_id").count() == leakage.leaked_items(odd.limit(0), items, doc_id="rec_id").count() == 0
    model, limits = truncation.fit_truncation(odd, ["και"], "rec_id", "src")
    scored = truncation.score_truncation(odd, model, limits, "rec_id", "src").collect()
    assert len(scored) == 9 and all(not r.cut for r in scored if r.rec_id in (3, 4, 6))
    tokens = spark.createDataFrame([(None, 5), (1, None), (2, 0), (3, 30), (3, 30), (4, 5)], "id bigint, tokens bigint")
    packed = packing.pack(tokens, [(1, 12, 1)]).collect()
    assert sum(r.tokens for r in packed) == 70 and max(r.tokens for r in packed) == 12
