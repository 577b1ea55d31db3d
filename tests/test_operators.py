"""Dedup, split, corruption, sequences, metrics and logs against small brute force."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from logosmill.functions import lexicon as X
from logosmill.operators import corrupt, dedup, logs, metrics, model_meta, ranking, sequence, split, vocab


def test_priority_dedup_with_binding_caps(spark):
    a = [("a", 1, i, x) for i, x in enumerate(["p", "q", "q", "r", "s"])]
    b = [("b", 2, i, x) for i, x in enumerate(["r", "s", "t", "p"])]
    make = lambda rows: spark.createDataFrame(rows, "source string, priority int, seq int, line string")
    got = dedup.priority_dedup([(make(a), 2), (make(b), None)], ["priority", "seq"]).select("source", "line").collect()
    # r and s lie beyond the first cap, so the second source may still give them
    assert sorted(map(tuple, got)) == [("a", "p"), ("a", "q"), ("b", "r"), ("b", "s"), ("b", "t")]


def test_hot_line_and_empty(spark):
    rows = [(i, "ναι" if i % 3 == 0 else f"λέξη {i}") for i in range(600)]
    df = spark.createDataFrame(rows, "seq int, line string")
    assert dedup.keep_first(df, ["seq"]).count() == 401
    assert dedup.keep_first(df.limit(0), ["seq"]).count() == 0


def test_global_rank(spark):
    xs = random.Random(1).sample(range(10_000), 700)
    df = ranking.global_rank(spark.createDataFrame([(x,) for x in xs], "x int"), ["x"])
    assert [r["rank"] for r in df.orderBy("x").collect()] == list(range(1, 701))
    assert {r.x for r in ranking.first_rows(df.select("x"), ["x"], 5).collect()} == set(sorted(xs)[:5])


def test_split_sizes(spark):
    for n in (0, 1, 150, 1000, 8000):
        df = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("hash"))
        got = Counter(r.split for r in split.split_lines(df).collect())
        part = min(max(100, int(0.025 * n)), n // 2)
        assert (got["train"], got["val"], got["test"]) == (n - 2 * part, part, part)
    stats = split.dataset_stats(split.split_lines(df)).first()
    assert stats.total_lines == 8000 and stats.val_lines == 200


def test_candidates(spark):
    w = spark.createDataFrame([("παιδί",)], "word string")
    got = {r.corrupted for r in corrupt.homophone_candidates(w).collect()}
    assert got == {"πεδί", "παειδί", "παοιδί", "παηδί", "παυδί"}
    assert len(X.ADJACENT) == 25 and sum(map(len, X.ADJACENT.values())) == 116
    got = {r.corrupted for r in corrupt.adjacency_candidates(spark.createDataFrame([("Λα",)], "word string")).collect()}
    assert got == {"Κα", "Πα", "Οα", "Λσ", "Λζ", "Λς", "Λε", "Λδ"}


def test_correction_samples(spark):
    sentences = ["Η ελληνική γλώσσα είναι πολύ όμορφη και πλούσια.", "«Θέλω» να πάμε μια βόλτα!", "ένα", "", "Ναι ναι", None, "α β"] * 30
    df = spark.createDataFrame([(str(i), s) for i, s in enumerate(sentences)], "id string, line string")
    rows = corrupt.correction_samples(df, "id").collect()
    assert {r.error_type for r in rows} == {"accent_strip", "adjacency", "homophone", "dynamics"}
    for r in rows:
        s = sentences[int(r.id)]
        assert r.corrupted_word != r.target_word and r.target_word.strip(X.EDGE) in s
        assert r.full_sequence == (f"{r.context.strip()} " if r.context.strip() else "") + f"<XBU>{r.corrupted_word}<XBC>{r.target_word}<XEC>"
        bad, good = r.corrupted_word.strip(X.EDGE), r.target_word.strip(X.EDGE)
        if r.error_type == "accent_strip":
            assert bad == good.translate(str.maketrans(X.ACCENTED, X.PLAIN))
        if r.error_type == "adjacency":
            assert len(bad) == len(good) and sum(a != b for a, b in zip(bad, good)) == 1
        if r.error_type == "dynamics":
            assert abs(len(bad) - len(good)) <= 1
    e = corrupt.evaluation_set(corrupt.correction_samples(df, "id"), 10).collect()
    assert len(e) == 10 and len({(r.context, r.corrupted_word, r.target_word) for r in e}) == 10


def test_shares_of_errors(spark):
    """Words with an accent, keys and sounds of one spelling: the kinds fall to 50, 30, 10 and 10 percent."""
    df = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit("α β ελπίδα").alias("line"))
    n = {r.error_type: r["count"] / 20_000 for r in corrupt.correction_samples(df, "id").groupBy("error_type").count().collect()}
    total = sum(n.values())  # a slip may give the word itself
    assert total > 0.95 and abs(n["accent_strip"] - 0.5) < 0.015 and abs(n["adjacency"] - 0.3) < 0.015 and abs(n["homophone"] - 0.1) < 0.01 and 0.08 < n["dynamics"] < 0.11


def test_sequences(spark):
    df = spark.createDataFrame([("a", [9, 5, 8, 6], True), ("b", list(range(7, 400)), True), ("c", None, False), ("d", [9], False)], "id string, ids array<int>, m boolean")
    got = {r.id: r for r in sequence.pack_sequences(df, masked_col="m").collect()}
    assert all(len(x) == 256 for r in got.values() for x in (r.input_ids, r.attention_mask, r.labels))
    assert got["a"].labels[:7] == [-100, -100, -100, 8, 6, 2, -100] and got["a"].input_ids[:7] == [1, 9, 5, 8, 6, 2, 3]
    assert got["b"].labels[0] == 1 and got["b"].input_ids[-1] != 2 and sum(got["b"].attention_mask) == 256
    assert got["c"].input_ids[:3] == [1, 2, 3] and sum(got["c"].attention_mask) == 2
    assert got["d"].labels[:4] == [1, 9, 2, -100]


def test_metrics(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(0, 5)) for _ in range(12)], rng.randint(0, 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, x array<double>, y int")
    r = metrics.hit_rates(df, "x", "y").first()
    rank = lambda x, y: sum(v > x[y] or (v == x[y] and i < y) for i, v in enumerate(x))
    for k in (1, 3, 5, 10):
        assert math.isclose(r[f"top{k}_acc"], sum(rank(x, y) < k for _, x, y in rows) / 60)
    loss = sum(math.log(sum(map(math.exp, x))) - x[y] for _, x, y in rows) / 60
    assert math.isclose(r.cross_entropy_loss, loss) and math.isclose(r.perplexity, math.exp(min(loss, 20)))
    top = {(t.id, t.rank): t.token for t in metrics.top_k(df, "id", "x", 3, masked=7).collect()}
    assert all(v >= 7 for v in top.values()) and len(top) == 180
    assert {t.id: t.token for t in metrics.argmax(df, "id", "x").collect()} == {i: x.index(max(x)) for i, x, _ in rows}
    empty = metrics.hit_rates(df.limit(0), "x", "y").first()
    assert empty.test_tokens == 0 and empty.cross_entropy_loss == 0


def test_logs(spark):
    text = "Epoch 1: 1%| | 95/8048 [00:10<01:00, 9it/s, loss=8.5965, lr=2.82e-05]\n[Step 250] Validation Loss: 4.1234 | Perplexity: 61.77"
    df = spark.createDataFrame([(1, "r", text), (2, "r", None), (3, "r", "[Step 9] Validation Loss: nan | Perplexity: nan")], "i int, run string, text string")
    assert [tuple(r)[3:] for r in logs.progress_points(df, ["i", "run"]).collect()] == [(95, 8.5965, 2.82e-05)]
    assert [tuple(r)[3:] for r in logs.validation_points(df, ["i", "run"]).collect()] == [(250, 4.1234, 61.77)]
    v = spark.createDataFrame([("r", i, float(x)) for i, x in enumerate([1, 2, 3, 4])] + [("s", 0, 7.0)], "run string, i int, v double")
    got = {(r.run, r.i): r.smooth for r in logs.moving_average(v, "run", ["i"], "v", 3).collect()}
    assert [got["r", i] for i in range(4)] == [1, 1, 2, 3] and got["s", 0] == 7
    assert [r.i for r in logs.best_checkpoints(v.where("run = 'r'").withColumn("v", F.abs(F.col("v") - 3)), "run", ["i"], "v").orderBy("i").collect()] == [0, 1, 2]


def test_vocabulary(spark):
    df = spark.createDataFrame([("Το σπίτι, το σπίτι 2x",), ("σπιτι",)], "line string")
    n = {r.word: r.n for r in vocab.augmented(vocab.seed_words(df)).collect()}
    assert n == {"Το": 1, "το": 1, "σπίτι": 2, "σπιτι": 3}
    kinds = Counter(r.kind for r in vocab.seed_corpus(df).collect())
    assert kinds == {"priority": 34 * 120, "word": 4 * 6, "line": 4}


def test_model_catalogue(spark):
    t = model_meta.tensor_catalogue(spark)
    assert model_meta.parameter_count(t).first().total == 36_152_832
    lr = {r.step: r.lr for r in model_meta.learning_rates(spark, 2000, 6).collect()}
    assert lr[0] == 0 and math.isclose(lr[500], 5e-4) and lr[5999] < 1e-9
