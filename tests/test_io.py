"""Readers, writers and streams on small files."""

import json

from pyspark.sql import functions as F

from logosmill.functions import lexicon as X
from logosmill.sources import readers, writers
from logosmill.streaming import ingest


def test_raw_folder(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("  πρώτη \n\nδεύτερη\n".encode() + b"\xff\xfe" + "τρίτη\n".encode())
    (tmp_path / "b.jsonl").write_text(json.dumps({"text": "ένα\n\n δύο"}) + "\nκακό{\n" + json.dumps({"other": 1}) + "\n", encoding="utf-8")
    got = {(r.kind, r.line) for r in readers.read_raw_folder(spark, str(tmp_path)).collect()}
    assert got == {(1, "πρώτη"), (1, "δεύτερη"), (1, "τρίτη"), (2, "ένα"), (2, "δύο")}


def test_manifest_and_log(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"name": "c", "version": 1, "models": [{"id": "x", "filesize_bytes": 5}, {"id": "y", "filesize_bytes": 6}]}, indent=1))
    assert {r.id for r in readers.read_manifest(spark, str(tmp_path / "m.json")).collect()} == {"x", "y"}
    (tmp_path / "log").mkdir()
    (tmp_path / "log/t.log").write_text("a\nb")
    assert readers.read_log(spark, str(tmp_path / "log")).first().text == "a\nb"
    assert readers.fallback_lines(spark, ["α", "β"], 50).where(F.col("line").isin("α", "β")).count() == 50
    some = spark.createDataFrame([("γ",)], "line string")
    assert readers.or_fallback(some, ["α"], 9).count() == 1 and readers.or_fallback(some.limit(0), ["α"], 9).count() == 9 and len(set(X.FALLBACK)) == 20


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("train", 2, "β"), ("train", 1, "α"), ("val", 3, "γ")], "split string, rank int, line string")
    writers.write_splits(df, str(tmp_path / "s"))
    assert [r.value for r in spark.read.text(str(tmp_path / "s/split=train")).collect()] == ["α", "β"]
    s = spark.createDataFrame([("κ", "α", "ά", "accent_strip", "x")], "context string, corrupted_word string, target_word string, error_type string, full_sequence string")
    writers.write_samples(s, str(tmp_path / "j"))
    assert readers.read_samples(spark, str(tmp_path / "j")).first().target_word == "ά"
    writers.write_tokenizer_config(str(tmp_path / "t"))
    assert json.loads((tmp_path / "t/special_tokens_map.json").read_text())["pad_token"] == "<pad>"
    config = json.loads((tmp_path / "t/tokenizer_config.json").read_text())
    assert config["additional_special_tokens"] == [X.BAD, X.GOOD, X.END] and config["add_bos_token"] and not config["add_eos_token"] and config["tokenizer_class"]
    stats = {"totals": {"lines": 1000, "words": 2, "chars": 3, "words_per_line": 0.002, "vocabulary": 2}, "characters": {"greek": 3}, "accents": {"polysyllabic": 10, "accented": 9, "accent_ratio": 0.9}, "top_words": [("και", 5)], "shortest": [(1, "α")], "longest": [], "unaccented": [("μπορω", 3)], "least_greek": [(0.125, "abc α")]}
    assert "1,000" in writers.markdown_report(stats, "x") and "pass" in writers.markdown_report(stats, "x")
    assert all(x in writers.markdown_report(stats, "x") for x in ("μπορω (3)", "12.5 %: abc α", "greek: 3 (100.00 %)"))


def test_stream_dedup(spark, tmp_path):
    rows = [(f"2024-01-01 00:0{i}:00", line) for i, line in enumerate(["Πάμε μια βόλτα τώρα", "Πάμε μια βόλτα τώρα", "12", "Έλα μαζί μας σήμερα"])]
    spark.createDataFrame(rows, "t string, line string").select(F.to_timestamp("t").alias("t"), "line").write.parquet(str(tmp_path / "in"))
    q = ingest.unique_lines(ingest.stream_table(spark, str(tmp_path / "in")), "t").writeStream.format("memory").queryName("lines").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {r.line for r in spark.sql("select line from lines").collect()} == {"Πάμε μια βόλτα τώρα", "Έλα μαζί μας σήμερα"}
    assert spark.sql("select * from lines").count() == 2


def test_stream_of_log_points(spark, tmp_path):
    rows = [("2024-01-01 00:01:00", "a", 2.0), ("2024-01-01 00:09:00", "a", 4.0), ("2024-01-01 00:11:00", "a", 1.0), ("2024-01-01 00:02:00", "b", 7.0)]
    spark.createDataFrame(rows, "t string, run_key string, loss double").select(F.to_timestamp("t").alias("t"), "run_key", "loss").write.parquet(str(tmp_path / "in"))
    q = ingest.loss_by_window(ingest.stream_table(spark, str(tmp_path / "in")), "t", "loss").writeStream.format("memory").queryName("losses").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.run_key, r.mean_loss, r.points) for r in spark.table("losses").collect()) == [("a", 1.0, 1), ("a", 3.0, 2), ("b", 7.0, 1)]


def test_priority_words():
    assert len(X.PRIORITY_WORDS) == 34 and len(X.PROBE_WORDS) == 24
