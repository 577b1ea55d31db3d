"""Writers."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as X


def write_splits(df: DataFrame, path: str) -> None:
    """Lines as text, one folder for each split; needs ``split``, ``line`` and ``rank``. Ranges of (split, rank) are tasks, so a
    split of any size is many files; within and between files (by name) lines are in order."""
    df.repartitionByRange("split", "rank").sortWithinPartitions("split", "rank").select("split", F.col("line").alias("value")).write.partitionBy("split").mode("overwrite").text(path)


def write_stats(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def write_samples(df: DataFrame, path: str) -> None:
    """Correction samples as JSON, one a line; letters are not escaped."""
    df.write.mode("overwrite").json(path)


def write_seed_corpus(df: DataFrame, path: str) -> None:
    df.select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def write_tokenizer_config(path: str, pad: str = "<pad>", length: int = 256) -> None:
    """Static settings files beside a tokenizer."""
    special = {"bos_token": "<s>", "eos_token": "</s>", "unk_token": "<unk>", "pad_token": pad, "additional_special_tokens": X.CONTROL}
    config = special | {"add_bos_token": True, "add_eos_token": False, "model_max_length": length, "tokenizer_class": "LlamaTokenizer"}
    Path(path).mkdir(parents=True, exist_ok=True)
    for name, value in (("special_tokens_map.json", special), ("tokenizer_config.json", config)):
        (Path(path) / name).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


def markdown_report(stats: dict, name: str) -> str:
    """The audit as text: stats holds the single rows and short lists of the audit operators."""
    t, c, a = stats["totals"], stats["characters"], stats["accents"]
    mark = "pass" if a["accent_ratio"] >= 0.9 else "low"
    out = [
        f"# Corpus audit: {name}", "", f"- lines: {t['lines']:,}", f"- words: {t['words']:,}", f"- characters: {t['chars']:,}",
        f"- words a line: {t['words_per_line']:.2f}", f"- vocabulary: {t['vocabulary']:,}", "", "## Characters", "",
        *(f"- {k}: {v:,} ({100 * v / max(t['chars'], 1):.2f} %)" for k, v in c.items()), "", "## Accents", "", f"- polysyllabic words: {a['polysyllabic']:,}",
        f"- accented: {a['accented']:,} ({100 * a['accent_ratio']:.2f} %, {mark})", "", "## Frequent words", "",
        *(f"{i}. {w} ({n:,})" for i, (w, n) in enumerate(stats["top_words"], 1)), "", "## Frequent words without an accent", "",
        *(f"- {w} ({n:,})" for w, n in stats.get("unaccented", [])), "", "## Shortest and longest lines", "",
        *(f"- {n}: {line}" for n, line in [*stats["shortest"], *stats["longest"]]), "", "## Lines with the least Greek", "",
        *(f"- {100 * r:.1f} %: {line}" for r, line in stats.get("least_greek", [])), "",
    ]
    return "\n".join(out)
