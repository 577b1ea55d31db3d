"""Problem 2: visually identical text with different characters."""

from __future__ import annotations

import functools
import unicodedata as ud

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textnorm import C, G, L, WORD, CharBatch, consistent, look_alike, resolved, script_of, slices, tables, to_string_array, whole_script_confusable


@functools.lru_cache(maxsize=100_000)
def _confusable(word: str) -> bool:
    return whole_script_confusable(word)


def _counts(raw: str) -> tuple[int, int]:
    """Words of several scripts, and words wholly of look-alikes, in a text as delivered."""
    mixed = whole = 0
    for m in WORD.finditer(raw):
        both, _ = resolved(m[0])
        if not both:
            mixed += 1
        elif both in (G, L, C) and _confusable(m[0]):
            whole += 1
    return mixed, whole


@functools.lru_cache(maxsize=1)
def _twins() -> np.ndarray:
    """For each character of the basic plane the scripts, besides its own, that have a look-alike for all letters in it; all scripts, if it has no letter."""
    script = tables()["script"]
    out = np.full(65537, G | L | C, np.uint8)
    for o in np.flatnonzero(script).tolist():
        parts = [(ch, s) for ch in ud.normalize("NFD", chr(o)) if (s := script_of(ch))]
        out[o] = sum(to for to in (G, L, C) if all(s != to and look_alike(ch, to) for ch, s in parts))
    return out


def whole_script_counts(cb: CharBatch) -> np.ndarray:
    """Words wholly of look-alikes in each row. ``cb`` as delivered; right for rows that are not suspicious."""
    n = len(cb.rows) - 1
    if not len(cb.start):
        return np.zeros(n, np.int32)
    ends = np.stack([cb.start, cb.end], 1).ravel()
    scripts = np.bitwise_or.reduceat(np.append(tables()["script"][cb.low], 0), ends)[::2]
    twins = np.bitwise_and.reduceat(np.append(_twins()[cb.low], 0), ends)[::2]
    hit = (scripts != 0) & (scripts & (scripts - 1) == 0) & (twins != 0) & (cb.end - cb.start > 1)
    return np.bincount(cb.word_row[hit], minlength=n).astype(np.int32)


def normalize_lookalikes(df: DataFrame, id_col: str = "rec_id", text_col: str = "text", changed_only: bool = False) -> DataFrame:
    """Each text in its consistent form.

    Columns: id, ``consistent_text``, ``changed``, ``mixed_words`` (words whose
    letters share no script) and ``whole_script_words`` (words that would look
    the same in another script; counted in every row, never altered).
    Null text gives a null form and ``changed`` false; an empty text stays
    empty. Rows are not deduplicated, other columns are ignored.
    ``changed_only`` returns the ids alone of changed rows.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(df[id_col].alias("k"), df[text_col].alias("t"))

    def run(batches):
        for batch in batches:
            text, ids = batch.column(1), batch.column(0)
            null = np.asarray(text.is_null())
            arr = to_string_array(text)
            for a, b in slices(arr):
                part = arr.slice(a, b - a)
                cb = CharBatch(part, resolve=False)
                todo = np.flatnonzero(cb.suspicious())
                raw = part.take(pa.array(todo)).to_pylist()
                new = [consistent(x) for x in raw]
                hit = [i for i, (x, y) in enumerate(zip(raw, new)) if x != y]
                rows_hit = todo[hit]
                if changed_only:
                    yield pa.RecordBatch.from_arrays([ids.slice(a, b - a).take(pa.array(rows_hit))], ["k"])
                    continue
                changed, mixed, whole = np.zeros(b - a, bool), np.zeros(b - a, np.int32), whole_script_counts(cb)
                changed[rows_hit] = True
                for x, r in zip(raw, todo):
                    mixed[r], whole[r] = _counts(x)
                mask = np.zeros(b - a, bool)
                mask[todo] = True
                out = pa.compute.replace_with_mask(part, pa.array(mask), pa.array(new, pa.large_string())).cast(pa.string())
                out = pa.compute.if_else(pa.array(null[a:b]), pa.scalar(None, pa.string()), out)
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), out, pa.array(changed), pa.array(mixed), pa.array(whole)], ["k", "consistent_text", "changed", "mixed_words", "whole_script_words"])

    schema = f"k {kind}" if changed_only else f"k {kind}, consistent_text string, changed boolean, mixed_words int, whole_script_words int"
    return rows.mapInArrow(run, schema).withColumnRenamed("k", id_col)
