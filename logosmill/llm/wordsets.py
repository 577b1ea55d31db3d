"""Records as sequences or sets of 32-bit word numbers, and groups of equal sets.

Word numbers are hashes of folded words. Two different words of a pair share
one with a chance of about 1e-7 a pair of texts, so the comparison on numbers
stands for the comparison on words; sets are told apart by 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnorm import CharBatch, binary_rows, distinct_per_row, mix64, powers, row_offsets, slices, to_string_array

#: Texts are alike if each has LEAST distinct words and they share BAR of all. Values of the task.
LEAST, BAR = 10, 0.7


def word_table(df: DataFrame, keep: list[str], least: int = LEAST, ordered: bool = False, with_words: bool = True) -> DataFrame:
    """``keep`` columns (the first is the id), n (distinct words), k1, k2 (of the word set, with ``ordered`` k2 of
    the words as they stand) and, if asked for, words: the distinct word numbers in rising order, or with ``ordered`` all of them as they stand. Texts with fewer than
    ``least`` distinct words, null and empty ones drop out: they are alike to none."""
    rows = df.select(*keep, F.col("text").alias("_t"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = f"{kept}, n int, k1 bigint, k2 bigint" + (", words binary" if with_words else "")
    names = [*keep, "n", "k1", "k2", *["words"] * with_words]

    def run(batches):
        for batch in batches:
            arr = to_string_array(batch.column(len(keep)))
            for a, b in slices(arr):
                cb = CharBatch(arr.slice(a, b - a))
                h = cb.hashes()
                r, v = distinct_per_row(cb.word_row, h)
                off = row_offsets(r, b - a)
                n = np.diff(off)
                take = np.flatnonzero(n >= least)
                if not len(take):
                    continue
                total = np.zeros((2, len(r) + 1), np.uint64)
                with np.errstate(over="ignore"):
                    np.cumsum(mix64(v.view(np.uint64) + np.uint64(0xA5A5A5A5)), out=total[0, 1:])
                    np.cumsum(mix64(v.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)), out=total[1, 1:])
                    keys = (total[:, off[1:]] - total[:, off[:-1]]).view(np.int64)[:, take]
                    if ordered:
                        at = row_offsets(cb.word_row, b - a)
                        power = powers(int(np.diff(at).max()))[0]
                        ordered_sum = np.zeros(len(h) + 1, np.uint64)
                        np.cumsum(mix64(h.view(np.uint64)) * power[np.arange(len(h)) - at[cb.word_row]], out=ordered_sum[1:])
                        keys[1] = (ordered_sum[at[1:]] - ordered_sum[at[:-1]]).view(np.int64)[take]
                cols = [batch.column(i).slice(a, b - a).take(pa.array(take)) for i in range(len(keep))]
                cols += [pa.array(n[take].astype(np.int32)), pa.array(keys[0]), pa.array(keys[1])]
                if with_words:
                    if ordered:
                        v, off = h, row_offsets(cb.word_row, b - a)
                        r = cb.word_row
                    mark = np.zeros(b - a, bool)
                    mark[take] = True
                    small = (v[mark[r]] & 0xFFFFFFFF).astype(np.uint32)
                    sizes = np.diff(off)[take]
                    ends = np.concatenate([[0], np.cumsum(sizes)])
                    if not ordered:
                        small = small[np.lexsort((small, np.repeat(np.arange(len(take)), sizes)))]
                    cols.append(binary_rows(small, ends))
                yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(run, schema)


def classes(table: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """One row per word set (and ``by``): rep, the least id, and its words. Copies collapse before the shuffle."""
    key = table.columns[0]
    return table.groupBy(*by, "k1", "k2").agg(F.min(key).alias("rep"), F.first("n").alias("n"), F.first("words").alias("words"))


def members(table: DataFrame, reps: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """(rep, id): every record with the representative of its word set, each once."""
    key = table.columns[0]
    return table.select(key, *by, "k1", "k2").join(reps.select(*by, "k1", "k2", "rep"), [*by, "k1", "k2"]).select("rep", F.col(key).alias("id")).distinct()
