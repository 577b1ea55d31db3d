"""Problem 8: evaluation texts leaking into training text.

Wu-Manber search over word numbers: every run of ``m`` consecutive words of an
item is a pattern. Blocks of two words index a shift table; a shift of 0 leads
to the bucket of the block (the patterns' suffix), and the patterns of the
bucket are compared word by word. Many stretches of text are searched at once,
each with its own position. Items are dealt out to matchers in the shared folder;
documents are read and normalised once, whatever the number of items.
"""

from __future__ import annotations

import functools
import pickle
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, shared_value
from .textnorm import CharBatch, slices, to_string_array

#: Size of the shift table as a power of 2: by the number of blocks of two words, within these.
SHIFT_BITS = 18, 24
#: Words of documents that a task holds while the matchers pass.
HELD_WORDS = 2_000_000


class WuManber:
    """Patterns of ``m`` words each: hashes (patterns x m), and the item of each pattern."""

    def __init__(self, items: list[tuple[int, np.ndarray]], m: int = 10):
        self.m = m
        pats, owner = [], []
        for item, h in items:
            if len(h) >= m:
                pats.append(np.lib.stride_tricks.sliding_window_view(h, m))
                owner.append(np.full(len(h) - m + 1, item, np.int64))
        p = np.concatenate(pats) if pats else np.zeros((0, m), np.int64)
        own = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        # equal patterns of several items are compared once
        order = np.lexsort((own, *p.T[::-1])) if len(p) else np.zeros(0, np.int64)
        p, own = p[order], own[order]
        new = np.ones(len(p), bool)
        if len(p):
            new[1:] = (p[1:] != p[:-1]).any(1)
        self.owner, self.owner_off = own, np.append(np.flatnonzero(new), len(p))
        self.pattern = p[new]
        self.bits = int(np.clip(np.ceil(np.log2(2 * m * max(1, len(self.pattern)))), *SHIFT_BITS))
        self.shift = np.full(1 << self.bits, m - 1, np.int16)
        for j in range(1, m):
            if len(self.pattern):
                np.minimum.at(self.shift, self.block(self.pattern[:, j - 1], self.pattern[:, j]), m - 1 - j)
        suffix = self.block(self.pattern[:, -2], self.pattern[:, -1]) if len(self.pattern) else np.zeros(0, np.int64)
        # order within a bucket by the prefix word, as in the original's prefix table
        by = np.lexsort((self.pattern[:, 0], suffix)) if len(self.pattern) else np.zeros(0, np.int64)
        self.bucket_pattern, self.bucket_off = by, np.searchsorted(suffix[by], np.arange((1 << self.bits) + 1))

    def block(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (x >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, h: np.ndarray, offsets: np.ndarray, stretch: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """(row, pattern) of all occurrences in rows of word hashes; rows are cut into overlapping stretches."""
        none = np.zeros(0, np.int64)
        if not len(self.pattern) or not len(h):
            return none, none
        m = self.m
        block = np.zeros(len(h), np.int64)
        block[1:] = self.block(h[:-1], h[1:])
        lengths = np.diff(offsets)
        rows = np.flatnonzero(lengths >= m)
        per = -(-(lengths[rows] - m + 1) // stretch)
        row = np.repeat(rows, per)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
        pos = offsets[row] + nth * stretch + m - 1
        stop = np.minimum(offsets[row] + (nth + 1) * stretch + m - 1, offsets[row + 1])
        hit_row, hit_pat = [], []
        while len(pos):
            step = self.shift[block[pos]].astype(np.int64)
            at = np.flatnonzero(step == 0)
            if len(at):
                b = block[pos[at]]
                n = self.bucket_off[b + 1] - self.bucket_off[b]
                who = np.repeat(at, n)
                pat = self.bucket_pattern[np.repeat(self.bucket_off[b], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                start = pos[who] - m + 1
                for j in range(m):  # direct comparison, first word first
                    ok = h[start + j] == self.pattern[pat, j]
                    who, pat, start = who[ok], pat[ok], start[ok]
                    if not len(who):
                        break
                hit_row.append(row[who])
                hit_pat.append(pat)
                step[at] = 1
            pos = pos + step
            keep = pos < stop
            pos, stop, row = pos[keep], stop[keep], row[keep]
        return (np.concatenate(hit_row), np.concatenate(hit_pat)) if hit_row else (none, none)


def eval_hashes(rows: list[tuple[int, str]]) -> list[tuple[int, np.ndarray]]:
    """Word hashes of each item; null and empty texts have none."""
    arr = to_string_array(pa.array([t for _, t in rows], pa.large_string()))
    cb = CharBatch(arr)
    h = cb.hashes()
    off = np.searchsorted(cb.word_row, np.arange(len(rows) + 1))
    return [(i, h[a:b]) for (i, _), a, b in zip(rows, off[:-1], off[1:])]


@functools.lru_cache(maxsize=2)
def _matcher(path: str, part: int) -> tuple[WuManber, dict[int, int]] | None:
    data = shared_value(path, "matcher", part=part)
    return pickle.loads(zlib.decompress(data)) if data is not None else None


def leaked_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", item_text: str = "text", words: int = 10, block: int = 5000, whole: bool = False) -> DataFrame:
    """Items of which a document holds at least ``words`` consecutive words.

    Columns: doc id, item id, ``windows`` (distinct windows of the item found)
    and ``item_windows`` (windows the item has), one row per (row, item);
    ``whole`` keeps only items that stand wholly in the document. Items are
    dealt out to matchers of about ``block`` texts, files in the shared folder
    of which a task holds two at a time; they pass over the documents in its
    memory, which are read once. Null and empty texts and items under ``words``
    words give no rows. Repeated rows give repeated rows; other columns are
    ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(docs[doc_id].alias("k"), docs[text_col].alias("t"))
    small = items.select(items[item_id].cast("bigint").alias("i"), items[item_text].alias("t")).where("t is not null and i is not null").distinct()
    parts = small.count() // block + 1

    def build(key, table):
        wm = WuManber(eval_hashes(list(zip(table.column("i").to_pylist(), table.column("t").to_pylist()))), words)
        total = dict(zip(*(x.tolist() for x in np.unique(wm.owner, return_counts=True))))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "matcher": pa.array([zlib.compress(pickle.dumps((wm, total), protocol=5), 1)], pa.binary())})

    path = f"{shared_dir(docs.sparkSession)}/wu-manber-{uuid.uuid4().hex}"
    dealt = small.withColumn("part", F.pmod(F.xxhash64("i"), F.lit(parts)).cast("int"))  # all texts of an item meet in one
    dealt.groupBy("part").applyInArrow(build, "part int, matcher binary").write.parquet(path)

    def matched(held):
        for part in range(parts):
            found = _matcher(path, part)
            if found is None:
                continue
            wm, total = found
            for ids, h, off in held:
                row, pat = wm.search(h, off)
                if not len(row):
                    continue
                pair = np.unique(np.stack([row, pat], 1), axis=0)
                n = wm.owner_off[pair[:, 1] + 1] - wm.owner_off[pair[:, 1]]
                r = np.repeat(pair[:, 0], n)
                o = wm.owner[np.repeat(wm.owner_off[pair[:, 1]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                (both, count) = np.unique(np.stack([r, o], 1), axis=0, return_counts=True)
                have = np.array([total[x] for x in both[:, 1].tolist()], np.int32)
                if whole:
                    keep = count >= have
                    both, count, have = both[keep], count[keep], have[keep]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(both[:, 0])), pa.array(both[:, 1]), pa.array(count.astype(np.int32)), pa.array(have)], ["k", item_id, "windows", "item_windows"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            arr = to_string_array(batch.column(1))
            for a, b in slices(arr, 4_000_000):
                cb = CharBatch(arr.slice(a, b - a))
                held.append((batch.column(0).slice(a, b - a), cb.hashes(), np.searchsorted(cb.word_row, np.arange(b - a + 1))))
                size += len(cb.start)
                if size > HELD_WORDS:
                    yield from matched(held)
                    held, size = [], 0
        yield from matched(held)

    return rows.mapInArrow(run, f"k {kind}, {item_id} bigint, windows int, item_windows int").withColumnRenamed("k", doc_id)
