"""Problem 3: near-duplicate records with small edits.

Improved consistent weighted sampling over TF-IDF shingles, banded, verified.
A shingle is one distinct word here and counts once, as TESTDATA.md measures
likeness by sets of words; its sampling weight is its smoothed idf, so that
records that share only frequent words seldom meet. Copies are one class.

A bucket is worked through in blocks; the candidates of a large one go out as
pairs of blocks to many tasks. Nothing is capped. Before the words of two
records are fetched, a bitmap test without loss throws out most pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .textnorm import binary_rows, mix64, unbinary_rows
from .wordsets import BAR, LEAST, classes, members, word_table

ROWS, BANDS = 4, 20
#: Shingles in less than this share of the texts all get the highest idf; only the others, at most (words a text) / FLOOR of them, are looked up.
FLOOR = 1e-3
BLOCK = 2048
#: Entries that one task takes; a part that a sample shows to hold more is split into blocks, and each pair of blocks is a task.
PART_ENTRIES, SAMPLED = 1_000_000, 64
PARTS_A_TASK = 4
ENTRY = np.dtype([("key", "<u4"), ("n", "<u2"), ("bits", "<u4"), ("id", "<i8")])


def frequent_shingles(reps: DataFrame, floor: float = FLOOR) -> tuple[np.ndarray, np.ndarray, int]:
    """Words in at least a ``floor`` share of all texts, their counts, and the number of texts. Counts cover every text;
    the result has a bound, the words of a mean text / ``floor``."""

    def partial(batches):
        held: list[np.ndarray] = []
        size = 0

        def flush():
            w, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(w.astype(np.int64)), pa.array(c)], ["w", "c"])

        for batch in batches:
            v, _ = unbinary_rows(batch.column(0), np.uint32)
            held.append(v)
            size += len(v)
            if size > 4_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    total = reps.count()
    rows = reps.select("words").mapInArrow(partial, "w bigint, c bigint").groupBy("w").agg(F.sum("c").alias("c")).where(F.col("c") >= max(1.0, floor * total)).collect()
    w = np.array([r.w for r in rows], np.uint32)
    c = np.array([r.c for r in rows], np.float64)
    order = np.argsort(w)
    return w[order], c[order], total


def _gamma2(h: np.ndarray) -> np.ndarray:
    """Gamma(2, 1) from 48 random bits."""
    a = ((h >> np.uint64(40)).astype(np.float32) + 0.5) / np.float32(1 << 24)
    b = (((h >> np.uint64(8)) & np.uint64(0xFFFFFF)).astype(np.float32) + 0.5) / np.float32(1 << 24)
    return -np.log(a * b)


def icws(words: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """The hash value of each (word, sample) under Ioffe's improved consistent weighted sampling; the least over a set is
    its sample. Equal weights give equal (k, t), so the value itself names the sampled element."""
    out = np.empty((len(words), samples), np.float32)
    lw = np.log(weights).astype(np.float32)
    base = words.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(samples):
            h = mix64(base + np.uint64(((k + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)))
            h2 = mix64(h + np.uint64(0x632BE59BD9B4E019))
            h3 = mix64(h2 + np.uint64(0xD1B54A32D192ED03))
            r, c = _gamma2(h), _gamma2(h2)
            beta = (h3 >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)
            t = np.floor(lw / r + beta)
            out[:, k] = np.log(c) - r * (t - beta) - r
    return out


class Sampler:
    """Signatures of word sets; values of words seen before are kept, up to a bound."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray, total: int, rows: int = ROWS, bands: int = BANDS, floor: float = FLOOR, held: int = 150_000):
        self.frequent, self.rows, self.bands, self.held = frequent, rows, bands, held
        # smoothed: a word of all texts keeps a weight, so copies of a frequent template with small edits still meet
        self.weight = np.log1p(1 / np.clip(counts / max(total, 1), floor, 1.0))
        self.most = float(np.log1p(1 / floor))
        self.known = np.zeros(0, np.uint32)
        self.slot = np.zeros(0, np.int64)
        self.values = np.zeros((0, rows * bands), np.float32)

    def weights(self, words: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return np.full(len(words), self.most)
        at = np.minimum(np.searchsorted(self.frequent, words), len(self.frequent) - 1)
        return np.where(self.frequent[at] == words, self.weight[at], self.most)

    def lookup(self, words: np.ndarray) -> np.ndarray:
        u, inv = np.unique(words, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, u), max(len(self.known) - 1, 0))
        new = u[self.known[at] != u] if len(self.known) else u
        if len(new):
            if len(self.known) + len(new) > self.held:
                self.known, self.slot, self.values, new = np.zeros(0, np.uint32), np.zeros(0, np.int64), self.values[:0], u
            base = len(self.known)
            if base + len(new) > len(self.values):
                grown = np.empty((max(2 * base, base + len(new), 4096), self.rows * self.bands), np.float32)
                grown[:base] = self.values[:base]
                self.values = grown
            self.values[base : base + len(new)] = icws(new, self.weights(new), self.rows * self.bands)
            known, slot = np.concatenate([self.known, new]), np.concatenate([self.slot, np.arange(base, base + len(new))])
            order = np.argsort(known)
            self.known, self.slot = known[order], slot[order]
        return self.slot[np.searchsorted(self.known, u)][inv]

    def keys(self, words: np.ndarray, off: np.ndarray, step: int = 2000) -> np.ndarray:
        """64-bit keys (sets x bands); no set is empty."""
        n = len(off) - 1
        out = np.empty((n, self.bands), np.uint64)
        where = self.lookup(words)
        for a in range(0, n, step):
            b = min(n, a + step)
            low = np.minimum.reduceat(self.values[where[off[a] : off[b]]], off[a:b] - off[a], axis=0).view(np.uint32).astype(np.uint64)
            h = np.zeros((b - a, self.bands), np.uint64) + np.arange(self.bands, dtype=np.uint64)
            with np.errstate(over="ignore"):
                for j in range(self.rows):
                    h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + low[:, j :: self.rows])
            out[a:b] = h
        return out


def bitmaps(words: np.ndarray, off: np.ndarray) -> np.ndarray:
    bit = np.uint32(1) << (mix64(words.astype(np.uint64)) >> np.uint64(59)).astype(np.uint32)
    return np.bitwise_or.reduceat(bit, off[:-1]).astype(np.uint32)


def may_be_alike(x: np.ndarray, y: np.ndarray, bar: float) -> np.ndarray:
    """False only for pairs under the bar: by size, and as bitmaps differ in at most as many bits as sets in words."""
    a, b = x["n"].astype(np.int64), y["n"].astype(np.int64)
    size = np.minimum(a, b) >= bar * np.maximum(a, b) - 1e-9
    size |= np.minimum(a, b) == 65535
    differ = np.bitwise_count(x["bits"] ^ y["bits"])
    return size & (differ <= (1 - bar) / (1 + bar) * (a + b) + 1e-9) & (x["id"] != y["id"])


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    """The block of an id, where a part is split."""
    return (mix64(ids.view(np.uint64) + np.uint64(29)) % np.uint64(blocks)).astype(np.int64)


def bucket_pairs(e: np.ndarray, bar: float, block: int = BLOCK):
    """From entries of equal hash range: pairs (two arrays of ids) of the small buckets, and pairs of blocks of the large ones."""
    e = e[np.lexsort((e["id"], e["key"]))]
    starts = np.flatnonzero(np.append(True, e["key"][1:] != e["key"][:-1])) if len(e) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(e)))
    small = (sizes > 1) & (sizes <= block)
    group = np.repeat(np.arange(len(starts)), sizes)
    first, size = starts[group], sizes[group]
    place = np.arange(len(e)) - first
    later = np.where(small[group], size - 1 - place, 0)
    for a in range(0, len(e), 200_000):
        b = min(len(e), a + 200_000)
        # a block of entries gives at most block x 200,000 pairs; so it is cut by their number again
        ends = np.cumsum(later[a:b])
        cut = [0, *np.searchsorted(ends, np.arange(2_000_000, int(ends[-1]) if len(ends) else 0, 2_000_000)).tolist(), b - a]
        for c, d in zip(cut, cut[1:]):
            k = later[a + c : a + d]
            i = np.repeat(np.arange(a + c, a + d), k)
            if not len(i):
                continue
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k)
            ok = may_be_alike(e[i], e[j], bar)
            x, y = e["id"][i[ok]], e["id"][j[ok]]
            yield np.minimum(x, y), np.maximum(x, y), None
    for s, n in zip(starts[sizes > block], sizes[sizes > block]):
        parts = [e[k : min(k + block, s + n)] for k in range(s, s + n, block)]
        for i, x in enumerate(parts):
            for y in parts[i:]:
                yield x, y, True


def candidates(reps: DataFrame, sampler: Sampler, bar: float = BAR) -> DataFrame:
    """Distinct (a, b), a < b, of classes that meet in a band and may be alike."""
    spark = reps.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, reps.count() * sampler.bands // PART_ENTRIES + 1)
    block = BLOCK
    split: dict[int, int] = {}  # part -> blocks, filled below; empty unless keys are skewed

    def sign(batches):
        for batch in batches:
            v, off = unbinary_rows(batch.column(2), np.uint32)
            if not len(v):
                continue
            keys = sampler.keys(v, off)
            e = np.empty(keys.shape, ENTRY)
            e["key"] = (keys >> np.uint64(32)).astype(np.uint32)
            e["n"] = np.minimum(np.asarray(batch.column(1)), 65535)[:, None]
            e["bits"] = bitmaps(v, off)[:, None]
            e["id"] = np.asarray(batch.column(0))[:, None]
            part = ((keys & np.uint64(0xFFFFFFFF)) % np.uint64(parts)).astype(np.int32).ravel()
            order = np.argsort(part, kind="stable")
            e, part = e.ravel()[order], part[order]
            cut = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            ends = np.append(cut, len(part))
            rows = []
            for p, a, b in zip(part[cut].tolist(), ends[:-1].tolist(), ends[1:].tolist()):
                n = split.get(p, 1)
                if n == 1:
                    rows.append((p, 0, 0, e[a:b].tobytes()))
                    continue
                own = block_of(e["id"][a:b], n)
                for i in np.unique(own).tolist():
                    data = e[a:b][own == i].tobytes()
                    rows += [(p, min(i, j), max(i, j), data) for j in range(n)]
            p, i, j, data = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(data, pa.binary())], ["p", "i", "j", "e"])

    def pairs(key, table):
        p, i, j = (k.as_py() for k in key)
        e = np.frombuffer(b"".join(table.column("e").to_pylist()), ENTRY)
        out = [[], [], [], []]
        for x, y, blocks in bucket_pairs(e, bar, block):
            if blocks:
                out[2].append(x.tobytes())
                out[3].append(y.tobytes())
            else:
                out[0].append(x)
                out[1].append(y)
        a, b = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out[:2])
        if i != j:  # pairs within a block are found where the block meets itself
            apart = block_of(a, split[p]) != block_of(b, split[p])
            a, b = a[apart], b[apart]
        if len(a):
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            a, b = a[new], b[new]
        m = len(out[2])
        return pa.table({
            "a": pa.concat_arrays([pa.array(a), pa.nulls(m, pa.int64())]), "b": pa.concat_arrays([pa.array(b), pa.nulls(m, pa.int64())]),
            "x": pa.concat_arrays([pa.nulls(len(a), pa.binary()), pa.array(out[2], pa.binary())]), "y": pa.concat_arrays([pa.nulls(len(a), pa.binary()), pa.array(out[3], pa.binary())]),
        })

    def expand(batches):
        for batch in batches:
            plain = np.asarray(batch.column(2).is_null())
            keep = pa.array(plain)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])
            for i in np.flatnonzero(~plain):
                x, y = np.frombuffer(batch.column(2)[i].as_py(), ENTRY), np.frombuffer(batch.column(3)[i].as_py(), ENTRY)
                for a in range(0, len(x), 128):
                    i2, j2 = np.repeat(np.arange(a, min(a + 128, len(x))), len(y)), np.tile(np.arange(len(y)), min(128, len(x) - a))
                    ok = may_be_alike(x[i2], y[j2], bar)
                    p, q = x["id"][i2[ok]], y["id"][j2[ok]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["a", "b"])

    columns = reps.select("rep", "n", "words")
    some = columns.where(F.pmod(F.xxhash64("rep"), F.lit(SAMPLED)) == 0)
    schema = "p int, i int, j int, e binary"
    full = some.mapInArrow(sign, schema).groupBy("p").agg(F.sum(F.length("e")).alias("s")).where(F.col("s") > 4 * PART_ENTRIES * ENTRY.itemsize / SAMPLED).collect()
    split.update({r.p: int(r.s * SAMPLED / ENTRY.itemsize // PART_ENTRIES) + 1 for r in full})
    tasks = max(least, parts // PARTS_A_TASK)  # grow with the entries, whatever the session's number of partitions
    met = columns.mapInArrow(sign, schema).repartition(tasks, "p", "i", "j").groupBy("p", "i", "j").applyInArrow(pairs, "a bigint, b bigint, x binary, y binary")
    # blocks of several bands may hold the same pair; parted by a, as the verification needs them
    return met.distinct().mapInArrow(expand, "a bigint, b bigint").repartition(tasks, "a").distinct()


def verified(cands: DataFrame, reps: DataFrame, sampler: Sampler, bar: float = BAR, weighted: bool = False) -> DataFrame:
    """(a, b, shared, similarity, weighted) of the candidates that are alike.

    ``weighted`` is the weighted Jaccard similarity: the idf weight of shared
    shingles over that of all, weighed as in the sampling. With ``weighted`` the
    bar is on it. Else pairs under the least weighted similarity that a pair at
    the bar can have go first (weights have a least and a highest value, so
    this loses none), and the bar is on the share of equal words.
    """
    w = reps.select("rep", "words")
    both = cands.join(w.select(F.col("rep").alias("a"), F.col("words").alias("wa")), "a").join(w.select(F.col("rep").alias("b"), F.col("words").alias("wb")), "b").select("a", "b", "wa", "wb")
    low, high = float(np.log1p(1.0)), sampler.most
    floor = bar if weighted else bar * low / (bar * low + (1 - bar) * high)

    def run(batches):
        for batch in batches:
            x, xo = unbinary_rows(batch.column(2), np.uint32)
            y, yo = unbinary_rows(batch.column(3), np.uint32)
            n = batch.num_rows
            row = np.concatenate([np.repeat(np.arange(n), np.diff(xo)), np.repeat(np.arange(n), np.diff(yo))]).astype(np.int64)
            key = np.sort((row << 32) | np.concatenate([x, y]).astype(np.int64))
            again = np.append(False, key[1:] == key[:-1])
            mass = sampler.weights((key & 0xFFFFFFFF).astype(np.uint32))
            shared = np.bincount(key[again] >> 32, minlength=n)
            total = np.diff(xo) + np.diff(yo) - shared
            common = np.bincount(key[again] >> 32, mass[again], minlength=n)
            heavy = common / np.maximum(np.bincount(key >> 32, mass, minlength=n) - common, 1e-12)
            ok = heavy >= floor - 1e-9
            if not weighted:
                ok &= shared >= bar * total - 1e-9
            take = np.flatnonzero(ok)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(take)), batch.column(1).take(pa.array(take)), pa.array(shared[take].astype(np.int32)), pa.array(shared[take] / np.maximum(total[take], 1)), pa.array(heavy[take])],
                ["a", "b", "shared", "similarity", "weighted"],
            )

    return both.mapInArrow(run, "a bigint, b bigint, shared int, similarity double, weighted double")


def alike_classes(df: DataFrame, id_col: str = "rec_id", bar: float = BAR, least: int = LEAST, weighted: bool = False, **sampling) -> tuple[DataFrame, DataFrame]:
    """Links between classes of equal word sets (a, b, shared, similarity, weighted), and (rep, id) of every record with ``least`` words.

    The bar is on the share of equal words, or with ``weighted`` of their idf weight (sizes and bitmaps then prune nothing). ``df``: id and text columns; others are ignored. Null, empty and short
    texts are alike to none and have no row, nor have null ids. Redelivered rows count once.
    """
    rows = df.where(F.col(id_col).isNotNull()).select(id_col, "text")
    reps = written(classes(word_table(rows, [id_col], least)), "neardup-reps")
    sampler = Sampler(*frequent_shingles(reps), **sampling)
    links = verified(candidates(reps, sampler, 0.0 if weighted else bar), reps, sampler, bar, weighted)
    return links, written(members(word_table(rows, [id_col], least, with_words=False), reps), "neardup-group")


def _salted(pieces: int, name: str) -> F.Column:
    """For the larger side of a join on few keys: a piece by the record's id; the other side goes to all pieces."""
    return F.pmod(F.xxhash64(name), F.lit(pieces))


def alike_pairs(links: DataFrame, group: DataFrame, salts: int = 32, hot: int = 200) -> DataFrame:
    """All pairs of records (id_a < id_b): within a class, and between the members of linked classes.

    Classes of ``hot`` records and more are dealt out to ``salts`` pieces by the
    id of one side, so that no class is the work of one task.
    """
    sizes = group.groupBy("rep").count()
    large = sizes.where(F.col("count") >= hot).select("rep", F.lit(True).alias("_large"))
    member = group.join(large, "rep", "left").select("rep", "id", F.coalesce("_large", F.lit(False)).alias("large"))
    dealt = member.withColumn("salt", F.when(F.col("large"), _salted(salts, "id")).otherwise(F.lit(0).cast("bigint")))
    every = F.when(F.col("large"), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))
    spread = member.withColumn("salt", F.explode(every))
    # across: links go to all pieces of their first class, then meet the second class the same way
    first = links.join(large.withColumnRenamed("rep", "a"), "a", "left").withColumn("large", F.coalesce("_large", F.lit(False))).select("a", "b", F.explode(every).alias("salt"))
    left = first.join(dealt.select(F.col("rep").alias("a"), F.col("id").alias("x"), "salt"), ["a", "salt"]).select("b", "x")
    left = left.join(large.withColumnRenamed("rep", "b"), "b", "left").withColumn("large", F.coalesce("_large", F.lit(False))).select("b", "x", F.explode(every).alias("salt"))
    across = left.join(dealt.select(F.col("rep").alias("b"), F.col("id").alias("y"), "salt"), ["b", "salt"]).select("x", "y")
    several = sizes.where("count > 1").select("rep")
    within = dealt.join(several, "rep", "left_semi").select("rep", "salt", F.col("id").alias("x")).join(spread.select("rep", "salt", F.col("id").alias("y")), ["rep", "salt"]).where("x < y").select("x", "y")
    both = across.unionByName(within)
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
