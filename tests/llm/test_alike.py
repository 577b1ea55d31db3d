"""Near-duplicates, split overlaps and components against brute force."""

import random

import numpy as np
import pytest

from logosmill.llm import components, fmindex, neardup, overlap
from logosmill.llm.textnorm import words_of


def texts(n, seed=1):
    rng = random.Random(seed)
    vocab = [f"λέξη{'αβγδεζηθ'[i % 8]}{i}" for i in range(3000)]
    common = ["και", "το", "η", "να", "του", "δεν"]
    out = []
    for i in range(n):
        if out and rng.random() < 0.4:
            w = rng.choice(out)[1].split()
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], [rng.choice(vocab)], [w[k], rng.choice(common)], [w[k], w[k]]])
            if rng.random() < 0.3:
                rng.shuffle(w)
        else:
            w = [rng.choice(common if rng.random() < 0.4 else vocab) for _ in range(rng.randint(5, 40))]
        out.append((i, " ".join(w).upper() if rng.random() < 0.1 else " ".join(w), rng.choice(["train", "train", "val", "test"])))
    return out


def brute(rows, bar=0.7, least=10):
    s = {i: frozenset(words_of(t)) for i, t, _ in rows if t}
    s = {i: w for i, w in s.items() if len(w) >= least}
    ids = sorted(s)
    return {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if len(s[a] & s[b]) >= bar * len(s[a] | s[b]) - 1e-9}


EXTRA = [(9000, None, "train"), (9001, "", "val"), (9002, "λίγα", "test"), (9003, "α β", None)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, i) for i, t, s in rows + rows[:20] + EXTRA], "rec_id bigint, text string, split_name string, n bigint")


def test_near_duplicates(spark):
    rows = texts(700)
    want = brute(rows)
    got = [(r.id_a, r.id_b) for r in neardup.alike_pairs(*neardup.alike_classes(frame(spark, rows), bands=40)).distinct().collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(want) > 150
    assert len(got) >= 0.99 * len(want)
    empty = frame(spark, rows).limit(0)
    assert neardup.alike_pairs(*neardup.alike_classes(empty)).count() == 0


def test_weighted_links(spark):
    rows = texts(300, 5)
    df = frame(spark, rows)
    links = neardup.alike_classes(df, weighted=True, bands=40)[0].collect()
    s = {i: frozenset(words_of(t)) for i, t, _ in rows}
    s = {i: w for i, w in s.items() if len(w) >= 10}
    distinct = set(s.values())
    n = {w: sum(w in x for x in distinct) for w in set().union(*distinct)}
    weight = {w: np.log1p(1 / max(c / len(distinct), neardup.FLOOR)) for w, c in n.items()}
    total = lambda ws: sum(weight[w] for w in ws)
    for r in links:
        j = total(s[r.a] & s[r.b]) / total(s[r.a] | s[r.b])
        assert j >= 0.7 - 1e-6 and abs(j - r.weighted) < 1e-6
    reps = {}
    for i in sorted(s):
        reps.setdefault(s[i], i)
    ids = sorted(reps.values())
    want = sum(total(s[a] & s[b]) >= 0.7 * total(s[a] | s[b]) for x, a in enumerate(ids) for b in ids[x + 1 :])
    assert want > 20 and len(links) >= 0.97 * want


@pytest.mark.parametrize("entries", [10**6, 150])
def test_hot_copies_and_large_buckets(spark, monkeypatch, entries):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "PART_ENTRIES", entries)
    monkeypatch.setattr(neardup, "SAMPLED", 1)
    base = " ".join(f"λέξη{i}" for i in range(30))
    rows = [(i, f"{base} extra{i % 40}", "train") for i in range(60)] + [(100 + i, base, "train") for i in range(30)]
    want = brute(rows)
    links, group = neardup.alike_classes(spark.createDataFrame(rows, "rec_id bigint, text string, s string"), bands=80)
    assert links.count() <= 41 * 40 // 2  # links join texts, not copies
    assert {(r.id_a, r.id_b) for r in neardup.alike_pairs(links, group).distinct().collect()} == want
    hot = [(r.id_a, r.id_b) for r in neardup.alike_pairs(links, group, salts=5, hot=3).collect()]  # classes in pieces
    assert len(hot) == len(set(hot)) and set(hot) == want


def test_bucket_blocks_give_all_pairs():
    e = np.zeros(40, neardup.ENTRY)
    e["id"], e["n"], e["key"] = np.arange(40), 10, np.repeat([1, 2], 20)
    got = set()
    for x, y, blocks in neardup.bucket_pairs(e, 0.7, block=6):
        ids = [(a, b) for a in x["id"] for b in y["id"]] if blocks else zip(x, y)
        got |= {(min(a, b), max(a, b)) for a, b in ids if a != b}
    assert got == {(a, b) for a in range(40) for b in range(a + 1, 40) if a // 20 == b // 20}
    small = {(int(a), int(b)) for x, y, _ in neardup.bucket_pairs(e, 0.7) for a, b in zip(x, y)}
    assert small == got


def test_bitmap_filter_never_drops_alike_pairs():
    rng = np.random.default_rng(4)
    for _ in range(500):
        a = np.unique(rng.integers(0, 2**32, rng.integers(10, 60)).astype(np.uint32))
        b = np.unique(np.concatenate([a[: int(len(a) * rng.uniform(0.7, 1))], rng.integers(0, 2**32, rng.integers(0, 6)).astype(np.uint32)]))
        alike = len(np.intersect1d(a, b)) >= 0.7 * len(np.union1d(a, b))
        e = np.zeros(2, neardup.ENTRY)
        e["n"], e["id"] = [len(a), len(b)], [1, 2]
        e["bits"] = neardup.bitmaps(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert neardup.may_be_alike(e[:1], e[1:], 0.7)[0] or not alike


def test_icws_matches_weighted_jaccard():
    words = np.arange(400, dtype=np.uint32) * np.uint32(2654435761)
    w = np.random.default_rng(1).uniform(0.1, 40, 400)
    v = neardup.icws(words, w, 3000)
    a, b = np.arange(0, 260), np.arange(90, 400)
    both = np.arange(90, 260)
    j = w[both].sum() / w.sum()
    assert abs((v[a].min(0) == v[b].min(0)).mean() - j) < 0.035


@pytest.mark.parametrize("shard_words", [10**6, 900])
def test_split_overlaps(spark, shard_words):
    rows = texts(600, 2)
    split = {i: s for i, _, s in rows}
    want = {(a, b) for a, b in brute(rows) if (split[a] == "train") != (split[b] == "train")}
    links, group = overlap.split_overlaps(frame(spark, rows), shard_words=shard_words)
    pairs = overlap.overlap_pairs(links, group).collect()
    got = {(min(r.train_id, r.eval_id), max(r.train_id, r.eval_id)) for r in pairs}
    assert got == want and len(want) > 50
    assert all(split[r.train_id] == "train" and split[r.eval_id] != "train" and r.similarity >= 0.7 - 1e-9 for r in pairs)
    empty = overlap.overlap_pairs(*overlap.split_overlaps(frame(spark, rows).limit(0)))
    assert empty.count() == 0


def brute_matches(x, y):
    """Spans, words covered and longest match of two words or more."""
    inside, longest = set(), 0
    for i in range(len(x)):
        for j in range(len(y)):
            k = 0
            while i + k < len(x) and j + k < len(y) and x[i + k] == y[j + k]:
                k += 1
            if k > 1:
                inside |= set(range(i, i + k))
                longest = max(longest, k)
    return sum(i - 1 not in inside for i in inside), len(inside), longest


@pytest.mark.parametrize("shard_words", [10**6, 900])
def test_spans_of_each_pair(spark, shard_words):
    base = [f"λέξη{i}" for i in range(20)]
    near = [*base[:9], "άλλη", *base[10:]]
    last = [*base[10:], *base[:10]]  # the same set of words in another order
    made = [(5000, base, "train"), (5001, base, "val"), (5002, near, "test"), (5003, last, "test"), (5004, near[::-1], "val"), (5005, last, "train"), (5006, base + base[:5], "val")]
    rows = texts(400, 2) + [(i, " ".join(w), s) for i, w, s in made]
    words = {i: words_of(t) for i, t, _ in rows}
    pairs = overlap.overlap_pairs(*overlap.split_overlaps(frame(spark, rows), shard_words=shard_words, with_spans=True)).collect()
    assert len(pairs) > 50 and {(r.train_id, r.eval_id) for r in pairs} >= {(5000, 5001), (5000, 5002), (5000, 5003), (5000, 5004), (5005, 5001), (5005, 5003)}
    for r in pairs:
        assert (r.spans, r.covered, r.longest) == brute_matches(words[r.train_id], words[r.eval_id]), (r.train_id, r.eval_id)


def test_fm_index():
    rng = np.random.default_rng(3)
    recs = [rng.integers(0, 6, rng.integers(1, 30)).astype(np.uint32) for _ in range(40)]
    off = np.concatenate([[0], np.cumsum([len(r) for r in recs])])
    ix = fmindex.FMIndex(np.arange(40), np.concatenate(recs), off)
    places = lambda p: sorted(i for i, r in enumerate(recs) for k in range(len(r) - len(p) + 1) if (r[k : k + len(p)] == p).all())
    text = rng.integers(0, 8, 60).astype(np.uint32)
    sym, begin = ix.symbols(text), np.repeat([0, 30], 30)
    for length in (1, 2, 3):
        lo, hi = ix.matches(sym, begin, length)
        for e in range(60):
            start = e - length + 1
            assert sorted(ix.record[lo[e] : hi[e]].tolist()) == (places(text[start : e + 1]) if start >= begin[e] else []), (length, e)


def test_least_matches_holds_for_all_alike_sets():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        n = int(rng.integers(10, 60))
        universe = rng.permutation(200)[: n + int(rng.integers(0, 25))]
        x, y = np.sort(universe[:n]), np.sort(universe[int(rng.integers(0, n // 3)) :])
        s, u = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        if s < 0.7 * u or len(y) < 10:
            continue
        pairs = set(zip(x, x[1:])) & set(zip(y, y[1:]))
        a, b = np.array([len(x)]), np.array([len(y)])
        assert len(pairs) >= overlap.least_matches(a, b, 0.7)[0] >= overlap._sure(a, 0.7, 10)[0] >= 1
    n = np.arange(10, 3000)
    m = [np.arange(max(10, -(-7 * k // 10)), 10 * k // 7 + 1) for k in n]
    assert [overlap.least_matches(np.full(len(x), k), x, 0.7).min() for k, x in zip(n, m)] == overlap._sure(n, 0.7, 10).tolist()


def test_rows_come_from_backward_search(monkeypatch):
    rng = np.random.default_rng(6)
    recs = [np.sort(rng.permutation(400)[:20]).astype(np.uint32) for _ in range(50)]
    off = np.arange(0, 1001, 20)
    ix = fmindex.FMIndex(np.arange(50), np.concatenate(recs), off)
    found = overlap.search(ix, np.concatenate(recs), off)
    assert found["row"].tolist() == found["record"].tolist() == list(range(50))
    monkeypatch.setattr(fmindex.FMIndex, "step", lambda self, c, lo, hi: (lo * 0, lo * 0))
    assert not len(overlap.search(ix, np.concatenate(recs), off)["row"])


def test_low_bar_is_searched_by_words(spark):
    rows = texts(300, 8)
    split = {i: s for i, _, s in rows}
    want = {(a, b) for a, b in brute(rows, 0.4, 3) if (split[a] == "train") != (split[b] == "train")}
    pairs = overlap.overlap_pairs(*overlap.split_overlaps(frame(spark, rows), bar=0.4, least=3)).collect()
    assert {(min(r.train_id, r.eval_id), max(r.train_id, r.eval_id)) for r in pairs} == want and len(want) > 30


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
