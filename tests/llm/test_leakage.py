"""Wu-Manber against brute force."""

import random

import numpy as np

from logosmill.llm import leakage as K
from logosmill.llm.textnorm import words_of


def brute(docs, items, m=10):
    grams = {}
    for i, t in items:
        w = words_of(t or "")
        for k in range(len(w) - m + 1):
            grams.setdefault(tuple(w[k : k + m]), set()).add(i)
    return {(d, i) for d, t in docs for w in [words_of(t or "")] for k in range(len(w) - m + 1) for i in grams.get(tuple(w[k : k + m]), ())}


def test_random_texts(spark):
    rng = random.Random(5)
    vocab = ["και", "το", "σπίτι", "Άλλο", "vα", "δρόμος", "x1", "η"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", ".\n", "..."]) for _ in range(n))
    items = [(i, text(rng.randint(8, 30))) for i in range(25)] + [(90, None), (91, ""), (92, "λίγα λόγια")]
    items += [(93, items[0][1]), (94, items[1][1] + " ακόμη " + text(5))]
    docs = []
    for d in range(120):
        parts = [text(rng.randint(0, 40))]
        if d % 3 == 0:
            w = items[rng.randrange(25)][1].split()
            a = rng.randrange(len(w))
            parts += [" ".join(w[a : a + rng.randint(5, 20)]).upper(), text(4)]
        docs.append((d, " ".join(parts)))
    docs += [(500, None), (501, ""), (502, text(3000) + " " + items[2][1]), (0, docs[0][1])]
    dd = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 as windows")
    ii = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (5000, 7):
        got = {(r.doc_id, r.item_id) for r in K.leaked_items(dd, ii, block=block).collect()}
        assert got == brute(docs, items)
    whole = {(r.doc_id, r.item_id) for r in K.leaked_items(dd, ii, whole=True).collect()}
    assert whole <= got
    assert K.leaked_items(dd, ii.limit(0)).count() == 0 and K.leaked_items(dd.limit(0), ii).count() == 0


def test_search_counts_every_occurrence():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 3, 4000).astype(np.int64)
    items = [(i, rng.integers(0, 3, 7).astype(np.int64)) for i in range(30)]
    wm = K.WuManber(items, 5)
    row, pat = wm.search(h, np.array([0, 1500, 1503, 4000]), stretch=64)
    want = sum((h[k : k + 5] == p).all() for a, b in ((0, 1500), (1503, 4000)) for k in range(a, b - 4) for p in wm.pattern)
    assert len(row) == want
