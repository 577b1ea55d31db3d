"""Mixing, packing and truncation."""

import random
from collections import defaultdict

import numpy as np
import pytest

from logosmill.llm import mixing, packing, truncation


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    rng = random.Random(1)
    rows = [(i, "a" if i < 900 else "b" if i < 1000 else "c", " ".join(["λέξη"] * rng.randint(1, 30))) for i in range(1100)]
    rows += [rows[0], (5000, "a", None), (5001, "a", "")]
    df = spark.createDataFrame(rows, "rec_id bigint, source_name string, text string")
    targets = [(m, s, w, r, u, f) for m, u, f, spec in ((1, "words", 0.5, [("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.2, 1)]), (2, "chars", 1.5, [("a", 0.4, 2), ("b", 0.5, 3), ("d", 0.1, 2)]), (3, "records", 0.3, [("a", 0.3, 1), ("c", 0.7, 2)])) for s, w, r in spec]
    t = spark.createDataFrame(targets, "mix_id int, source_name string, target_share double, max_repeats int, size_unit string, total_factor double")
    usage, shares = mixing.mix_sources(df, t)
    size = {i: {"words": len(x.split()), "chars": len(x), "records": 1} for i, _, x in rows if x}
    src = {i: s for i, s, x in rows if x}
    used, times = defaultdict(int), {}
    for r in usage.collect():
        assert (r.mix_id, r.rec_id) not in times
        times[r.mix_id, r.rec_id] = r.times
        unit = next(u for m, s, w, q, u, f in targets if m == r.mix_id)
        used[r.mix_id, r.source_name] += r.times * size[r.rec_id][unit]
    got = {(r.mix_id, r.source_name): r for r in shares.collect()}
    for m, s, w, reps, u, f in targets:
        total = sum(x[u] for x in size.values())
        own = [x[u] for i, x in size.items() if src[i] == s]
        want = min(w * f * total, reps * sum(own))
        assert abs(used[m, s] - want) <= max(own, default=0) / 2 + 1e-6
        assert got[m, s].actual_size == used[m, s] and got[m, s].max_used <= reps
        ts = {times[m, i] for i in size if src[i] == s}
        assert not ts or max(ts) - min(ts) <= 1
    assert got[2, "d"].actual_size == 0 and abs(sum(got[1, s].actual_share for s in "abc") - 1) < 1e-9
    assert mixing.mix_sources(df.limit(0), t)[1].count() == len(targets)


def test_prefix_sums(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 10)
    rows = [(i, "s", i % 7, 1, 1) for i in range(333)]
    df = spark.createDataFrame(rows, "id bigint, source string, words bigint, chars bigint, records bigint")
    got = sorted((r.before_records, r.before_words, r.id % 7) for r in mixing.prefix_sums(df).collect())
    total = 0
    for k, (n, before, w) in enumerate(got):
        assert n == k and before == total
        total += w


@pytest.mark.parametrize(("cap", "gap"), [(64, 1), (300, 0), (2500, 1)])
def test_packing(spark, cap, gap):
    rng = random.Random(cap)
    rows = [(i, int(rng.lognormvariate(4, 1))) for i in range(3000)] + [(9000 + i, cap) for i in range(300)] + [(10_000, 7 * cap + 3), (10_001, 0)]
    df = spark.createDataFrame(rows, "id bigint, tokens bigint")
    out = packing.pack(df, [(5, cap, gap)], salts=8).collect()
    pieces, room = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.id].append((r.first_token, r.tokens))
        room[r.container].append(r.tokens)
    for i, n in rows:
        at = 0
        for first, k in sorted(pieces[i]):
            assert first == at and k > 0
            at += k
        assert at == n and (n > cap or len(pieces[i]) == (n > 0))
    assert all(sum(x) + gap * (len(x) - 1) <= cap for x in room.values())
    least = sum(n + gap for _, n in rows) / (cap + gap)
    assert len(room) <= 1.12 * least + 3
    assert packing.pack(df.limit(0), [(5, cap, gap)]).count() == packing.pack(df, []).count() == 0
    solved = packing.plans(df, [(5, cap, gap)]).first()
    assert len(room) == solved.containers >= solved.bound - 1e-6


def test_plan_is_near_the_bound_and_holds_every_item():
    rng = np.random.default_rng(4)
    for n, cap, spread in ((200, 50, 0.4), (20_000, 257, 0.7), (20_000, 8193, 0.9), (3, 10, 0.1)):
        lengths = np.clip(rng.lognormal(np.log(cap / 3 if cap < 300 else 400), spread, n).astype(int), 1, cap)
        sizes, counts = np.unique(lengths, return_counts=True)
        plan, bound = packing.plan_containers(sizes, counts, cap)
        held = np.zeros(len(sizes), np.int64)
        for which, per, times in plan:
            assert times > 0 and sizes[which] @ per <= cap
            held[which] += per.astype(np.int64) * times
        used = sum(t for *_, t in plan)
        fit = sum(t for *_, t in packing.best_fit(sizes, counts, cap))
        assert (held == counts).all() and bound <= used + 1e-9 and used <= fit, (used, fit, bound)


def test_best_fit_by_length_equals_one_by_one():
    rng = np.random.default_rng(8)
    for _ in range(60):
        cap = int(rng.integers(5, 60))
        sizes, counts = np.unique(rng.integers(1, cap + 1, int(rng.integers(1, 80))), return_counts=True)
        free: list[int] = []
        for s in sorted(np.repeat(sizes, counts).tolist(), reverse=True):
            able = [f for f in free if f >= s]
            if able:
                free.remove(min(able))
                free.append(min(able) - s)
            else:
                free.append(cap - s)
        got = [cap - int(sizes[w] @ p) for w, p, t in packing.best_fit(sizes, counts, cap) for _ in range(t)]
        assert sorted(got) == sorted(free)


def test_program_beats_best_fit_where_few_items_share_a_container():
    rng = np.random.default_rng(1)
    sizes, counts = np.unique(np.clip(rng.normal(100, 30, 100_000).astype(int), 20, 250), return_counts=True)
    used, fit = (sum(x[2] for x in p) for p in (packing.plan_containers(sizes, counts, 257)[0], packing.best_fit(sizes, counts, 257)))
    assert used < 0.99 * fit


def test_bound_is_a_bound():
    sizes, counts = np.array([6, 7]), np.array([40, 40])  # two never fit into 11, so 80 containers
    assert packing.most_valuable(sizes, np.ones(2), 11) == 1 and packing.most_valuable(sizes, np.array([6.0, 7.0]), 13) == 13
    assert packing.solve_program(sizes, counts, 11)[2] > 74


def test_knapsack_is_best():
    rng = np.random.default_rng(1)
    for _ in range(20):
        s, v, m = rng.integers(1, 9, 4), rng.uniform(1, 5, 4), rng.integers(1, 4, 4)
        got = packing.knapsack(s, v, m, 15)
        best = max((np.dot(v, x) for x in np.ndindex(*(m + 1)) if np.dot(s, x) <= 15))
        assert np.dot(s, got) <= 15 and (got <= m).all() and abs(np.dot(v, got) - best) < 1e-9


def test_token_counts(spark):
    P = pytest.importorskip("public_tokenizers")
    df = spark.createDataFrame([(1, "Καλημέρα σε όλους"), (2, None), (3, "")], "doc_id bigint, text string")
    n = {r.id: r.tokens for r in packing.token_counts(df, P.path("byte_bpe_multi_50k.tiktoken")).collect()}
    assert n[1] > 3 and n[2] == n[3] == 0


SENTENCES = ["Ο κόσμος άρχισε να κρατάει τον δρόμο για την πόλη.", "Δεν ξέρω γιατί ήρθε ο πελάτης στο σπίτι μας;", "«Η θάλασσα είναι μακριά από το χωριό.»", "Τότε γύρισε και μας είδε από το παράθυρο!"]


def documents(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = " ".join(rng.choice(SENTENCES) for _ in range(rng.randint(2, 12)))
        if i % 9 == 0:
            t += "\n" + rng.choice(["Μαρία", "Με εκτίμηση", "1. Πόλη\n2. Δρόμος\n3. Πέτρα"])
        cut = i % 7 == 3 and len(t) > 200
        rows.append((i, "web" if i % 2 else "book", t[:200] if cut else t, cut))
    return rows


def test_truncation(spark):
    rows = documents(1500)
    df = spark.createDataFrame([r[:3] for r in rows] + [(9000, "web", None), (9001, None, ""), (9002, "x", "   ")], "doc_id bigint, source string, text string")
    limits = {(r.s, r.u, r.n) for r in truncation.find_limits(df, "source").collect()}
    assert {("web", "c", 200), ("book", "c", 200)} <= limits
    model, table = truncation.fit_truncation(df, ["και", "να", "το", "για", "την", "τον", "από", "σε"])
    assert model.held_out > 0.93 and model.held_out_blind > 0.9 and min(model.held_out_by_class.values()) > 0.9
    got = {r.doc_id: r.cut for r in truncation.score_truncation(df, model, table).collect()}
    truth = {i: c and t[-1] not in ".;!»" for i, _, t, c in rows}
    assert sum(got[i] == c for i, c in truth.items()) >= 0.98 * len(truth)
    assert not (got[9000] or got[9001] or got[9002])
    empty, none = truncation.fit_truncation(df.limit(0), [])
    assert truncation.score_truncation(df.limit(0), model, table).count() == 0 and empty.score("κάτι", "no") == 0.5 and none.count() == 0


def test_byte_limits_make_no_limits_in_characters(spark):
    rng = random.Random(3)
    words = ["λόγος", "house", "δρόμος", "tree", "πόλη", "και", "of"]
    rows = []
    for i in range(3000):
        t = " ".join(rng.choice(words) for _ in range(rng.randint(60, 400)))
        rows.append((i, "s" if i % 2 else None, t.encode()[:1024].decode("utf-8", "ignore") if i % 3 == 0 else t))
    got = {(r.s, r.u) for r in truncation.find_limits(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), "source").collect()}
    assert got == {("s", "b"), ("", "b")}


def test_closing_lines_are_whole():
    long = "λέξη " * 2000 + "τέλος"
    assert truncation.closing(f"0\n1\n2\n\nβ\n \n{long}  \n ") == f"1\n2\nβ\n{long}\n" and truncation.closing("α ") == "α " and truncation.closing(" \n") == "\n"
