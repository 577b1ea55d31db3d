"""Problem 9: text cut off by field limits.

Length limits show as lengths that far more texts of a source have than their
neighbours. Intact values are cut, whole as they are, at the limits of their
source and anywhere else, to get positives; intact values that happen to have
the length of a limit are negatives too. A hashed logistic regression on closing
characters, punctuation, the shape of the last four lines and the length's
distance to a limit is trained on them and scores every record.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import hash_sample, written
from .textnorm import consistent_all, fold_char

DIM = 1 << 13
#: The last word, in a text read backwards.
LAST_WORD = re.compile(r"\W*([^\W\d_]+)")
BULLET = re.compile(r"^(?:[-*•–—·]\s|\d{1,3}[.)]\s)")
SENTENCE = re.compile(r"[.!?;…»\"”)\]]$")
FINISHED = re.compile(r"[.!?;][»\"”)\]]?$")
BROKEN = re.compile(r"&#?[a-zA-Z0-9]*$|</?(?:[a-zA-Z][^<>]*)?$|�$")
VOWEL = set("αειουηωaeiouyаеиоуыэюя")


def _class(ch: str) -> str:
    if not ch:
        return "none"
    if ch.isalpha():
        return "U" if ch.isupper() else "l"
    return "9" if ch.isdigit() else ch


def closing(text: str, lines: int = 4) -> str:
    """The last ``lines`` lines with text, whole, and a sign of what blanks follow."""
    e = text.rstrip()
    blank = text[len(e) :]
    out, rest = [], e
    while rest and len(out) < lines:
        i = rest.rfind("\n")
        out.append(rest[i + 1 :])
        rest = rest[:i].rstrip() if i >= 0 else ""
    return "\n".join(reversed(out)) + ("\n" if "\n" in blank else " " if blank else "")


def _item(line: str) -> bool:
    """Whether a line looks like an item of a list: marked, or a few words with a capital first and no stop."""
    return line[-1:] not in ".;!?,:…" and bool(BULLET.match(line) or len(line.split()) <= 8 and line[:1].isupper())


def features(tail: str, near: str, common: set[str]) -> list[str]:
    """Names of the features that the end of a text (its ``closing`` lines) has; ``near``: whether its length is a limit of its source."""
    e = tail.rstrip()
    blank = tail[len(e) :]
    lines = [x for x in e.split("\n") if x.strip()]
    last = lines[-1].strip() if lines else ""
    before = lines[-2].strip() if len(lines) > 1 else ""
    words = last.split()
    n = len(words)
    m = LAST_WORD.match(e[::-1])
    w = "".join(map(fold_char, m[1][::-1])) if m else ""
    end = e[-1:]
    shape = "bullet" if BULLET.match(last) else "cap" if last[:1].isupper() else "low"
    count = "1" if n == 1 else "2-3" if n < 4 else "4-7" if n < 8 else "8+"
    few = 0 < len(before.split()) <= 6 and before[:1].isupper() and before[-1:] not in ".;!?,:"
    closed = "item" if BULLET.match(before) and before[-1:] not in ".;!?" or few else "stop" if SENTENCE.search(before) else "open" if before else "none"
    items = 0  # lines of a list that leads to the last line
    while items < len(lines) - 1 and _item(lines[-2 - items].strip()):
        items += 1
    dots = "..." if e.endswith("...") else "…" if end == "…" else ""
    greek = bool(w) and "α" <= w[-1] <= "ω"
    ending = "none" if not w else "common" if w in common else "vowel" if w[-1] in VOWEL else "sn" if w[-1] in "σν" else "bad" if greek else "other"
    quoted = "q" if last.count("«") > last.count("»") or last.count("(") > last.count(")") else ""
    line = f"{shape}|{count}|{closed}"
    c = _class(end)
    f = [
        f"end={c}{dots}", f"line={line}", f"end,line={c}{dots}|{line}", f"ending={ending}|{c}", f"near={near}", f"near,end={near}|{c}{dots}",
        f"broken={bool(BROKEN.search(e))}", f"blank={'nl' if chr(10) in blank else 'sp' if blank else ''}|{c}", f"prev={_class(e[-2:-1])}{c}{dots}",
        f"len={min(len(w), 8)}|{ending}|{shape}|{count}", f"open={quoted}|{c}", f"ending,line={ending}|{line}|{c}", f"suffix={w[-2:]}|{c if not c.isalpha() else 'L'}",
        f"items={items}|{shape}|{count}|{c if not c.isalpha() else 'L'}", f"items,near={items}|{near}", f"items,ending={items}|{ending}|{c if not c.isalpha() else 'L'}",
        f"lower={words[-1][:1].islower() if words else ''}|{count}|{closed}|{c}",
    ]
    return f


def hashed(fs: list[str]) -> list[int]:
    return [zlib.crc32(x.encode()) % DIM for x in fs]


#: A cut at a byte limit may lose a broken character, or hold the mark of one.
SLACK = 4


def near_limit(chars: int, size: int, limits: tuple[list[int], list[int]]) -> str:
    """Whether a length in characters or bytes is one of the limits (characters, bytes)."""
    if any(x - SLACK <= size <= x + SLACK for x in limits[1]):
        return "bytes"
    return "chars" if chars in limits[0] else "no"


def _spikes(lengths: DataFrame, unit: str, least: int, share: float, times: float) -> DataFrame:
    counts = lengths.groupBy("s", F.col(unit).alias("n")).agg(F.sum("rows").alias("count"))
    source = Window.partitionBy("s")
    near = source.orderBy("n")
    around = (F.sum("count").over(near.rangeBetween(-25, 25)) - F.sum("count").over(near.rangeBetween(-4, 4))) / 42
    spikes = counts.select("s", F.lit(unit).alias("u"), "n", "count", F.sum("count").over(source).alias("total"), around.alias("chance"))
    return spikes.where((F.col("count") >= least) & (F.col("count") >= share * F.col("total")) & (F.col("count") >= times * F.col("chance")))


def find_limits(df: DataFrame, source_col: str, text_col: str = "text", least: int = 5, share: float = 0.004, times: float = 8.0) -> DataFrame:
    """(s, u, n, count, total, chance): lengths in bytes (u = b) and characters (c) that stand out in each source.

    They hold a share of at least ``share`` of its texts (so at most 1 / share
    of them), at least ``least`` texts and ``times`` the mean ``chance`` of the
    42 lengths around. Counts cover all rows. A limit in one unit also makes
    lengths in the other stand out, less each: such a length, half of whose
    texts have a stronger one in the other unit, is none. A null source is ''.
    """
    lengths = df.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("s"), F.length(text_col).alias("c"), F.octet_length(text_col).alias("b"))
    lengths = written(lengths.groupBy("s", "c", "b").agg(F.count("*").alias("rows")), "cut-lengths")
    spikes = written(_spikes(lengths, "b", least, share, times).unionByName(_spikes(lengths, "c", least, share, times)), "cut-spikes")
    of = lambda u: spikes.where(F.col("u") == u).select("s", F.col("n").alias(u), F.col("count").alias(f"n_{u}"))
    both = lengths.join(of("c"), ["s", "c"]).join(of("b"), ["s", "b"])
    weaker = [both.where(test).groupBy("s", F.lit(u).alias("u"), F.col(u).alias("n")).agg((2 * F.sum("rows") >= F.first(f"n_{u}")).alias("explained")) for u, test in (("c", "n_b > n_c"), ("b", "n_c >= n_b"))]
    return written(spikes.join(weaker[0].unionByName(weaker[1]).where("explained"), ["s", "u", "n"], "left_anti"), "cut-limits")


def _windows(by_bytes: DataFrame) -> DataFrame:
    return by_bytes.select("s", F.explode(F.sequence(F.col("n") - SLACK, F.col("n") + SLACK)).alias("b")).distinct()


def with_limits(df: DataFrame, limits: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """k, s, t and near of each row. The limits are a join, small enough for a broadcast as a rule and of any size."""
    rows = df.select(df[id_col].alias("k"), F.coalesce(df[source_col].cast("string"), F.lit("")).alias("s"), df[source_col].cast("string").alias("source"), df[text_col].alias("t"), F.length(text_col).alias("c"), F.octet_length(text_col).alias("b"))
    at_bytes = _windows(limits.where("u = 'b'")).withColumn("_b", F.lit("bytes"))
    at_chars = limits.where("u = 'c'").select("s", F.col("n").alias("c"), F.lit("chars").alias("_c"))
    return rows.join(at_bytes, ["s", "b"], "left").join(at_chars, ["s", "c"], "left").select("k", "s", "source", "t", F.coalesce("_b", "_c", F.lit("no")).alias("near"))


def _cuts(text: str, rng: np.random.Generator) -> str:
    """An intact text cut somewhere, with what a cut may leave."""
    at = int(rng.integers(max(1, len(text) // 3), max(2, len(text))))
    x = text[:at]
    kind = rng.random()
    if kind < 0.12:
        return x.rstrip() + "…"
    if kind < 0.22:
        return x + "�"
    if kind < 0.28:
        return x + str(rng.choice(["<", "<b", "</", "<br"]))
    if kind < 0.34:
        return x + str(rng.choice(["&", "&qu", "&quo", "&am", "&nbs"]))
    return x


def _cut_at(text: str, limits: tuple[list[int], list[int]], rng: np.random.Generator) -> str | None:
    """An intact text cut at a limit of its source that it exceeds."""
    data = text.encode()
    able = [(x, False) for x in limits[0] if x < len(text)] + [(x, True) for x in limits[1] if x < len(data)]
    if not able:
        return None
    x, as_bytes = able[int(rng.integers(len(able)))]
    return data[:x].decode("utf-8", "replace" if rng.random() < 0.5 else "ignore") if as_bytes else text[:x]


class TruncationModel:
    """Logistic regression over hashed features; fitted on at most as many texts as it is given.

    ``rows``: (source, whole text, near). ``limits``: source -> (characters,
    bytes). Texts that end with a finished sentence are whole; the share of them
    that has the length of a limit tells how often whole texts do, and other
    intact texts count as negatives at a limit with that weight.
    ``held_out`` is the accuracy on texts not fitted, ``held_out_blind`` the same
    with the length hidden, ``held_out_by_class`` that of whole and of cut texts.
    """

    def __init__(self, rows: list[tuple[str, str, str]], limits: dict, common: set[str], seed: int = 7, rounds: int = 60):
        self.common = common
        rng = np.random.default_rng(seed)
        made: list[tuple[str, str, int, float, int]] = []  # closing, near, cut, weight, row
        closings = [closing(text) for _, text, _ in rows]
        finished = [bool(FINISHED.search(x.rstrip())) for x in closings]
        chance = max(1e-4, sum(near != "no" for (_, _, near), f in zip(rows, finished) if f) / max(sum(finished), 1))
        for i, ((source, text, near), end, whole) in enumerate(zip(rows, closings, finished)):
            own = limits.get(source, ([], []))
            if near == "no" and not BROKEN.search(end.rstrip()):
                made.append((end, "no", 0, 1.0, i))
                made += [(end, x, 0, chance, i) for x, some in zip(("chars", "bytes"), own) if some]
            elif near != "no" and whole:
                made.append((end, near, 0, 1.0, i))
            if near != "no" and not whole:
                continue  # most likely cut already
            for cut in (_cuts(text, rng), _cut_at(text, own, rng)):
                if cut and not FINISHED.search(cut.rstrip()):  # a cut after a finished sentence can't be told, and counts as whole
                    made.append((closing(cut), near_limit(len(cut), len(cut.encode()), own), 1, 1.0, i))
        self.weights = np.zeros(DIM + 1)
        if not made:
            return
        ends = consistent_all([x[0] for x in made])
        near = [x[1] for x in made]
        x = np.array([hashed(features(t, z, common)) for t, z in zip(ends, near)])
        y, weight, row = (np.array([m[j] for m in made], float) for j in (2, 3, 4))
        hold = (rng.random(len(rows)) < 0.2)[row.astype(int)]  # all forms of a text on one side
        w, g2 = self.weights, np.full(DIM + 1, 1e-6)
        share = (y * weight).sum() / weight.sum()
        balance = np.where(y == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) * weight * ~hold
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-(w[x].sum(1) + w[DIM])))
            d = (p - y) * balance
            g = np.bincount(x.ravel(), np.repeat(d, x.shape[1]), minlength=DIM + 1)
            g[DIM] = d.sum()
            g = g / len(y) + 2e-5 * w
            g2 += g * g
            w -= 0.5 * g / np.sqrt(g2)

        def accuracy(z: np.ndarray, which: np.ndarray) -> float:
            right = ((w[z].sum(1) + w[DIM] > 0) == (y[which] == 1)) * weight[which]
            return float(right.sum() / weight[which].sum()) if len(z) else float("nan")

        blind = np.array([hashed(features(ends[i], "no", common)) for i in np.flatnonzero(hold)], int).reshape(int(hold.sum()), x.shape[1])
        self.held_out, self.held_out_blind = accuracy(x[hold], hold), accuracy(blind, hold)
        self.held_out_by_class = {k: accuracy(x[hold & (y == v)], hold & (y == v)) for k, v in (("whole", 0), ("cut", 1))}

    def score(self, end: str, near: str) -> float:
        """``end``: the closing lines in the consistent form. A text that ends with a finished sentence is whole, whatever its length."""
        if not end.strip() or FINISHED.search(end.rstrip()):
            return 0.0
        return float(1 / (1 + np.exp(-(self.weights[hashed(features(end, near, self.common))].sum() + self.weights[DIM]))))


def fit_truncation(df: DataFrame, common: list[str], id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", sample: int = 6000) -> tuple[TruncationModel, DataFrame]:
    """The model and the table of limits. Limits from all rows; the classifier from about ``sample`` whole texts (all, if fewer), chosen by hash of the id."""
    limits = find_limits(df, source_col, text_col)
    picked = with_limits(hash_sample(df, id_col, sample).where(F.length(text_col) > 20), limits, id_col, source_col, text_col)
    rows = sorted({(r.s, r.t, r.near) for r in picked.select("s", "t", "near").collect()})
    known: dict = {}
    for r in limits.join(picked.select("s").distinct(), "s").collect():  # those of at most ``sample`` sources
        known.setdefault(r.s, ([], []))[r.u == "b"].append(r.n)
    return TruncationModel(rows, known, {"".join(map(fold_char, w)) for w in common}), limits


def score_truncation(df: DataFrame, model: TruncationModel, limits: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", bar: float = 0.5, cut_only: bool = False) -> DataFrame:
    """(id, source, score, cut) for every row; with ``cut_only`` the ids of cut rows.

    Null, empty and blank texts and those that end with a finished sentence
    score 0. Repeated rows give repeated rows;
    other columns are ignored. The last four lines with text, whole, and the
    length enter the score.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ends = consistent_all([closing(x) if x else "" for x in batch.column(2).to_pylist()])
            score = np.array([model.score(t, near) for t, near in zip(ends, batch.column(3).to_pylist())])
            if cut_only:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.flatnonzero(score > bar)))], ["k"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array(score > bar)], ["k", "source", "score", "cut"])

    schema = f"k {kind}" if cut_only else f"k {kind}, source string, score double, cut boolean"
    return with_limits(df, limits, id_col, source_col, text_col).select("k", "source", "t", "near").mapInArrow(run, schema).withColumnRenamed("k", id_col)
