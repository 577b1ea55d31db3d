"""Problem 6: per-document text quality statistics and verdicts.

Every text is cut into chunks, each behind a blank, before it is brought to the
consistent form; so no word and no composed letter is broken. A chunk gives
partial counts per line. Only its first and its last line can go on in its
neighbours: they stay open, with the characters at their edges that windows of
three characters need. ``merge`` closes them, so it is associative. Chunks of
one task are merged there, spans of huge texts in a tree over tasks. Ratios and
the verdict are derived at the end, and do not depend on the size of a chunk.
"""

from __future__ import annotations

import functools
import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnorm import CharBatch, fold_char, script_totals, slices, tables, to_string_array, word_hash

#: Additive features of a line.
CHARS, LETTERS, DIGITS, VOWELS, SAME, CELLS, COMMAS, DASHES, SLASHES, MARKS, SYMBOLS, CLUSTERS, WORDS, WORDCHARS, COMMON, NUMBERS, CAPS, CODES, BADENDS, MARKED = range(20)
NF = 20
#: Characters of a chunk, and of the spans that longer texts are dealt out in.
CHUNK, SPAN = 1000, 1 << 16
BLANK = re.compile(r"\s")
STOPS = set(".;!?…·;»\"”)]:,'")
ENDS = set(".;!?…;»\"”)]")
BULLETS = set("-*•–—·▪●")
_T: dict = {}

#: Rule text: a Greek letter -> its usual Latin spellings.
GREEKLISH = [("ου", "ou"), ("αυ", "av"), ("ευ", "ev"), ("θ", "th"), ("χ", "x"), ("ψ", "ps"), ("ξ", "x"), ("γ", "g"), ("δ", "d"), ("η", "i"), ("ω", "o"), ("φ", "f"), ("β", "v"), ("υ", "y"), ("ι", "i"), ("α", "a"), ("ε", "e"), ("ζ", "z"), ("κ", "k"), ("λ", "l"), ("μ", "m"), ("ν", "n"), ("ο", "o"), ("π", "p"), ("ρ", "r"), ("σ", "s"), ("τ", "t")]


def greeklish(word: str, variant: int = 0) -> str:
    """A folded Greek word in Latin letters; variants: 1 b for beta and y for upsilon in pairs, 2 h and w, 3 both."""
    table = dict(GREEKLISH)
    if variant & 1:
        table |= {"β": "b", "αυ": "au", "ευ": "eu", "χ": "ch"}
    if variant & 2:
        table |= {"η": "h", "ω": "w", "χ": "h", "υ": "u"}
    if variant & 4:
        table |= {"β": "b", "αυ": "ay", "ευ": "ey", "ξ": "ks"}
    out, i = [], 0
    while i < len(word):
        two = word[i : i + 2]
        if two in table:
            out.append(table[two])
            i += 2
        else:
            out.append(table.get(word[i], word[i]))
            i += 1
    return "".join(out)


def common_hashes(words: list[tuple[str, str]]) -> np.ndarray:
    """Sorted hashes of the common words (language, word), Greek ones also in Latin letters."""
    forms = set()
    for lang, w in words:
        f = "".join(map(fold_char, w or ""))
        for part in "".join(c if c.isalnum() else " " for c in f).split():
            forms.add(part)
            if lang == "el":
                forms |= {greeklish(part, v) for v in range(8)}
    return np.sort(word_hash(sorted(forms))) if forms else np.zeros(0, np.int64)


def char_tables() -> dict:
    if not _T:
        t = tables()
        letter, digit, upper, vowel, space, marked = (np.zeros(65537, bool) for _ in range(6))
        vowels = set("αειουηωaeiouyаеиоуыэюяё")
        for o in range(65536):
            if 0xD800 <= o <= 0xDFFF:
                continue
            ch = chr(o)
            letter[o], digit[o], upper[o], space[o] = ch.isalpha(), ch.isdigit(), ch.isupper(), ch.isspace()
            vowel[o] = letter[o] and chr(int(t["fold"][o])) in vowels if letter[o] else False
            marked[o] = letter[o] and (t["script"][o] != 1 or chr(int(t["fold"][o])) != ch.lower().replace("ς", "σ"))  # no plain Greek letter
        _T.update(marked=marked, letter=letter, digit=digit, upper=upper, vowel=vowel, space=space)
    return _T


def _flags(low: np.ndarray, begins: np.ndarray) -> dict:
    """What each character counts for, alone and with the two after it; ``begins``: where lines begin, behind which no window looks."""
    t = char_tables()
    n = len(low)
    letter, digit, vowel = t["letter"][low], t["digit"][low], t["vowel"][low]
    nxt = np.append(low[1:], 10)
    nxt[begins[1 : n + 1]] = 10
    nx2 = np.append(nxt[1:], 10)
    nx2[begins[1 : n + 1]] = 10
    full = ~t["space"][low]
    sp = low == 32
    return {
        CHARS: full,
        LETTERS: letter,
        DIGITS: digit,
        VOWELS: vowel,
        SAME: full & (low == nxt),
        CELLS: (low == 9) | (low == 124) | (sp & (nxt == 32) & (nx2 != 32) & (nx2 != 10)) | ((low == 59) & ~t["space"][nxt]),
        COMMAS: (low == 44) & (nxt == 32),
        DASHES: sp & (nx2 == 32) & ((nxt == 45) | (nxt == 0x2013) | (nxt == 0x2014) | (nxt == 0x2022) | (nxt == 0xB7)),
        SLASHES: sp & (nxt == 47) & (nx2 == 32),
        MARKS: digit & ((nxt == 46) | (nxt == 41)) & (nx2 == 32),
        SYMBOLS: full & ~letter & ~digit,
        CLUSTERS: _clusters(letter, vowel, nxt, nx2, t),
        MARKED: t["marked"][low],
    }


def line_matrix(cb: CharBatch, bounds: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Features of the lines [bounds[i], bounds[i+1]) of a batch, none of them without a character; a line break belongs to none."""
    t = char_tables()
    low = cb.low
    n = len(low)
    out = np.zeros((len(bounds) - 1, NF), np.int64)
    if not n or len(bounds) < 2:
        return out
    brk = low == 10
    begins = np.zeros(n + 2, bool)
    begins[bounds[bounds < n]] = True
    flags = _flags(low, begins)
    digit = flags[DIGITS]
    words_only = ~brk
    for k, f in flags.items():
        out[:, k] = np.add.reduceat((f & words_only).view(np.uint8), bounds[:-1], dtype=np.int64)
    if len(cb.start):
        h = cb.hashes()
        at = np.minimum(np.searchsorted(common, h), max(len(common) - 1, 0))
        known = common[at] == h if len(common) else np.zeros(len(h), bool)
        digits, caps = np.zeros(n + 1, np.int64), t["upper"][low[cb.start]]
        np.cumsum(digit, out=digits[1:])
        size = cb.end - cb.start
        nd = digits[cb.end] - digits[cb.start]
        where = np.searchsorted(bounds, cb.start, "right") - 1
        ok = (where >= 0) & (where < len(out))
        final = low[np.maximum(cb.end - 1, 0)]
        greek = (final >= 0x370) & (final < 0x400)
        bad_end = greek & ~t["vowel"][final] & ~np.isin(cb.folded[np.maximum(cb.end - 1, 0)], (0x3C3, 0x3BD)) & (size > 1)
        cols = {BADENDS: bad_end, WORDS: np.ones(len(h), np.int64), WORDCHARS: size, COMMON: known, NUMBERS: nd == size, CAPS: caps, CODES: ((nd > 0) & (nd < size) & (size >= 4)) | (size > 28)}
        for k, f in cols.items():
            out[:, k] = np.bincount(where[ok], np.asarray(f, float)[ok], minlength=len(out))
    return out


def _clusters(letter, vowel, nxt, nx2, t):
    cons = letter & ~vowel
    return cons & t["letter"][nxt] & ~t["vowel"][nxt] & t["letter"][nx2] & ~t["vowel"][nx2]


LIST, TABLE, JUNK, PROSE = range(4)
KINDS = ("list", "table", "junk", "prose")


def classify(m: np.ndarray, lead: list[str], last: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Kind of each line (features, its first twelve characters and its last one, blanks at its ends left out), and whether it is a bare short item."""
    n = len(m)
    words, common, num = m[:, WORDS], m[:, COMMON], m[:, NUMBERS]
    chars = np.maximum(m[:, CHARS], 1)
    stop = np.array([x[-1:] in ENDS or x[-1:] == "," for x in last], bool) if n else np.zeros(0, bool)
    marker = np.zeros(n, bool)
    first_cap = np.zeros(n, bool)
    for i, x in enumerate(lead):
        if not x:
            continue
        d = 0
        while d < len(x) and x[d].isdigit():
            d += 1
        if (x[0] in BULLETS and x[1:2].isspace()) or (0 < d <= 3 and x[d : d + 1] in (".", ")") and x[d + 1 : d + 2].isspace()) or (len(x) > 2 and x[0].isalpha() and x[1] in ".)" and x[2].isspace()):
            marker[i] = True
        first_cap[i] = x[0].isupper() or marker[i]
    share = common / np.maximum(words, 1)
    speaks = (common >= 2) & (share >= 0.15)
    kind = np.full(n, PROSE)
    plain = words - num
    items = np.maximum.reduce([m[:, COMMAS], m[:, DASHES], m[:, SLASHES]])
    named = m[:, CAPS] >= 0.7 * np.maximum(plain, 1)
    cells = m[:, CELLS]
    table = (cells >= 2) & (share < 0.25) & ((num >= 1) | (m[:, SYMBOLS] >= 2)) & (m[:, LETTERS] + m[:, DIGITS] >= 0.58 * chars) & ((num >= 2) | (cells <= plain + num + 1))
    inline = (m[:, MARKS] >= 3) & (plain <= 4 * m[:, MARKS]) & ~((cells >= 2) & (m[:, MARKS] < 3))
    rows = (items >= 3) & named & (common <= 0.12 * plain) & (plain <= 3 * (items + 1)) & (num <= 0.34 * plain + 1)
    item = marker & ~stop & (plain <= 8) & (m[:, LETTERS] > 0) | marker & (plain <= 5) & (common <= 1) & np.array([x[-1:] == ")" for x in last], bool)
    vow = m[:, VOWELS] / np.maximum(m[:, LETTERS], 1)
    salad = (common == 0) & (m[:, LETTERS] >= 12) & ((vow < 0.33) | (m[:, CLUSTERS] > 0.16 * m[:, LETTERS]) | ((m[:, BADENDS] >= 2) & (m[:, BADENDS] >= 0.3 * plain)) | ((m[:, MARKED] == 0) & (m[:, CLUSTERS] > 0.1 * m[:, LETTERS]))) & (plain >= 2)
    codes = (m[:, CODES] >= 0.5 * np.maximum(words, 1)) & (words > 0) & (common <= 1)
    thin = (m[:, LETTERS] < 0.5 * chars) & ~speaks & (chars >= 6)
    same = (m[:, SAME] > 0.5 * chars) & (chars >= 6)
    marks = (m[:, SYMBOLS] > 0.3 * chars) & ~speaks & (chars >= 8)
    kind[salad] = JUNK
    kind[thin | same | codes | marks] = JUNK
    kind[table & ~speaks & ~same] = TABLE
    kind[(inline | rows | item) & ~same & ~codes] = LIST
    kind[speaks & ~(item | inline | rows) & ~same] = PROSE
    kind[m[:, CHARS] == 0] = -1
    bare = (kind == PROSE) & ~stop & first_cap & (plain <= 5) & (common <= 1) & (plain >= 1)
    bare |= (kind == PROSE) & first_cap & (plain <= 5) & (common <= 1) & (num == 1) & np.array([x[-1:] == ")" for x in last], bool)
    return kind, bare


def pieces_of(text: str, size: int) -> list[str]:
    """The text in pieces of ``size`` characters and what follows up to the next blank (with it)."""
    out, at = [], 0
    while len(text) - at > size:
        m = BLANK.search(text, at + size - 1)
        if m is None or m.end() == len(text):
            break
        out.append(text[at : m.end()])
        at = m.end()
    return [*out, text[at:]]


def empty_state() -> dict:
    """Sums and line counts of whole lines, lines that were closed and wait for their kind, and the open parts at the ends."""
    return {"sums": np.zeros(NF, np.int64), "lines": np.zeros(7, np.int64), "closed": [], "open": []}


@functools.lru_cache(maxsize=50_000)
def _windows(text: str) -> np.ndarray:
    """What the characters of a seam count for."""
    out = np.zeros(NF, np.int64)
    if text:
        low = np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 65536)
        for k, f in _flags(low, np.zeros(len(low) + 2, bool)).items():
            out[k] = f.sum()
    return out


def _join(a: dict, b: dict) -> dict:
    """Two parts of one line, one after the other."""
    if a["n"] == 0:
        return b
    if b["n"] == 0:
        return a
    seam_a, seam_b = a["last2"], b["first2"]
    return {
        "f": a["f"] + b["f"] + _windows(seam_a + seam_b) - _windows(seam_a) - _windows(seam_b), "n": a["n"] + b["n"],
        "first2": (a["first2"] + b["first2"])[:2], "last2": (a["last2"] + b["last2"])[-2:], "first12": (a["first12"] + b["first12"])[:12],
        "lead": (a["lead"] + b["first12"])[:12] if a["lead"] else b["lead"], "last": b["last"] or a["last"],
    }


def merge(a: dict, b: dict) -> dict:
    """The state of two neighbouring stretches of one text."""
    if not a["open"]:
        return b
    if not b["open"]:
        return a
    out = {"sums": a["sums"] + b["sums"], "lines": a["lines"] + b["lines"], "closed": a["closed"] + b["closed"], "open": []}
    mid = _join(a["open"][-1], b["open"][0])
    if len(a["open"]) == 2 and len(b["open"]) == 2:
        out["closed"].append(mid)
        out["open"] = [a["open"][0], b["open"][1]]
    else:
        out["open"] = [*a["open"][:-1], mid, *b["open"][1:]]
    return out


def settle(states: list[dict]) -> list[dict]:
    """The states with the kinds of closed lines counted, those of all states at once."""
    waiting = [x for s in states for x in s["closed"]]
    if waiting:
        owner = np.repeat(np.arange(len(states)), [len(s["closed"]) for s in states])
        sums, lines = tally(np.stack([x["f"] for x in waiting]), [x["lead"] for x in waiting], [x["last"] for x in waiting], owner, len(states))
        for s, more, counts in zip(states, sums, lines):
            s["sums"], s["lines"], s["closed"] = s["sums"] + more, s["lines"] + counts, []
    return states


def finish(states: list[dict]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sums and line counts of whole texts."""
    done = settle([s | {"closed": s["closed"] + s["open"], "open": []} for s in states])
    return [(s["sums"], s["lines"]) for s in done]


def tally(m: np.ndarray, lead: list[str], last: list[str], row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and line counts of n rows from their lines."""
    kind, bare = classify(m, lead, last)
    full = kind >= 0
    stop = np.fromiter((x in STOPS for x in last), bool, len(last))
    sums, lines = np.zeros((n, NF), np.int64), np.zeros((n, 7), np.int64)
    for k in range(4):
        lines[:, k] = np.bincount(row[kind == k], minlength=n)
    lines[:, 4], lines[:, 5], lines[:, 6] = (np.bincount(row[x], minlength=n) for x in (bare, stop & full, full))
    np.add.at(sums, row, m)
    return sums, lines


class ChunkLines:
    """Lines and parts of lines of a batch of chunks, with their features, all at once."""

    def __init__(self, cb: CharBatch, common: np.ndarray):
        low = cb.low
        self.n = len(cb.rows) - 1
        starts = np.unique(np.concatenate([cb.rows[:-1][np.diff(cb.rows) > 0], np.flatnonzero(low == 10) + 1])).astype(np.int64)
        starts = starts[starts < len(low)]
        bounds = np.append(starts, len(low))
        self.chunk = np.searchsorted(cb.rows, starts, "right") - 1
        self.m = line_matrix(cb, bounds, common)
        broken = low[bounds[1:] - 1] == 10 if len(starts) else np.zeros(0, bool)
        self.start, self.end = starts, bounds[1:] - broken
        #: The last part of a chunk ends with a line break, so an empty part follows it.
        self.closed = broken
        self.text = cb.cps.tobytes().decode("utf-32-le", "replace")
        full = np.flatnonzero(~char_tables()["space"][low])
        if len(full):
            first = full[np.minimum(np.searchsorted(full, self.start), len(full) - 1)]
            final = full[np.maximum(np.searchsorted(full, self.end) - 1, 0)]
            ok = (first >= self.start) & (first < self.end)
            self.lead = [self.text[a : min(a + 12, e)] if y else "" for a, e, y in zip(first.tolist(), self.end.tolist(), ok.tolist())]
            self.last = [self.text[b] if y else "" for b, y in zip(final.tolist(), ok.tolist())]
        else:
            self.lead, self.last = [""] * len(starts), [""] * len(starts)

    def sums(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums and line counts of every chunk over the lines ``which`` (numbers), counted as whole lines."""
        every = len(which) == len(self.lead)
        lead, last = (self.lead, self.last) if every else ([x[i] for i in which.tolist()] for x in (self.lead, self.last))
        return tally(self.m[which], lead, last, self.chunk[which], self.n)

    def part(self, i: int) -> dict:
        a, b = int(self.start[i]), int(self.end[i])
        x = self.text[a : min(b, a + 12)]
        return {"f": self.m[i], "n": b - a, "first2": x[:2], "last2": self.text[max(a, b - 2) : b], "first12": x, "lead": self.lead[i], "last": self.last[i]}


NO_PART = {"f": np.zeros(NF, np.int64), "n": 0, "first2": "", "last2": "", "first12": "", "lead": "", "last": ""}


def _chunks(arr: pa.Array, common: np.ndarray, chunk: int, totals, ends: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, list[dict]]]:
    """Of all chunks of all texts at once: the first chunk of each text (and where the last ends), sums and line counts of whole
    lines, and the open parts of chunks that have neighbours, or of all chunks if the texts have ``ends`` that go on."""
    if not ends and (not len(arr) or pa.compute.max(pa.compute.utf8_length(arr)).as_py() <= chunk):
        lines = ChunkLines(CharBatch(arr), common)
        return np.arange(len(arr) + 1), *lines.sums(np.arange(len(lines.chunk))), {}
    texts = arr.to_pylist()
    cut = [pieces_of(x, chunk) for x in texts]
    size = np.array([len(x) for x in cut])
    owner = np.repeat(np.arange(len(texts)), size)
    several = (size > 1)[owner] | ends
    whole = functools.lru_cache(maxsize=64)(lambda i: totals(texts[i]))
    lines = ChunkLines(CharBatch(to_string_array(pa.array([y for x in cut for y in x], pa.large_string())), totals=lambda i: whole(int(owner[i]))), common)
    chunk_of = lines.chunk
    new = np.append(True, chunk_of[1:] != chunk_of[:-1])[: len(chunk_of)]
    final = np.append(new[1:], True)[: len(chunk_of)]
    edge = (new | final & ~lines.closed) & several[chunk_of]  # a last line that ends with a break is a whole one
    sums, counts = lines.sums(np.flatnonzero(~edge))
    first = np.searchsorted(chunk_of, np.arange(lines.n + 1))
    opened = {}
    for c in np.flatnonzero(several).tolist():
        a, b = int(first[c]), int(first[c + 1])
        if a == b:
            opened[c] = [NO_PART]
            continue
        opened[c] = [lines.part(a), *([NO_PART] if lines.closed[b - 1] else [lines.part(b - 1)] if b - a > 1 else [])]
    return np.concatenate([[0], np.cumsum(size)]), sums, counts, opened


def stretch_state(text: str, common: np.ndarray, chunk: int = CHUNK, totals=script_totals) -> dict:
    """The state of a stretch of a longer text, merged from those of its chunks."""
    _, sums, counts, opened = _chunks(to_string_array(pa.array([text], pa.large_string())), common, chunk, totals, True)
    return settle([functools.reduce(merge, [_state(sums, counts, opened, c) for c in range(len(sums))], empty_state())])[0]


def _state(sums: np.ndarray, counts: np.ndarray, opened: dict, c: int) -> dict:
    return {"sums": sums[c], "lines": counts[c], "closed": [], "open": opened[c]}


def text_counts(arr: pa.Array, common: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Sums and line counts of each text, merged from those of its chunks."""
    at, sums, counts, opened = _chunks(arr, common, chunk, script_totals, False)
    out_sums, out_counts = sums[at[:-1]], counts[at[:-1]]
    several = np.flatnonzero(np.diff(at) > 1).tolist()
    states = [functools.reduce(merge, [_state(sums, counts, opened, c) for c in range(int(at[i]), int(at[i + 1]))]) for i in several]
    for i, (a, b) in zip(several, finish(states)):
        out_sums[i], out_counts[i] = a, b
    return out_sums, out_counts


def verdict(lines: np.ndarray) -> np.ndarray:
    """Kind of each document from its line counts: more than half of the full lines are of one or more bad kinds."""
    lines = np.atleast_2d(lines)
    n = lines[:, 6]
    listed = lines[:, LIST] + np.where(n > 2, lines[:, 4], 0)
    bad = listed + lines[:, TABLE] + lines[:, JUNK]
    best = np.argmax(np.stack([listed, lines[:, TABLE], lines[:, JUNK]], 1), 1)
    return np.where((2 * bad > n) & (n > 0), best, PROSE)


STATS = "words bigint, chars bigint, mean_word_length double, symbol_ratio double, stop_line_share double, common_share double, lines bigint, kind string"


def stats_arrays(sums: np.ndarray, lines: np.ndarray) -> list[pa.Array]:
    sums, lines = np.atleast_2d(sums), np.atleast_2d(lines)
    words, chars, n = sums[:, WORDS], sums[:, CHARS], lines[:, 6]
    div = lambda a, b: a / np.maximum(b, 1)
    return [
        pa.array(words), pa.array(chars), pa.array(div(sums[:, WORDCHARS], words)), pa.array(div(sums[:, SYMBOLS], chars)),
        pa.array(div(lines[:, 5], n)), pa.array(div(sums[:, COMMON], words)), pa.array(n), pa.array([KINDS[k] for k in verdict(lines)]),
    ]


def batch_stats(cb: CharBatch, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and line counts of every row of a batch, each row as one chunk."""
    lines = ChunkLines(cb, common)
    return lines.sums(np.arange(len(lines.chunk)))


def text_quality(df: DataFrame, common: list[tuple[str, str]], id_col: str = "rec_id", text_col: str = "text", chunk: int = CHUNK, span: int = SPAN) -> DataFrame:
    """Statistics and a verdict (list, table, junk or prose) for each text.

    ``common``: (language, word) pairs, a bounded list. Null and empty texts
    have zero counts, ratios 0 and the verdict prose. Rows are kept as they
    are, repeated ones included. Every text is counted by chunks of ``chunk``
    characters; texts longer than ``span`` are dealt out to tasks in spans,
    whose states are merged in a tree. Neither size changes a result.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(df[id_col].alias("k"), df[text_col].alias("t"))
    hashes = common_hashes(common)
    schema = f"k {kind}, {STATS}"
    names = ["k"] + [x.split()[0] for x in STATS.split(", ")]

    def short(batches):
        for batch in batches:
            arr = to_string_array(batch.column(1))
            for a, b in slices(arr):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *stats_arrays(*text_counts(arr.slice(a, b - a), hashes, chunk))], names)

    def deal(batches):
        for batch in batches:
            for k, h, t in zip(batch.column(0), batch.column(1), batch.column(2)):
                text = t.as_py()
                totals = pickle.dumps(script_totals(text))
                for c, x in enumerate(pieces_of(text, span)):
                    yield pa.RecordBatch.from_arrays([pa.array([k.as_py()], batch.schema.field(0).type), pa.array([h.as_py()]), pa.array([c], pa.int32()), pa.array([totals], pa.binary()), pa.array([x], pa.string())], ["k", "h", "c", "g", "x"])

    def part(batches):
        for batch in batches:
            states = []
            for g, x in zip(batch.column(3), batch.column(4)):
                totals = pickle.loads(g.as_py())
                states.append(pickle.dumps(stretch_state(x.as_py(), hashes, chunk, lambda _, totals=totals: totals)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(states, pa.binary())], ["k", "h", "c", "s"])

    def up(level):
        def run(key, pdf):
            import pandas as pd

            out = empty_state()
            for s in pdf.sort_values("c")["s"]:
                out = merge(out, pickle.loads(s))
            copies = int(pdf["copies"].iloc[0])
            if level:
                arrays = stats_arrays(*finish([out])[0])
                return pd.DataFrame({"k": [key[0]] * copies} | {x: a.to_pylist() * copies for x, a in zip(names[1:], arrays)})
            return pd.DataFrame({"k": [key[0]], "h": [key[1]], "c": [key[2]], "s": [pickle.dumps(settle([out])[0])], "copies": [copies]})

        return run

    long = F.coalesce(F.length("t") > span, F.lit(False))
    whole = rows.where(~long).mapInArrow(short, schema)
    dealt = rows.where(long).select("k", F.md5("t").alias("h"), "t").mapInArrow(deal, f"k {kind}, h string, c int, g binary, x string")
    states = dealt.repartition("k", "h", "c").mapInArrow(part, f"k {kind}, h string, c int, s binary")
    states = states.groupBy("k", "h", "c").agg(F.first("s").alias("s"), F.count("*").alias("copies"))  # a repeated row has the same pieces
    first = states.groupBy("k", "h", F.expr("c div 64").alias("g")).applyInPandas(up(0), f"k {kind}, h string, c int, s binary, copies bigint")
    done = first.groupBy("k", "h").applyInPandas(up(1), schema)
    return whole.unionByName(done).withColumnRenamed("k", id_col)
