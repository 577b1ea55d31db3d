"""Problem 2's text form, and the words that the other problems compare.

``consistent`` brings one text to the consistent form. ``CharBatch`` does the
work for whole Arrow batches: code points go through lookup tables in numpy,
and only rows that hold anything out of the ordinary reach ``consistent``.

Rules of the consistent form
* composed letters in their usual code points (canonical composition);
* presentation variants (full width, ligatures, letter symbols, ...) become
  ordinary characters; superscripts, fractions, the ellipsis and the kinds of
  quotation marks, dashes and apostrophes stay;
* blanks become plain spaces, tabs and line breaks stay;
* characters without width go, a joiner between two emoji stays;
* the script sets (script extensions) of a word's letters are intersected;
  where no script is left the word is a mixed confusable and its look-alikes
  take the script of most of its letters. Rare Latin letters that look like
  ordinary ones (small capitals, script a and g) become them, but for words in
  phonetic script. Words wholly of look-alikes (whole-script confusables) are
  reported, not changed. On a tie the script that can spell the whole word
  wins, then one that can spell more of it, then the script of most of the
  text's letters. So a second pass changes nothing.
"""

from __future__ import annotations

import functools
import re
import unicodedata as ud

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Letters of two scripts that look alike (capital and small).
GREEK_LATIN = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαβεικνορτυχω", "ABEZHIKMNOPTYXaßeikvoptuxw"))
LATIN_GREEK = {
    **dict(zip("ABEZHIKMNOPTYX", "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ")),
    **dict(zip("aßeiıkvoptuyxwɑɩ", "αβειικνορτυυχωαι")),
}
CYRILLIC_GREEK = {
    **dict(zip("АВЕЗНІКМОРТХУГПФЈΥ", "ΑΒΕΖΗΙΚΜΟΡΤΧΥΓΠΦΙΥ")),
    **dict(zip("аеікорухгпфвтμѵ", "αεικορυχγπφβτμν")),
}
GREEK_CYRILLIC = {**dict(zip("ΑΒΕΗΙΚΜΟΡΤΧΥΓΠΦ", "АВЕНІКМОРТХУГПФ")), **dict(zip("αεικοργπφχυ", "аеікоргпфху"))}
CYRILLIC_LATIN = {
    **dict(zip("АВЕЅІЈКМНОРСТУХ", "ABESIJKMHOPCTYX")),
    **dict(zip("аеѕіјкорсухӏ", "aesijkopcyxl")),
}
LATIN_CYRILLIC = {
    **dict(zip("ABESIJKMHOPCTYX", "АВЕЅІЈКМНОРСТУХ")),
    **dict(zip("aesijkopcyx", "аеѕіјкорсух")),
}
G, L, C = 1, 2, 4
SWAP = {(L, G): LATIN_GREEK, (G, L): GREEK_LATIN, (C, G): CYRILLIC_GREEK, (G, C): GREEK_CYRILLIC, (C, L): CYRILLIC_LATIN, (L, C): LATIN_CYRILLIC}
# Letters of further scripts, and rarer ones of Latin and Cyrillic, that look like a Latin letter.
LATIN_TWINS = {
    "Armenian": ("օոսհցզյաՕՏՍԼ", "onuhgqjwOSUL"),
    "Cherokee": ("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏴ", "DRTiAJEWMHYGhZbRWSVSLCPKB"),
    "Coptic": ("ⲟⲣⲥⲞⲢⲤⲎⲒⲔⲘⲚⲦⲨⲬ", "opcOPCHIKMNTYX"),
    "Lisu": ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    "Cyrillic": ("ԁԛԝһѵүԚԜѴԌҮ", "dqwhvyQWVGY"),
    "Latin": ("ɑɡıᴀʙᴄᴅᴇɢʜɪᴊᴋʟᴍɴᴏᴘʀᴛᴜᴠᴡʏᴢ", "agiabcdeghijklmnoprtuvwyz"),
}
TWIN = {a: b for name in LATIN_TWINS for a, b in zip(*LATIN_TWINS[name])}
#: Scripts beside Greek, Latin and Cyrillic whose letters are told apart, a bit each.
OTHERS = ("Armenian", "Cherokee", "Coptic", "Lisu", "Georgian", "Hebrew", "Arabic", "Syriac", "Thaana", "Devanagari", "Bengali", "Tamil", "Telugu", "Thai", "Lao", "Tibetan", "Myanmar", "Ethiopic", "Khmer", "Mongolian", "Han", "Hiragana", "Katakana", "Bopomofo", "Hangul", "Gothic", "Runic", "Ogham", "Glagolitic", "Tifinagh", "Nko", "Vai", "Yi")
BIT = {"Greek": G, "Latin": L, "Cyrillic": C} | {name: 8 << i for i, name in enumerate(OTHERS)}
OWN_TWINS = {BIT[name]: dict(zip(b, a)) for name, (a, b) in LATIN_TWINS.items() if name not in ("Latin", "Cyrillic")}
KEPT_FORMS = ("<super>", "<sub>", "<fraction>", "<noBreak>")


def script_of(ch: str) -> int:
    """1 Greek, 2 Latin, 4 Cyrillic, 0 none of them or no letter."""
    o = ord(ch)
    if not ch.isalpha():
        return 0
    if o < 0x250 or 0x1E00 <= o <= 0x1EFF or o in (0x251, 0x269):
        return 0 if o in (0xAA, 0xBA) else L
    if 0x370 <= o <= 0x3FF or 0x1F00 <= o <= 0x1FFF:
        return G
    return C if 0x400 <= o <= 0x52F else 0


@functools.lru_cache(maxsize=20_000)
def script_set(ch: str) -> int:
    """The scripts that a letter is used in (its script extensions), a bit each; 0 for signs and letters of all scripts."""
    if own := script_of(ch):
        return own
    if not ch.isalpha():
        return 0
    return sum(bit for name, bit in BIT.items() if regex.match(rf"\p{{scx={name}}}", ch))


def resolved(word: str) -> tuple[int, dict[int, int]]:
    """The scripts that all letters of a word share (-1 if it has none that tell), and how many letters each script has."""
    both, n = -1, {}
    for ch in word:
        if sets := script_set(ch):
            both &= sets
            while sets:
                bit = sets & -sets
                n[bit] = n.get(bit, 0) + 1
                sets ^= bit
    return both, n


class _CharMap(dict):
    """Code point -> its replacement before composition, found once each."""

    def __missing__(self, o: int):
        ch = chr(o)
        cat = ud.category(ch)
        new: str | int = o
        if o == 0x200D:
            new = o
        elif cat == "Cf" or o == 0x34F or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF or o in (0x115F, 0x1160, 0x3164, 0xFFA0):
            new = ""
        elif cat == "Zs":
            new = " "
        elif o not in (0x2026, 0x00B4, 0x00A8, 0x0384):
            form = ud.decomposition(ch)
            if form.startswith("<") and not form.startswith(KEPT_FORMS):
                full = ud.normalize("NFKC", ch)
                new = o if full[:1] == " " else full
        self[o] = new
        return new


CHAR_MAP = _CharMap()
#: Words that need no look at the scripts of their letters.
PURE = re.compile("[0-9A-Za-z]+|[0-9\u0370-\u03ff\u1f00-\u1fff]+")
WORD = re.compile(r"[^\W_](?:[^\W_]|[̀-ͯ])*")
MARKS = re.compile("[%s]" % "".join(chr(o) for o in range(0x300, 0x10000) if not 0xD800 <= o < 0xE000 and ud.category(chr(o)) == "Mn"))


def _emoji(ch: str) -> bool:
    return ud.category(ch) in ("So", "Sk") or 0x1F3FB <= ord(ch) <= 0x1F3FF


def _drop_joiners(text: str) -> str:
    keep = []
    for i, ch in enumerate(text):
        if ch == "‍" and not (0 < i < len(text) - 1 and _emoji(text[i - 1]) and _emoji(text[i + 1])):
            continue
        keep.append(ch)
    return "".join(keep)


def _swap(word: str, to: int) -> tuple[str, bool]:
    """The word with look-alikes in script ``to``; whether all letters are of it now."""
    out, whole = [], True
    for ch in ud.normalize("NFD", word):
        sets = script_set(ch)
        if sets and not sets & to:
            new = look_alike(ch, to)
            whole &= new is not None
            ch = new or ch
        out.append(ch)
    return ud.normalize("NFC", "".join(out)), whole


def look_alike(ch: str, to: int) -> str | None:
    """The letter of script ``to`` that looks like ch: by a table of the two scripts, else over the Latin letter that both look like."""
    new = SWAP.get((script_of(ch), to), {}).get(ch)
    if new is None:
        latin = ch if script_of(ch) == L else TWIN.get(ch)
        new = latin if to == L or latin is None else SWAP.get((L, to), OWN_TWINS.get(to, {})).get(latin)
    return new


def _own_twins(word: str) -> str:
    """A Latin word with ordinary letters in place of rare ones that look like them; words in phonetic script, with letters of their own, stay."""
    rare = LATIN_TWINS["Latin"][0]
    if any(ch in rare for ch in word) and all(ch in rare or ord(ch) < 0x250 for ch in ud.normalize("NFD", word) if ch.isalpha()):
        return "".join(TWIN[ch] if ch in rare and ch != "ı" else ch for ch in word)
    return word


def whole_script_confusable(word: str) -> bool:
    """All letters of one script, and all have look-alikes in one other script."""
    sets = {script_of(ch) for ch in ud.normalize("NFD", word)} - {0}
    if len(sets) != 1 or len(word) < 2:
        return False
    own = sets.pop()
    return any(s != own and _swap(word, s)[1] for s in (G, L, C))


def script_totals(text: str) -> dict[int, int]:
    """Letters of each script in a text, presentation variants as the letters they stand for. Totals of parts add up."""
    cps = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    per = tables()["letters"]
    total = np.bincount(np.minimum(cps, 65536), minlength=65537) @ per
    for o, n in zip(*np.unique(cps[cps > 65535], return_counts=True)):
        total += n * _letters_of(int(o))
    return {s: int(x) for s, x in zip((G, L, C), total)}


def _letters_of(o: int) -> np.ndarray:
    new = CHAR_MAP[o]
    sets = [script_of(ch) for ch in ud.normalize("NFC", chr(new) if isinstance(new, int) else new)]
    return np.array([sets.count(s) for s in (G, L, C)], np.int64)


def consistent(text: str, totals=None) -> str:
    """The consistent form of one text. ``totals`` gives the letters of each script in the whole text, of which this may be a part."""
    raw = text
    text = text.translate(CHAR_MAP)
    if "‍" in text:
        text = _drop_joiners(text)
    text = ud.normalize("NFC", text)
    todo = []
    for m in WORD.finditer(text):
        if PURE.fullmatch(m[0]):
            continue
        both, n = resolved(m[0])
        if not both:
            todo.append((m.start(), m.end(), n))
        elif both == L and not m[0].isascii() and _own_twins(m[0]) != m[0]:
            todo.append((m.start(), m.end(), {L: 1}))
    if not todo:
        return text
    total: dict[int, int] | None = None
    parts, at = [], 0
    for a, b, n in todo:
        word, top = text[a:b], max(n.values())
        best = [s for s in n if n[s] == top]
        if len(best) > 1:
            total = total or (totals() if totals else script_totals(raw))
            best.sort(key=lambda s: (not _swap(word, s)[1], _swap(word, s)[0] == word, -total.get(s, 0), s))
        best = best[0]
        new = _swap(word, best)[0]
        parts += [text[at:a], _own_twins(new) if best == L else new]
        at = b
    return ud.normalize("NFC", "".join([*parts, text[at:]]))


def fold_char(ch: str) -> str:
    """Without case, accents and the final-sigma difference."""
    s = "".join(c for c in ud.normalize("NFD", ch.lower()) if ud.category(c) != "Mn")
    return s.replace("ς", "σ")


def words_of(text: str) -> list[str]:
    """The words of a text: plain Python, the measure for CharBatch in tests."""
    text = "".join(map(fold_char, consistent(text)))
    return re.findall(r"[^\W_]+", text)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


mix64 = _mix
BASE = 0x9E3779B97F4A7C15 | 1
PLAIN, WORDCH = 1, 2
_TABLES: dict = {}


def tables() -> dict:
    """Lookup tables over the basic plane: kind, folded letter, script, hash value."""
    if _TABLES:
        return _TABLES
    kind, fold, script = np.zeros(65537, np.uint8), np.zeros(65537, np.uint32), np.zeros(65537, np.uint8)
    for o in range(65536):
        if 0xD800 <= o <= 0xDFFF:
            continue
        ch = chr(o)
        script[o] = script_of(ch)
        if ch.isalnum():
            kind[o] |= WORDCH
        f = fold_char(ch)
        fold[o] = ord(f) if len(f) == 1 and ord(f) < 65536 else (o if ch.isalnum() else 0)
        ok = o in (9, 10, 13) or 32 <= o < 127 or 0x370 <= o < 0x400 or 0x400 <= o < 0x530 or 0xA1 <= o < 0x180 or 0x2010 <= o < 0x2028 or o in (0x20AC, 0x2116, 0xFFFD)
        same = CHAR_MAP[o] in (o, ch) and ud.normalize("NFC", ch) == ch and not ud.combining(ch)
        if ok and same and len(f) <= 1:
            kind[o] |= PLAIN
    fold[(kind & WORDCH) == 0] = 0
    letters = np.zeros((65537, 3), np.int64)
    for o in np.flatnonzero(script[:65536]).tolist():
        letters[o] = (script[o] == G, script[o] == L, script[o] == C)
    for o in range(65536):
        if not 0xD800 <= o <= 0xDFFF and ud.decomposition(chr(o)):
            letters[o] = _letters_of(o)
    value = _mix(np.arange(65537, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(12345)) | np.uint64(1)
    power = np.ones(1, np.uint64)
    _TABLES.update(kind=kind, fold=fold, script=script, letters=letters, value=value, power=power, inverse=power.copy())
    return _TABLES


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n."""
    t = tables()
    if len(t["power"]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            t["power"] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, BASE, np.uint64)]), dtype=np.uint64)
            t["inverse"] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, pow(BASE, -1, 1 << 64), np.uint64)]), dtype=np.uint64)
    return t["power"][:n], t["inverse"][:n]


def word_hash(words) -> np.ndarray:
    """The hash that CharBatch gives to these folded words."""
    t = tables()
    out = []
    for w in words:
        h = 0
        for i, ch in enumerate(w):
            h += int(t["value"][min(ord(ch), 65536)]) * pow(BASE, i, 1 << 64)
        out.append(h & (2**64 - 1))
    return _mix(np.array(out, np.uint64)).view(np.int64)


def to_string_array(col) -> pa.Array:
    """One Arrow array of strings without nulls, offsets from zero."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    return pc.fill_null(col, "")


def slices(arr: pa.Array, most_bytes: int = 2_000_000):
    """(start, stop) of runs of rows with about that many bytes of text each, so memory has a bound."""
    off = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, arr.offset * 8) if len(arr) else np.zeros(1, np.int64)
    at = 0
    while at < len(arr):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most_bytes, "right")) - 1)
        yield at, min(to, len(arr))
        at = min(to, len(arr))


def code_points(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows one after another, and where each row begins (n + 1 offsets)."""
    n = len(arr)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64, n + 1, arr.offset * 8)
    data = np.frombuffer(arr.buffers()[2], np.uint8)[off[0] : off[-1]] if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    cps = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    if len(cps) == len(data):
        return cps, off - off[0]
    starts = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=starts[1:])
    return cps, starts[off - off[0]]


class CharBatch:
    """Rows of text as code points, words and hashes, all in numpy.

    ``dirty``: rows that may differ from their consistent form (never misses one).
    ``totals``: row number -> letters of each script in the text that the row is a part of.
    """

    def __init__(self, arr: pa.Array, resolve: bool = True, totals=None):
        self.text = arr
        self.dirty = np.zeros(len(arr), bool)
        self._load(arr)
        if resolve:
            self.dirty = self.suspicious()
            rows = np.flatnonzero(self.dirty)
            if len(rows):
                fixed = [consistent(x, totals and (lambda i=i: totals(i))) for i, x in zip(rows.tolist(), arr.take(pa.array(rows)).to_pylist())]
                mask = pa.array(self.dirty)
                self.text = pc.replace_with_mask(arr, mask, pa.array(fixed, pa.large_string()))
                bare = [MARKS.sub("", x) for x in fixed]  # marks that nothing composes with part no words
                self._load(self.text if bare == fixed else pc.replace_with_mask(arr, mask, pa.array(bare, pa.large_string())))

    def _load(self, arr: pa.Array) -> None:
        t = tables()
        self.cps, self.rows = code_points(arr)
        self.low = np.minimum(self.cps, 65536)
        self.folded = t["fold"][self.low]
        inside = self.folded != 0
        edge = np.empty(len(inside) + 1, bool)
        edge[0] = edge[-1] = True
        np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
        cut = edge.copy()
        cut[self.rows] = True
        at = np.flatnonzero(cut)
        starts, ends = at[:-1], at[1:]
        keep = inside[starts] if len(inside) else np.zeros(len(starts), bool)
        self.start, self.end = starts[keep], ends[keep]
        self.word_row = np.searchsorted(self.rows, self.start, "right") - 1

    def suspicious(self) -> np.ndarray:
        """Rows with a character out of the plain set, or a word of two scripts."""
        t = tables()
        odd = np.flatnonzero((t["kind"][self.low] & PLAIN) == 0)
        bad = np.zeros(len(self.rows) - 1, bool)
        bad[np.searchsorted(self.rows, odd, "right") - 1] = True
        if len(self.start):
            flags = np.bitwise_or.reduceat(np.append(t["script"][self.low], 0), np.stack([self.start, self.end], 1).ravel())[::2]
            bad[self.word_row[(flags & (flags - 1)) != 0]] = True
        return bad

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each folded word."""
        n = len(self.folded)
        power, inverse = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(tables()["value"][self.folded] * power[:n], dtype=np.uint64, out=total[1:])
            return _mix((total[self.end] - total[self.start]) * inverse[self.start]).view(np.int64)

    def words(self) -> list[str]:
        text = self.folded.astype(np.uint32).tobytes().decode("utf-32-le")
        return [text[a:b] for a, b in zip(self.start.tolist(), self.end.tolist())]


def consistent_all(texts: list[str] | pa.Array) -> list[str]:
    """The consistent forms of many texts; only suspicious ones take the slow way."""
    arr = to_string_array(texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.large_string()))
    out: list[str] = []
    for a, b in slices(arr):
        part = arr.slice(a, b - a)
        todo = CharBatch(part, resolve=False).suspicious()
        rows = part.to_pylist()
        for i in np.flatnonzero(todo).tolist():
            rows[i] = consistent(rows[i])
        out += rows
    return out


def row_offsets(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets (n + 1) of sorted row numbers."""
    return np.searchsorted(rows, np.arange(n + 1))


def distinct_per_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value), sorted by row then value."""
    order = np.lexsort((values, rows))
    r, v = rows[order], values[order]
    keep = np.ones(len(r), bool)
    keep[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return r[keep], v[keep]


def binary_rows(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Numbers of each row as one binary value."""
    data = np.ascontiguousarray(values)
    off = (offsets * data.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(data)])


def unbinary_rows(col: pa.Array, dtype=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """The reverse of binary_rows: all values, and offsets (n + 1)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if not pa.types.is_large_binary(col.type):
        col = col.cast(pa.large_binary())
    size = np.dtype(dtype).itemsize
    if not len(col):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    if col.buffers()[2] is None:
        return np.zeros(0, dtype), off * 0
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]].view(dtype), (off - off[0]) // size
