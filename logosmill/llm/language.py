"""Problem 4: missing or wrong document language labels.

Script ranges leave each word its candidate languages; letter trigrams and
known words score the candidates; Viterbi with a switching penalty labels the
words, and runs of one label are the segments.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import GREEKLISH, PROSE, batch_stats, common_hashes, greeklish, verdict
from .textnorm import C, G, L, CharBatch, fold_char, slices, tables, to_string_array

LANGS = ("el", "en", "fr", "de", "es", "it", "ru")
LATIN = ("el", "en", "fr", "de", "es", "it")
#: Spellings of language codes and names.
ALIASES = {
    "el": "el ell gre gr greek ελληνικα modern_greek grc", "en": "en eng english", "fr": "fr fra fre french francais",
    "de": "de deu ger german deutsch", "es": "es spa spanish espanol castellano", "it": "it ita italian italiano", "ru": "ru rus russian русскии",
}
ALIAS = {a: k for k, v in ALIASES.items() for a in v.split()}
MISSING = {"", "und", "unknown", "none", "null"}
WORDS = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ])*")
#: What is no language: tags and entities, and runs that are addresses or code (signs, digits beside letters, capitals after small letters).
TAGS = re.compile(r"<[^<>\n]*>|&#?\w+;")
NOISY = re.compile(r"[={}\\|%_+/<>\[\]@]|[^\W\d_]\d|\d[^\W\d_]|[a-z][A-Z]|^www\.")
FAR, TRI = -8.0, 1 << 14
#: Trigrams that the no-language share counts for beside those of a language.
LEAN = 1000
#: Count from which on a word is known, and the one that common words have besides, so that every language has some trigrams.
KNOWN, FLOOR = 4, 3
#: Kinds of counts besides the languages of LATIN: words in Latin letters wherever they stand, and Greek words; different ones that a task holds.
SEEN, GREEK, HELD = len(LATIN), len(LATIN) + 1, 300_000
#: A letter that a word in Latin letters may begin with.
LATIN_LETTER = re.compile("[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u036f]")


def label_language(label: str | None) -> str:
    """The language that a label names; '' if missing, 'other' if none of the seven."""
    if label is None:
        return ""
    x = "".join(map(fold_char, label.strip()))
    if x in MISSING:
        return ""
    return ALIAS.get(x) or ALIAS.get(re.split(r"[-_.@ ]", x)[0]) or "other"


def _grams(word: str) -> list[int]:
    w = f"^{word}$"
    return [(ord(w[i]) * 1000003 + ord(w[i + 1]) * 8191 + ord(w[i + 2]) * 31) % TRI for i in range(len(w) - 2)]


class _Fold(dict):
    def __missing__(self, o: int) -> str:
        self[o] = f = fold_char(chr(o))
        return f


FOLD = _Fold()
#: Per spelling: pairs of letters, then single letters, in Latin ones.
SPELLINGS = [
    ([(g, greeklish(g, v)) for g, _ in GREEKLISH if len(g) == 2], {ord(g): greeklish(g, v) for g, _ in GREEKLISH if len(g) == 1}) for v in range(8)
]


def spellings(words: list[str], counts: list[float]) -> Counter:
    """Folded Greek words in Latin letters: each of the eight spellings gets an eighth of the word's count."""
    out: Counter = Counter()
    for pairs, letters in SPELLINGS:
        text = "\n".join(words)
        for g, x in pairs:
            text = text.replace(g, x)
        for w, n in zip(text.translate(letters).split("\n"), counts):
            out[w] += n / 8
    return out


def word_key(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little", signed=True)


def lexicon_of(common: list[tuple[str, str]]) -> dict[str, set]:
    """The languages of each common word in Latin letters."""
    lexicon: dict[str, set] = defaultdict(set)
    for lang, w in common:
        f = "".join(map(fold_char, w or ""))
        if lang == "el":
            for v in range(8):
                lexicon[greeklish(f, v)].add("el")
        elif lang in LATIN:
            lexicon[f].add(lang)
    return dict(lexicon)


def floor(lexicon: dict[str, set]) -> list[tuple[str, str]]:
    return [(k, w) for k in LATIN for w, ls in lexicon.items() if k in ls]


def told(words: list[str], lexicon: dict[str, set]) -> str | None:
    """The language that the common words tell beyond doubt, of the words in Latin letters of one text."""
    votes: Counter = Counter()
    for w in words if len(words) >= 3 else ():
        ls = lexicon.get(w.translate(FOLD), ())
        for k in ls:
            votes[k] += 1 / len(ls)
    top = votes.most_common(2)
    return top[0][0] if top and top[0][1] >= 3 and (len(top) == 1 or top[0][1] >= 1.5 * top[1][1]) else None


def tally(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words and their counts in each language of LATIN: sums of trigrams, characters, and sums of these. A word counts 50 times at most, so that endings and stems outweigh a few frequent words."""
    size = np.minimum(counts, 50.0)
    text = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le"), np.uint32).astype(np.int64)
    own = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    within = own[2:] == own[:-2]
    grams = ((text[:-2] * 1000003 + text[1:-1] * 8191 + text[2:] * 31) % TRI)[within]
    of = own[2:][within]
    codes, at = np.unique(text, return_inverse=True)
    table, letters = (np.stack([np.bincount(x, size[o, j], n) for j in range(len(LATIN))], 1) for x, o, n in ((grams, of, TRI), (at, own, len(codes))))
    return table, codes, letters


class LanguageModel:
    """Scores of Latin-script words: trigram likelihoods and known words.

    Fitted on texts whose language the common words tell beyond doubt, and on
    Greek texts put into Latin letters by rule (several spellings).
    """

    def __init__(self, common: list[tuple[str, str]], latin_texts: list[str], greek_texts: list[str]):
        lexicon = lexicon_of(common)
        by: dict[str, Counter] = {k: Counter() for k in LATIN}
        for t in latin_texts:
            ws = [w for w in WORDS.findall(t) if w[0] < "Ͱ"]
            if (k := told(ws, lexicon)) is not None:
                by[k].update(w.lower() for w in ws)
        greek = Counter(self.fold(w) for t in greek_texts for w in WORDS.findall(t) if "Ͱ" <= w[0] < "Ѐ")
        by["el"].update(spellings(list(greek), list(greek.values())))
        for k, w in floor(lexicon):
            by[k][w] += FLOOR
        words = sorted({w for c in by.values() for w in c})
        counts = np.array([[by[k][w] for k in LATIN] for w in words], float).reshape(-1, len(LATIN))
        known = np.flatnonzero(counts.max(1, initial=0) >= KNOWN)
        self._fit(lexicon, *tally(words, counts), counts.sum(0), np.array([word_key(words[i]) for i in known], np.int64), counts[known])

    @classmethod
    def of_sums(cls, common: list[tuple[str, str]], *sums: np.ndarray) -> LanguageModel:
        """The model of sums taken elsewhere: trigrams, characters and sums of these, words, keys of known words and their counts."""
        model = cls.__new__(cls)
        model._fit(lexicon_of(common), *sums)
        return model

    def _fit(self, lexicon, table, codes, letters, total, keys, counts) -> None:
        self.lexicon = lexicon
        self.odds = self._odds(table, Counter(dict(zip(map(chr, codes.tolist()), letters.sum(1).tolist()))))
        self.table = np.log((table + 0.2) / (table + 0.2).sum(0)).astype(np.float32)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.known = np.log((counts[order] + 0.3) / (total + 3000)).astype(np.float32)
        self.cache: dict[str, np.ndarray] = {}

    @staticmethod
    def _odds(counts: np.ndarray, letters: Counter) -> np.ndarray:
        """Log of each trigram's share in each language over that in no language: the same letters in any order. Where a
        language has few texts, its shares lean towards the latter."""
        common = sorted(letters, key=lambda c: (-letters[c], c))[:80]
        code = np.array([ord(c) for c in common], np.int64)
        p = np.array([letters[c] for c in common], float)
        p /= p.sum()
        at = (code[:, None, None] * 1000003 + code[:, None] * 8191 + code * 31) % TRI
        none = np.bincount(at.ravel(), (p[:, None, None] * p[:, None] * p).ravel(), minlength=TRI) + 1e-9
        return np.log((counts + LEAN * none[:, None]) / (counts.sum(0) + LEAN) / none[:, None]).astype(np.float32)

    @staticmethod
    def fold(word: str) -> str:
        return word.translate(FOLD)

    def score(self, word: str) -> np.ndarray:
        """Log scores over LANGS, the best is 0."""
        out = np.full(len(LANGS), FAR, np.float32)
        o = ord(word[0])
        if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
            out[0] = 0
            return out
        if 0x400 <= o < 0x530:
            out[6] = 0
            return out
        if not (o < 0x250 or 0x1E00 <= o < 0x1F00):
            out[:] = 0
            return out
        w = word.lower()
        s = self.table[_grams(w)].sum(0) * 0.6
        i = int(np.searchsorted(self.keys, key := word_key(w)))
        if i < len(self.keys) and self.keys[i] == key:
            s = s * 0.3 + self.known[i]
        if (ls := self.lexicon.get(self.fold(w))) is not None:
            s = s + np.array([2.0 if x in ls else 0.0 for x in LATIN], np.float32)
        s = np.maximum(s - s.max(), FAR + 1)
        out[:6] = s
        return out

    @staticmethod
    def words(text: str) -> list[str]:
        """The words that are judged: noise is left out."""
        return WORDS.findall(" ".join([x for x in TAGS.sub(" ", text).split() if not NOISY.search(x)]))

    def speaks(self, words: list[str], lang: str, penalty: float = 6.0) -> bool:
        """Whether a run of words is language: its trigrams are likelier in it than in no language, by the switching penalty; Greek and Cyrillic letters show it anyway."""
        if lang == "ru" or lang == "el" and sum("\u0370" <= w[0] < "\u0400" or "\u1f00" <= w[0] < "\u2000" for w in words) >= len(words) / 2:
            return True
        return float(sum(self.odds[_grams(w.lower()), LATIN.index(lang)].sum() for w in words)) > penalty

    def segments(self, text: str, penalty: float = 6.0) -> list[tuple[int, int, str, float]]:
        """(first word, words, language, confidence) of each segment of one text."""
        return self.label(self.words(text), penalty)

    def label(self, words: list[str], penalty: float = 6.0) -> list[tuple[int, int, str, float]]:
        """The segments of a run of words."""
        if not words:
            return []
        if len(self.cache) > 200_000:
            self.cache.clear()
        for w in words:
            if w not in self.cache:
                self.cache[w] = self.score(w)
        scores = np.stack([self.cache[w] for w in words])
        n, k = scores.shape
        best, back = scores[0].copy(), np.zeros((n, k), np.int8)
        for i in range(1, n):
            j = int(best.argmax())
            stay = best >= best[j] - penalty
            back[i] = np.where(stay, np.arange(k), j)
            best = np.where(stay, best, best[j] - penalty) + scores[i]
        path = np.empty(n, np.int8)
        path[-1] = best.argmax()
        for i in range(n - 1, 0, -1):
            path[i - 1] = back[i, path[i]]
        cuts = np.flatnonzero(np.diff(path)) + 1
        out = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), n]):
            total = scores[a:b].sum(0)
            e = np.exp(np.minimum(total - total[path[a]], 30.0) / max(1.0, math.sqrt(b - a)))
            out.append((a, b - a, LANGS[path[a]], float(1 / e.sum())))
        return out


def _count_words(lexicon: dict[str, set]):
    """Batches of texts to counts of words: (kind, word, n), each kind a place in LATIN, SEEN or GREEK."""

    def run(batches):
        tokens, own = Counter(), Counter()

        def flush():
            n = Counter(own)
            for x, c in tokens.items():  # no word goes over a blank
                for w in WORDS.findall(x):
                    if w[0] < "Ͱ":
                        n[SEEN, w.lower()] += c
                    elif w[0] < "Ѐ":
                        n[GREEK, w.translate(FOLD)] += c
            tokens.clear()
            own.clear()
            kinds, words = zip(*n) if n else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(words, pa.string()), pa.array(n.values(), pa.int64())], ["kind", "word", "n"])

        for batch in batches:
            arr = to_string_array(batch.column(0))
            for a, b in slices(arr):
                texts = arr.slice(a, b - a).to_pylist()
                tokens.update("\n".join(texts).split())
                for t in texts:
                    if LATIN_LETTER.search(t):
                        ws = [w for w in WORDS.findall(t) if w[0] < "Ͱ"]
                        if (k := told(ws, lexicon)) is not None:
                            j = LATIN.index(k)
                            own.update((j, w.lower()) for w in ws)
                if len(tokens) + len(own) > HELD:
                    yield flush()
        yield flush()

    return run


def _spell(batches):
    """Greek words to their spellings in Latin letters; other counts as they are."""
    for batch in batches:
        kind = np.asarray(batch.column(0))
        rest = pa.array(kind != GREEK)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(rest), batch.column(1).filter(rest), batch.column(2).filter(rest).cast(pa.float64())], ["kind", "word", "n"])
        greek = batch.filter(pa.array(kind == GREEK))
        n = spellings(greek.column(1).to_pylist(), greek.column(2).to_pylist()) if len(greek) else {}
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), LATIN.index("el"), np.int32)), pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.float64())], ["kind", "word", "n"])


def _sums(batches):
    """Words with their counts to sums (what, key, n of each language): trigrams, characters, all words, known words."""
    names = ["what", "key", *LATIN]

    def rows(what, keys, n):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), what, np.int8)), pa.array(keys, pa.int64()), *(pa.array(n[:, j], pa.float64()) for j in range(len(LATIN)))], names)

    table, total, letters = np.zeros((TRI, len(LATIN))), np.zeros(len(LATIN)), defaultdict(lambda: np.zeros(len(LATIN)))
    for batch in batches:
        words, counts = batch.column(0).to_pylist(), np.stack([np.asarray(batch.column(1 + j)) for j in range(len(LATIN) + 1)], 1)
        counts, seen = counts[:, :SEEN], counts[:, SEEN] > 0
        more, codes, n = tally(words, counts)
        table += more
        total += counts.sum(0)
        for c, x in zip(codes.tolist(), n):
            letters[c] += x
        known = np.flatnonzero((counts.max(1, initial=0) >= KNOWN) & seen)
        yield rows(3, [word_key(words[i]) for i in known], counts[known])
    used = np.flatnonzero(table.any(1))
    yield rows(0, used, table[used])
    yield rows(1, list(letters), np.array(list(letters.values())).reshape(-1, len(LATIN)))
    yield rows(2, [0], total[None])


def fit_language_model(df: DataFrame, common: list[tuple[str, str]], text_col: str = "text") -> LanguageModel:
    """Fit on every text, copies once. Words are counted, spelled and summed on the executors; what comes to the driver is the table of
    trigrams and the known words, of these only such as stand in Latin letters somewhere in the texts (no other word is looked up there)."""
    spark, lexicon = df.sparkSession, lexicon_of(common)
    texts = df.select(df[text_col].alias("t")).where("t <> ''").distinct()
    counts = texts.mapInArrow(_count_words(lexicon), "kind int, word string, n bigint").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    forms = counts.mapInArrow(_spell, "kind int, word string, n double")
    if extra := [(LATIN.index(k), w, float(FLOOR)) for k, w in floor(lexicon)]:
        forms = forms.unionByName(spark.createDataFrame(extra, "kind int, word string, n double"))
    words = forms.groupBy("word").agg(*[F.sum(F.when(F.col("kind") == j, F.col("n")).otherwise(0.0)).alias(f"n{j}") for j in range(len(LATIN) + 1)])
    schema = ", ".join(["what tinyint", "key bigint", *(f"`{k}` double" for k in LATIN)])
    got = words.mapInArrow(_sums, schema).groupBy("what", "key").agg(*[F.sum(k).cast("float").alias(k) for k in LATIN]).toArrow()
    what, key, n = np.asarray(got["what"]), np.asarray(got["key"]), np.stack([np.asarray(got[k]) for k in LATIN], 1).astype(float)
    table = np.zeros((TRI, len(LATIN)))
    table[key[what == 0]] = n[what == 0]
    return LanguageModel.of_sums(common, table, key[what == 1], n[what == 1], n[what == 2].sum(0), key[what == 3], n[what == 3])


def label_languages(df: DataFrame, model: LanguageModel, common: list[tuple[str, str]], id_col: str = "rec_id", text_col: str = "text", lang_col: str = "lang", passage: int = 6, output: str = "segments") -> DataFrame:
    """Languages of each text.

    ``segments``: (id, segment, first_word, words, lang, confidence, is_passage)
    of texts with words. ``documents``: (id, lang, confidence, label, label_ok).
    ``found``: (id, lang) for texts that are prose, where the label is missing
    or wrong or a passage of at least ``passage`` words is in a second
    language; one row per language. Null and empty texts, and texts without
    letters, give no rows. Repeated rows give repeated rows.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(df[id_col].alias("k"), df[text_col].alias("t"), df[lang_col].alias("l"))
    hashes = common_hashes(common)
    schemas = {
        "segments": "k {0}, segment int, first_word int, words int, lang string, confidence double, is_passage boolean",
        "documents": "k {0}, lang string, confidence double, label string, label_ok boolean",
        "found": "k {0}, lang string",
    }

    def run(batches):
        for batch in batches:
            arr = to_string_array(batch.column(1))
            labels = batch.column(2).to_pylist()
            for a, b in slices(arr):
                cb = CharBatch(arr.slice(a, b - a))
                n = b - a
                bits = np.zeros(n, np.int64)
                script = tables()["script"][cb.low]
                letters = np.zeros(n, np.int64)
                for s in (G, L, C):
                    hit = np.concatenate([[0], np.cumsum(script == s)])
                    num = hit[cb.rows[1:]] - hit[cb.rows[:-1]]
                    bits |= np.where(num > 0, s, 0)
                    letters += num
                ids = batch.column(0).slice(a, n)
                named = [label_language(x) for x in labels[a:b]]
                out: list[tuple] = []
                where = np.flatnonzero(letters > 0)
                if output == "found":  # Greek letters alone under a Greek label need no look; of the others only prose is judged
                    where = where[(bits[where] != G) | (np.array(named, object)[where] != "el")]
                    where = where[verdict(batch_stats(CharBatch(arr.slice(a, n).take(pa.array(where))), hashes)[1]) == PROSE]
                texts = cb.text.take(pa.array(where)).to_pylist()
                for i, t in zip(where.tolist(), texts):
                    ws = model.words(t) if output == "segments" or bits[i] not in (G, C) else []
                    if output != "segments" and bits[i] in (G, C):
                        segs = [(0, passage, "el" if bits[i] == G else "ru", 1.0)]
                    elif output == "segments" and bits[i] in (G, C):
                        segs = [(0, len(ws), "el" if bits[i] == G else "ru", 1.0)] if ws else []
                    else:
                        segs = model.label(ws)
                    if not segs:
                        continue
                    if output == "segments":
                        out += [(i, j, s[0], s[1], s[2], s[3], s[1] >= passage) for j, s in enumerate(segs)]
                        continue
                    size: Counter = Counter()
                    for s in segs:
                        size[s[2]] += s[1]
                    main = size.most_common(1)[0][0]
                    if output == "documents":
                        conf = sum(s[1] * s[3] for s in segs if s[2] == main) / sum(size.values())
                        out.append((i, main, conf, labels[a + i], named[i] == main))
                        continue
                    present = {main} | {s[2] for s in segs if s[1] >= passage and (bits[i] in (G, C) or model.speaks(ws[s[0] : s[0] + s[1]], s[2]))}
                    if named[i] != main or len(present) > 1:
                        out += [(i, x) for x in sorted(present)]
                if not out:
                    continue
                cols = list(zip(*out))
                names = [x.split()[0] for x in schemas[output].split(", ")]
                types = {"segment": pa.int32(), "first_word": pa.int32(), "words": pa.int32(), "confidence": pa.float64(), "lang": pa.string(), "label": pa.string(), "is_passage": pa.bool_(), "label_ok": pa.bool_()}
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(cols[0])), *(pa.array(c, types[x]) for c, x in zip(cols[1:], names[1:]))], names)

    return rows.mapInArrow(run, schemas[output].format(kind)).withColumnRenamed("k", id_col)
