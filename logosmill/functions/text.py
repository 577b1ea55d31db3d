"""Text functions as columns. All run inside the JVM."""

from __future__ import annotations

import html
import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as X


#: The characters of the class X.W.
BLANKS = "".join(chr(o) for o in range(0x3001) if re.match(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: chr(int(m[1], 16)), X.W), chr(o)))


def strip(c: Column) -> Column:
    """Without blanks at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def words(c: Column) -> Column:
    """The runs between blanks, none of them empty."""
    return F.filter(F.split(c, f"{X.W}+"), lambda w: w != "")


def strip_edges(c: Column) -> Column:
    """Without the edge punctuation of words."""
    return F.btrim(c, F.lit(X.EDGE))


def unescape(c: Column) -> Column:
    """The usual HTML entities (X.ENTITIES), one pass each, the ampersand last."""
    for entity, char in X.ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


#: An entity as HTML 5 reads it: a number, or a name of up to 32 characters.
ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Names that end with a semicolon, and those that count without one; the table is that of Python's library.
NAMED = {k: v for k, v in html5.items() if k.endswith(";")}
SHORT = {k: v for k, v in html5.items() if not k.endswith(";")}
SHORT_NAME = "^(" + "|".join(sorted(SHORT, key=lambda k: (-len(k), k))) + ")"
#: Numbers that stand for another character (those of an old code page) or for none.
RENUMBERED = {n: html.unescape(f"&#{n};") for n in (*range(0xA0), 0xD800, 0x110000) if html.unescape(f"&#{n};") != (chr(n) if n < 0x110000 else "")}


def _numbered(n: Column) -> Column:
    """The character of an entity's number."""
    void = (n.between(0xFDD0, 0xFDEF)) | (n % 65536 >= 65534)
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    out = F.when(n.isNull() | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), "\ufffd").when(void, "").otherwise(char)
    moved = F.from_json(F.lit(json.dumps({str(k): v for k, v in RENUMBERED.items() if k < 0xA0})), "map<string,string>")
    return F.coalesce(F.try_element_at(moved, n.cast("string")), out)


def _entity(e: Column) -> Column:
    s = F.substring(e, F.lit(2), F.length(e) - 1)
    hexed, digits = F.regexp_extract(s, "^#[xX]0*([0-9a-fA-F]*)", 1), F.regexp_extract(s, "^#0*([0-9]*)", 1)
    number = F.when(s.rlike("^#[xX]"), F.when(F.length(hexed) <= 8, F.conv(F.concat(F.lit("0"), hexed), 16, 10).cast("bigint"))).otherwise(F.when(F.length(digits) <= 9, F.concat(F.lit("0"), digits).cast("bigint")))
    table = lambda d: F.from_json(F.lit(json.dumps(d)), "map<string,string>")
    name = F.regexp_extract(s, SHORT_NAME, 1)
    short = F.when(name != "", F.concat(F.try_element_at(table(SHORT), name), F.substring(s, F.length(name) + 1, F.length(s))))
    return F.when(s.startswith("#"), _numbered(number)).otherwise(F.coalesce(F.try_element_at(table(NAMED), s), short, e))


def unescape_all(c: Column) -> Column:
    """Every entity of HTML 5, each once, as one reads a page; within the JVM."""
    found, between = F.regexp_extract_all(c, F.lit(ENTITY), F.lit(0)), F.split(c, ENTITY, -1)
    return F.array_join(F.zip_with(between, F.transform(found, _entity), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def strip_accents(c: Column) -> Column:
    return F.translate(c, X.ACCENTED, X.PLAIN)


def has_stress(c: Column) -> Column:
    """At least one letter with a stress mark (a bare dieresis is none)."""
    return c.rlike(f"[{X.STRESSED}]")


def has_accents(c: Column) -> Column:
    """At least one letter that strip_accents would change."""
    return c.rlike(f"[{X.ACCENTED}]")


def syllables(c: Column) -> Column:
    """Vowel groups; a pair counts once unless its second vowel bears the mark; words of X.MONOSYLLABLES have one."""
    low = F.lower(c)
    return F.when(low.isin(X.MONOSYLLABLES), 1).otherwise(count(F.regexp_replace(low, X.DIGRAPHS, "α"), f"[{X.VOWELS}]"))


def count(c: Column, char_class: str) -> Column:
    """How many characters are of a class: what goes when its runs are removed (one match a run, not a character)."""
    return (F.length(c) - F.length(F.regexp_replace(c, f"{char_class}+", ""))).cast("int")


def when_has(c: Column, needles: tuple[str, ...], then: Column) -> Column:
    """``then`` where one of the needles stands in c, else c: plain search is far cheaper than a pattern. c should be a plain column."""
    hit = F.lit(False)
    for n in needles:
        hit = hit | c.contains(n)
    return F.when(hit, then).otherwise(c)


def greek_letters(c: Column) -> Column:
    """Letters of the Greek blocks."""
    return count(c, r"[\x{370}-\x{3ff}\x{1f00}-\x{1fff}&&[\p{L}]]")


def letters(c: Column) -> Column:
    return count(c, r"\p{L}")


def greek_ratio(c: Column) -> Column:
    """Share of letters that are Greek; 0 without letters."""
    n = letters(c)
    return F.when(n > 0, greek_letters(c) / n).otherwise(F.lit(0.0))


def space_punctuation(c: Column) -> Column:
    """A space on both sides of punctuation, runs of blanks as one."""
    c = F.regexp_replace(c, r'([.,!?;:"«»()\[\]{}])', " $1 ")
    return strip(F.regexp_replace(c, f"{X.W}+", " "))


def repair_word(w: Column) -> Column:
    """Latin look-alikes replaced in words with a Greek character."""
    fixed = F.replace(F.replace(w, F.lit("pi"), F.lit("π")), F.lit("Pi"), F.lit("Π"))
    return F.when(strip_edges(w).rlike(X.GREEK), F.translate(fixed, X.LATIN, X.GREEK_LOOK)).otherwise(w)


def prompt(context: Column, bad: Column, good: Column) -> Column:
    """``context <bad-mark>bad<good-mark>good<end-mark>``; no blank before it without context."""
    return F.concat_ws(" ", F.nullif(strip(F.coalesce(context, F.lit(""))), F.lit("")), F.concat(F.lit(X.BAD), bad, F.lit(X.GOOD), good, F.lit(X.END)))


def draw(key: Column, salt: str) -> Column:
    """A number in [0, 2^32) from the key: reproducible, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit("|" + salt))), 1, 8), 16, 10).cast("bigint")


def perplexity(loss: Column) -> Column:
    return F.exp(F.least(loss, F.lit(20.0)))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def softmax(c: Column) -> Column:
    """Of an array, the greatest value subtracted first."""
    total = lambda e: F.aggregate(e, F.lit(0.0), lambda a, b: a + b)
    powers = lambda t: F.transform(c, lambda x: F.exp(x.cast("double") - t))
    return let(F.array_max(c).cast("double"), lambda t: let(powers(t), lambda e: let(total(e), lambda s: F.transform(e, lambda x: x / s))))
