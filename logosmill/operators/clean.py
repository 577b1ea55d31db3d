"""The cleaning cascade. Every line keeps its first reason to be dropped."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions.text import BLANKS, count, greek_letters, letters, repair_word, strip, strip_edges, unescape_all, when_has

WORDCH = r"[\p{L}\p{N}_]"
#: An address starts and ends at a word boundary in the Unicode sense.
EMAIL = rf"(?:(?<!{WORDCH})(?=[A-Za-z0-9_])|(?<={WORDCH})(?=[.%+-])){X.ADDRESS}(?:(?<=[A-Za-z])(?!{WORDCH})|(?<=\|)(?={WORDCH}))"


def normalise_symbols(c: Column) -> Column:
    return F.translate(c, X.SYMBOLS_FROM, X.SYMBOLS_TO)


def strip_links(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, X.URL, ""), EMAIL, "")


def strip_cues(c: Column) -> Column:
    return F.regexp_replace(c, X.CUE, "")


def strip_marks(c: Column) -> Column:
    """Bracketed spans and sound notes, then the speaker, then a list number at the start."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, X.BRACKETED, ""), X.SPEAKER, ""), X.NUMBERING, "")


def normalise_punctuation(c: Column) -> Column:
    return F.translate(c, ";?«»“”’`", ";;\"\"\"\"''")


def normalise_ellipsis(c: Column) -> Column:
    c = F.regexp_replace(F.replace(c, F.lit("…"), F.lit("...")), r"\.{2,}", "...")
    c = F.regexp_replace(c, r"\.\.\.([^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}.,!?\"';»)])", "... $1")
    return F.regexp_replace(c, rf"{X.W}+\.\.\.", "...")


#: A blank that is no plain space, or several blanks.
UNEVEN = rf"{X.W}{{2,}}|[{X.W[1:-1]}&&[^ ]]"


def tidy_spacing(c: Column) -> Column:
    """No blank before punctuation, no dangling punctuation at the end, runs of blanks as one."""
    c = F.regexp_replace(c, rf"{X.W}+([.,;:!?])", "$1")
    c = F.ltrim(F.rtrim(c, F.lit(",:-–—" + BLANKS)), F.lit(BLANKS))
    return strip(F.regexp_replace(c, UNEVEN, " "))


def any_case(pattern: str) -> str:
    return f"(?iu)(?:{pattern})"


def fold_case(c: Column) -> Column:
    """Lower case, the final sigma as any other: equal under it means equal whatever the case."""
    return F.translate(F.lower(c), "ς", "σ")


def holds(c: Column, alternatives: str) -> Column:
    """Whether a case-folded column holds one of the alternatives: literal ones by plain search, the rest by one pattern."""
    parts = [x.lower().replace("ς", "σ") if re.escape(x).replace("\\ ", " ") == x else x for x in alternatives.split("|")]
    plain = [x for x, y in zip(parts, alternatives.split("|")) if re.escape(y).replace("\\ ", " ") == y]
    rest = [x.replace("ς", "σ") for x, y in zip(parts, alternatives.split("|")) if re.escape(y).replace("\\ ", " ") != y]
    hit = c.rlike("|".join(rest)) if rest else F.lit(False)
    for x in plain:
        hit = c.contains(x) | hit
    return hit


def density_checks(line: Column, ws: Column) -> list[tuple[str, Column]]:
    n = F.size(ws)
    alpha = letters(line)
    return [
        ("word_count", ~n.between(3, 40)),
        ("not_greek", (alpha == 0) | (100 * greek_letters(line) < 85 * alpha)),
        ("capitals", (100 * count(line, r"\p{Lu}") > 25 * alpha) & (n > 3)),
        ("digits", 100 * count(line, X.DIGIT) > 8 * F.length(line)),
        ("numbers", F.size(F.filter(ws, lambda w: w.rlike(rf"\A{X.DIGIT}+\z"))) > 1),
    ]


def _stages() -> list[tuple[str, str, callable]]:
    """(new column, column it comes from, function): each stage is a projection of its own, so nothing is computed twice."""
    return [
        ("_1", "raw", lambda c: when_has(c, ("&",), unescape_all(c))),
        ("_2", "_1", normalise_symbols),
        ("_3", "_2", lambda c: when_has(c, ("http", "www."), F.regexp_replace(c, X.URL, ""))),
        ("_4", "_3", lambda c: when_has(c, ("@",), F.regexp_replace(c, EMAIL, ""))),
        ("_a", "_4", lambda c: when_has(c, ("-->",), strip_cues(c))),
        ("_l", "_a", fold_case),
        ("_5", "_a", lambda c: when_has(c, ("[", "(", "<", "{", "♪", "♫"), F.regexp_replace(c, X.BRACKETED, ""))),
        ("_b", "_5", lambda c: normalise_punctuation(F.regexp_replace(F.regexp_replace(c, X.SPEAKER, ""), X.NUMBERING, ""))),
        ("_6", "_b", lambda c: when_has(c, ("..", "…"), normalise_ellipsis(c))),
        ("_c", "_6", tidy_spacing),
        ("_w0", "_c", lambda c: F.filter(F.split(c, " "), lambda w: w != "")),
    ]


def cascade(df: DataFrame, line_col: str = "line") -> DataFrame:
    """``raw`` (the line as it came), ``clean`` (null if dropped) and ``drop_reason`` (null if kept) beside the other columns.

    Null and empty lines drop as ``empty``. The stages are projections of
    their own, and the result passes through a generator: a later filter on
    it is not pushed down, where it would repeat the whole chain.
    """
    rest = [c for c in df.columns if c != line_col]
    have = [*rest, "raw"]
    rows = df.select(*rest, F.col(line_col).alias("raw"))
    for new, old, f in _stages():
        rows = rows.select(*have, f(F.col(old)).alias(new))
        have.append(new)
    latin = F.col("_c").rlike("[A-Za-z]")  # words without Latin letters need no repair
    rows = rows.select(*have, F.when(latin, F.transform("_w0", repair_word)).otherwise(F.col("_w0")).alias("_w"))
    rows = rows.select(*have, "_w", F.array_join("_w", " ").alias("_d"))
    checks = [
        ("empty", F.col("raw").isNull() | (F.col("raw") == "")),
        ("digits_only", strip(F.col("_a")).rlike(r"\A\p{Nd}+\z")),
        ("credits", holds(F.col("_l"), X.CREDITS)),
        ("boilerplate", holds(F.col("_l"), X.BOILERPLATE)),
        ("almanac", F.col("_a").rlike(any_case(X.ALMANAC))),
        ("navigation", holds(F.col("_l"), X.NAVIGATION)),
        ("calendar", F.col("_b").rlike(any_case(X.CALENDAR))),
        ("empty_after", F.col("_c") == ""),
        ("repeated_char", F.col("_c").rlike(r"([^\n])\1{3,}")),
        ("mixed_script", F.col("_d").rlike("[A-Za-z]") & F.exists("_w", lambda w: strip_edges(w).rlike(X.MIXED))),
        *density_checks(F.col("_d"), F.col("_w")),
    ]
    reason = F.lit(None).cast("string")
    for name, hit in reversed(checks):
        reason = F.when(hit, F.lit(name)).otherwise(reason)
    f = rows.select(*rest, "raw", "_d", reason.alias("_r"))
    out = f.select(*rest, F.explode(F.array(F.struct("raw", F.when(F.col("_r").isNull(), F.col("_d")).alias("clean"), F.col("_r").alias("drop_reason")))).alias("_o"))
    return out.select(*rest, "_o.raw", "_o.clean", "_o.drop_reason")


def cleaned(df: DataFrame, **options) -> DataFrame:
    """The lines that survive the cascade, as ``line``."""
    kept = cascade(df, **options).where("drop_reason is null")
    return kept.drop("raw", "drop_reason").withColumnRenamed("clean", "line")
