"""Synthetic typing errors.

A random choice is a draw from the hash of the row's key and a salt, so it is
reproducible and the same in any engine. The steps are one SQL text over a
relation with ``id`` (string) and ``sentence``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions.dialect import Spark
from ..functions.text import strip_accents
from .ranking import first_rows

KEYS = "".join(X.ADJACENT)
HALF, FOUR_FIFTHS, NINE_TENTHS = 2147483648, 3435973837, 3865470567
EDGE_SQL = X.EDGE.replace("'", "''")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _base(c: str) -> str:
    return f"lower(translate({c}, '{X.ACCENTED}', '{X.PLAIN}'))"


def stage_sql(d, source: str) -> str:
    """The text of the whole corruption of sentences: one target word each, a draw of the kind of error, and the parts of the prompt."""
    W, wordch = X.W, r"\p{L}\p{N}_"
    homo = d.array([_q(f"{a}>{b}") for a, b in X.HOMOPHONES])
    near = d.array([_q(v) for v in X.ADJACENT.values()])
    s0 = f"select id, {d.words('sentence', W)} as ws from {source}"
    s1 = f"select id, ws, {d.filter(d.seq('1', d.size('ws')), 'i', f'length({d.edges(d.at('ws', 'i'), EDGE_SQL)}) >= 3')} as good from ({s0}) a where {d.size('ws')} >= 2"
    s2 = f"select id, ws, cast(case when {d.size('good')} > 0 then {d.at('good', f'{d.draw('id', 'word')} % greatest({d.size('good')}, 1) + 1')} else {d.draw('id', 'word')} % {d.size('ws')} + 1 end as int) as t from ({s1}) b"
    s3 = f"select id, ws, t, {d.at('ws', 't')} as raw from ({s2}) c"
    shape = f"^([^{wordch}]*)([{wordch}]+)([^{wordch}]*)$"
    s4 = (
        f"select id, ws, t, case when {d.matches('raw', shape)} then {d.group('raw', shape, 1)} else '' end as pre, "
        f"case when {d.matches('raw', shape)} then {d.group('raw', shape, 2)} else raw end as target, "
        f"case when {d.matches('raw', shape)} then {d.group('raw', shape, 3)} else '' end as suf from ({s3}) e"
    )
    s5 = f"select id, ws, t, pre, target, suf, {d.edges('target', EDGE_SQL)} as w from ({s4}) f"
    s5 = d.pinned(s5, "id, ws, t, pre, target, suf, w")
    able = d.filter(d.seq("1", "length(w)"), "i", f"instr('{KEYS}', {_base('substr(w, cast(i as int), 1)')}) > 0")
    homs = d.filter(homo, "p", f"instr(lower(w), substr(p, 1, instr(p, '>') - 1)) > 0")
    s6 = (
        f"select *, {d.draw('id', 'dice')} as dice, {able} as able, {homs} as homs, {d.draw('id', 'kind')} % 4 as kind, length(w) as n "
        f"from ({s5}) g where length(w) >= 2"
    )
    s7 = (
        f"select *, case when {d.size('able')} > 0 then cast({d.at('able', f'{d.draw('id', 'place')} % greatest({d.size('able')}, 1) + 1')} as int) end as ai, "
        f"case when {d.size('homs')} > 0 then {d.at('homs', f'{d.draw('id', 'pair')} % greatest({d.size('homs')}, 1) + 1')} end as hp, "
        f"cast(case kind when 0 then {d.draw('id', 'at')} % (n - 1) when 2 then {d.draw('id', 'at')} % (n + 1) else {d.draw('id', 'at')} % n end as int) as k from ({s6}) h"
    )
    s7 = d.pinned(s7, "id, ws, t, pre, target, suf, w, dice, kind, n, ai, hp, k")
    plain_or_alpha = f"case when instr('{X.ACCENTED}', substr(w, least(k, n - 1) + 1, 1)) > 0 then {_base('substr(w, least(k, n - 1) + 1, 1)')} else 'α' end"
    s8 = (
        f"select *, substr(w, ai, 1) as ac, {d.at(near, f'''instr('{KEYS}', {_base('substr(w, ai, 1)')})''')} as an, "
        f"substr(hp, 1, instr(hp, '>') - 1) as hs, substr(hp, instr(hp, '>') + 1) as hd, {d.at(near, f'''instr('{KEYS}', {plain_or_alpha})''')} as kn from ({s7}) i"
    )
    s9 = (
        f"select *, instr(lower(w), hs) as hi, substr(an, cast({d.draw('id', 'key')} % length(an) + 1 as int), 1) as ak, "
        f"substr(kn, cast({d.draw('id', 'inserted')} % length(kn) + 1 as int), 1) as kk from ({s8}) j"
    )
    s9 = d.pinned(s9, "id, ws, t, pre, target, suf, w, dice, kind, n, ai, hp, k, ac, hs, hd, hi, ak, kk")
    s10 = (
        f"select *, nullif(translate(w, '{X.ACCENTED}', '{X.PLAIN}'), w) as g1, "
        f"case when ai is not null then concat(substr(w, 1, ai - 1), case when ac <> lower(ac) then upper(ak) else ak end, substr(w, ai + 1)) end as g2, "
        f"case when hp is not null then nullif(concat(substr(w, 1, hi - 1), case when substr(w, hi, 1) <> lower(substr(w, hi, 1)) then concat(upper(substr(hd, 1, 1)), substr(hd, 2)) else hd end, substr(w, hi + length(hs))), w) end as g3, "
        f"case kind when 0 then concat(substr(w, 1, k), substr(w, k + 2, 1), substr(w, k + 1, 1), substr(w, k + 3)) "
        f"when 1 then case when n >= 3 then concat(substr(w, 1, k), substr(w, k + 2)) end "
        f"when 2 then concat(substr(w, 1, k), kk, substr(w, k + 1)) else concat(substr(w, 1, k + 1), substr(w, k + 1)) end as g4 from ({s9}) k"
    )
    label = (
        f"case when dice < {HALF} and g1 is not null then 'accent_strip' when dice < {FOUR_FIFTHS} and g2 is not null then 'adjacency' "
        f"when dice < {NINE_TENTHS} and g3 is not null then 'homophone' when g4 is not null then 'dynamics' when g1 is not null then 'accent_strip' "
        f"when g2 is not null then 'adjacency' else 'none' end"
    )
    s10 = d.pinned(s10, "id, ws, t, pre, target, suf, dice, g1, g2, g3, g4")
    s11 = f"select *, {label} as error_type from ({s10}) l"
    s12 = f"select *, case error_type when 'accent_strip' then g1 when 'adjacency' then g2 when 'homophone' then g3 when 'dynamics' then g4 end as bad from ({s11}) m"
    columns = "id, ws, t, pre, target, suf, error_type, bad"
    s12 = d.pinned(s12, columns)
    before = d.join(d.slice("ws", "1", "(t - 1)"))
    s13 = f"select *, case when t = 1 then '' else {before} end as ctx0 from ({s12}) o where bad is not null and bad <> target"
    s14 = f"select *, case when pre <> '' then {d.strip('''concat(ctx0, ' ', pre)''', W)} else ctx0 end as context from ({s13}) q"
    return (
        f"select id, context, concat(bad, suf) as corrupted_word, concat(target, suf) as target_word, error_type, "
        f"concat(case when {d.strip('context', W)} <> '' then concat({d.strip('context', W)}, ' ') else '' end, '{X.BAD}', bad, suf, '{X.GOOD}', target, suf, '{X.END}') as full_sequence from ({s14}) r"
    )


def correction_samples(df: DataFrame, id_col: str, line_col: str = "line") -> DataFrame:
    """One correction sample for each sentence that allows one: id, context, corrupted_word, target_word, error_type, full_sequence."""
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(line_col).alias("sentence"))
    view = f"sentences_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    return df.sparkSession.sql(stage_sql(Spark, view))


def evaluation_set(samples: DataFrame, n: int = 1000, seed: int = 1337) -> DataFrame:
    """n samples in a random but reproducible order, each (context, corrupted, target) once."""
    key = F.md5(F.concat(F.lit(f"{seed}|"), "id"))
    w = Window.partitionBy("context", "corrupted_word", "target_word").orderBy("_k", "id")
    rows = samples.withColumn("_k", key).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return first_rows(rows, ["_k", "id"], n).drop("_k")


def accent_pairs(words: DataFrame) -> DataFrame:
    """(word, stripped) of distinct words that lose an accent."""
    return words.select("word").distinct().select("word", strip_accents(F.col("word")).alias("stripped")).where("word <> stripped")


def adjacency_candidates(words: DataFrame) -> DataFrame:
    """Every (word, place, corrupted) by one neighbouring key; the table of neighbours is fixed."""
    spark = words.sparkSession
    edges = F.broadcast(spark.createDataFrame([(k, v) for k, vs in X.ADJACENT.items() for v in vs], "base string, near string"))
    w = words.select("word").distinct().select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("place"))
    ch = F.expr("substring(word, place, 1)")
    w = w.select("word", "place", ch.alias("ch"), F.lower(strip_accents(ch)).alias("base")).join(edges, "base")
    new = F.when(F.col("ch") != F.lower("ch"), F.upper("near")).otherwise(F.col("near"))
    return w.select("word", "place", F.concat(F.expr("substring(word, 1, place - 1)"), new, F.expr("substring(word, place + 1)")).alias("corrupted"))


def homophone_candidates(words: DataFrame) -> DataFrame:
    """Every (word, src, dst, corrupted) by a spelling of the same sound, first occurrence."""
    pairs = F.array(*[F.struct(F.lit(a).alias("src"), F.lit(b).alias("dst")) for a, b in X.HOMOPHONES])
    w = words.select("word").distinct().select("word", F.explode(F.filter(pairs, lambda p: F.instr(F.lower("word"), p.src) > 0)).alias("p")).select("word", "p.src", "p.dst", F.expr("instr(lower(word), p.src)").alias("i"))
    first = F.expr("substring(word, i, 1)")
    new = F.when(first != F.lower(first), F.initcap("dst")).otherwise(F.col("dst"))
    out = F.concat(F.expr("substring(word, 1, i - 1)"), new, F.expr("substring(word, i + length(src))"))
    return w.select("word", "src", "dst", out.alias("corrupted")).where("corrupted <> word")


__all__ = ["accent_pairs", "adjacency_candidates", "correction_samples", "evaluation_set", "homophone_candidates", "stage_sql"]
