"""The correction samples in ANSI SQL, written on its own: it shares the fixed values with the operator and no step.

A word of each sentence is drawn (one of three or more letters, if there is one) and parted from the signs around it. Each kind of
error gives its result or nothing; dice decide which kind is asked first, as a chain from the rarest test to the last resort.
"""

from __future__ import annotations

from ..functions import lexicon as X


def _t(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _hash(salt: str) -> str:
    return f"('0x' || substr(md5(id || '|{salt}'), 1, 8))::BIGINT"


def _plain(c: str) -> str:
    return f"translate({c}, {_t(X.ACCENTED)}, {_t(X.PLAIN)})"


def typos_sql(sentences: str) -> str:
    """id, context, corrupted_word, target_word, error_type, full_sequence of a relation with id and sentence."""
    blank, edge = X.W, _t(X.EDGE)
    sign, letter = r"[^\p{L}\p{N}_]*", r"[\p{L}\p{N}_]+"
    shape = _t(f"^({sign})({letter})({sign})$")
    pairs = "[" + ", ".join(f"{{'src': {_t(a)}, 'dst': {_t(b)}}}" for a, b in X.HOMOPHONES) + "]"
    keys = "map {" + ", ".join(f"{_t(k)}: {_t(v)}" for k, v in X.ADJACENT.items()) + "}"
    base = lambda c: f"lower({_plain(c)})"
    like = lambda new, old: f"case when {old} = lower({old}) then {new} else upper({new}) end"
    return f"""
with tokens as (
  select id, [x for x in regexp_split_to_array(sentence, {_t(blank + '+')}) if x <> ''] as ws from {sentences}
), choice as (
  select id, ws, [i for i in range(1, len(ws) + 1) if length(trim(ws[i], {edge})) > 2] as long_ones from tokens where len(ws) > 1
), target as (
  select id, ws, (case len(long_ones) when 0 then {_hash('word')} % len(ws) + 1 else long_ones[{_hash('word')} % len(long_ones) + 1] end)::INTEGER as t from choice
), parted as (
  select id, ws, t, regexp_matches(ws[t], {shape}) as clean,
    regexp_extract(ws[t], {shape}, 1) as front, regexp_extract(ws[t], {shape}, 2) as core, regexp_extract(ws[t], {shape}, 3) as back from target
), word as (
  select id, ws, t, case when clean then front else '' end as front, case when clean then core else ws[t] end as core, case when clean then back else '' end as back from parted
), bare as (
  select *, trim(core, {edge}) as w from word where length(trim(core, {edge})) > 1
), drawn as (
  select *, {_hash('dice')} / 4294967296.0::DOUBLE as dice,
    [i for i in range(1, length(w) + 1) if {keys}[{base('w[i]')}] is not null] as hit,
    [p for p in {pairs} if contains(lower(w), p.src)] as sounds,
    case {_hash('kind')} % 4 when 0 then 'swap' when 1 then 'drop' when 2 then 'insert' else 'double' end as slip from bare
), placed as (
  select *, case when len(hit) > 0 then hit[{_hash('place')} % len(hit) + 1] end as pos, case when len(sounds) > 0 then sounds[{_hash('pair')} % len(sounds) + 1] end as snd,
    (1 + case slip when 'swap' then {_hash('at')} % (length(w) - 1) when 'insert' then {_hash('at')} % (length(w) + 1) else {_hash('at')} % length(w) end)::INTEGER as k from drawn
), near as (
  select *, {keys}[{base('w[pos]')}] as around, position(snd.src in lower(w)) as at_sound, w[least(k, length(w))] as beside from placed
), more as (
  select *, around[{_hash('key')} % length(around) + 1] as key, {keys}[case when contains({_t(X.ACCENTED)}, beside) then {base('beside')} else 'α' end] as extra from near
), made as (
  select *,
    case when {_plain('w')} <> w then {_plain('w')} end as without_accents,
    case when pos is not null then w[:pos - 1] || {like('key', 'w[pos]')} || w[pos + 1:] end as by_key,
    w[:at_sound - 1] || case when w[at_sound] = lower(w[at_sound]) then snd.dst else upper(snd.dst[1]) || snd.dst[2:] end || w[at_sound + length(snd.src):] as by_sound,
    case slip when 'swap' then w[:k - 1] || w[k + 1] || w[k] || w[k + 2:] when 'drop' then case when length(w) > 2 then w[:k - 1] || w[k + 1:] end
      when 'insert' then w[:k - 1] || extra[{_hash('inserted')} % length(extra) + 1] || w[k:] else w[:k] || w[k:] end as by_slip from more
), settled as (
  select *, case when dice < 0.5 and without_accents is not null then 'accent_strip' when dice < 0.8 and by_key is not null then 'adjacency' when dice < 0.9 and by_sound <> w then 'homophone'
      when by_slip is not null then 'dynamics' when without_accents is not null then 'accent_strip' when by_key is not null then 'adjacency' end as error_type from made
), wrong as (
  select *, case error_type when 'accent_strip' then without_accents when 'adjacency' then by_key when 'homophone' then by_sound when 'dynamics' then by_slip end as bad,
    array_to_string(ws[:t - 1], ' ') as words_before from settled where error_type is not null
), told as (
  select *, case front when '' then words_before else regexp_replace(words_before || ' ' || front, {_t(f'^{blank}+|{blank}+$')}, '', 'g') end as context from wrong where bad <> core
)
select id, context, bad || back as corrupted_word, core || back as target_word, error_type,
  case when regexp_matches(context, {_t(X.NOT_W)}) then regexp_replace(context, {_t(f'^{blank}+|{blank}+$')}, '', 'g') || ' ' else '' end || {_t(X.BAD)} || bad || back || {_t(X.GOOD)} || core || back || {_t(X.END)} as full_sequence
from told"""
