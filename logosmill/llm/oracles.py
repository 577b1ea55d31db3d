"""ANSI SQL of the problems' queries that SQL can express, over the characters that the tables hold.

The words of the consistent form: characters without width go, full-width and
symbol letters become ordinary ones, and in words of several scripts the
look-alikes take the script of most letters.
"""

from __future__ import annotations

# Look-alikes of the characters that the tables hold, written out here again so that a wrong pair of the operator shows.
LATIN_GREEK = {"A": "Α", "B": "Β", "E": "Ε", "Z": "Ζ", "H": "Η", "I": "Ι", "K": "Κ", "M": "Μ", "N": "Ν", "O": "Ο", "P": "Ρ", "T": "Τ", "Y": "Υ", "X": "Χ", "a": "α", "ß": "β", "e": "ε", "i": "ι", "k": "κ", "o": "ο", "p": "ρ", "t": "τ", "u": "υ", "y": "υ", "x": "χ", "v": "ν", "w": "ω"}
CYRILLIC_GREEK = {"А": "Α", "В": "Β", "Е": "Ε", "З": "Ζ", "Н": "Η", "І": "Ι", "К": "Κ", "М": "Μ", "О": "Ο", "Р": "Ρ", "Т": "Τ", "Х": "Χ", "У": "Υ", "а": "α", "е": "ε", "і": "ι", "к": "κ", "о": "ο", "р": "ρ", "у": "υ", "х": "χ"}
GREEK_LATIN = {v: k for k, v in LATIN_GREEK.items() if k not in "uß"} | {"β": "ß"}
CYRILLIC_LATIN = {"А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x"}

WIDTHLESS = r"[\x{ad}\x{200b}-\x{200f}\x{2060}\x{feff}]"
WIDE = "".join(chr(o) for o in range(0xFF01, 0xFF5F)), "".join(chr(o - 0xFEE0) for o in range(0xFF01, 0xFF5F))
SYMBOLS = "ϐϑϒϕϖϰϱϴϵµΩ", "βθΥφπκρΘεμΩ"
GREEK, LATIN, CYRILLIC = r"[\x{370}-\x{3ff}]", r"[a-zA-Z\x{df}-\x{24f}]", r"[\x{400}-\x{4ff}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _translate(c: str, *maps: dict) -> str:
    both = {k: v for m in maps for k, v in m.items()}
    return f"translate({c}, {q(''.join(both))}, {q(''.join(both.values()))})"


def words_sql(text: str) -> str:
    """The list of folded words of a text."""
    plain = f"regexp_replace({text}, '{WIDTHLESS}', '', 'g')"
    plain = f"strip_accents(translate({plain}, {q(WIDE[0] + SYMBOLS[0])}, {q(WIDE[1] + SYMBOLS[1])}))"
    n = lambda p: f"len(regexp_extract_all(w, '{p}'))"
    fixed = (
        f"case when {n(GREEK)} > 0 and {n(LATIN)} + {n(CYRILLIC)} > 0 and {n(GREEK)} >= {n(LATIN)} and {n(GREEK)} >= {n(CYRILLIC)} then {_translate('w', LATIN_GREEK, CYRILLIC_GREEK)} "
        f"when {n(LATIN)} > 0 and {n(GREEK)} + {n(CYRILLIC)} > 0 then {_translate('w', CYRILLIC_LATIN, GREEK_LATIN)} else w end"
    )
    return f"list_transform(regexp_extract_all({plain}, '[\\p{{L}}\\p{{N}}]+'), lambda w: translate(lower({fixed}), 'ς', 'σ'))"


TEXTS = {
    "conv_sentences": "select distinct rec_id, split_name, translation.el as text from conv_sentences",
    "lit_sentences": "select distinct rec_id, split_name, translation.el as text from lit_sentences",
    "wiki_articles": "select distinct rec_id, split_name, text from wiki_articles",
}


SENTENCE_TABLES = ("conv_sentences", "lit_sentences")


def _alike(tables: tuple[str, ...], where: str) -> str:
    rows = " union all ".join(TEXTS[t] for t in tables)
    return (
        f"with r as (select rec_id, split_name, list_distinct({words_sql('text')}) as ws from ({rows}) a where text <> ''), s as (select rec_id, split_name, ws, len(ws) as n from r where len(ws) >= 10), "
        "t as (select rec_id, n, unnest(ws) as w from s), f as (select w, count(*) as c from t group by w), "
        "p as (select rec_id, w from (select rec_id, n, t.w, row_number() over (partition by rec_id order by c, t.w) as k from t join f on t.w = f.w) x where k <= n - (7 * n + 9) // 10 + 1), "
        "c as (select distinct a.rec_id as id_a, b.rec_id as id_b from p a join p b on a.w = b.w and a.rec_id < b.rec_id) "
        "select distinct id_a, id_b from (select id_a, id_b, a.split_name as sa, b.split_name as sb, a.n + b.n as n, len(list_intersect(a.ws, b.ws)) as k from c join s a on a.rec_id = id_a join s b on b.rec_id = id_b) y "
        f"where 10 * k >= 7 * (n - k) and {where}"
    )


def _groups() -> str:
    """Least record of each connected group of alike records, and how many other texts (word sets) each text is alike to."""
    rows = " union all ".join(TEXTS[t] for t in SENTENCE_TABLES)
    return (
        f"with recursive pairs as materialized ({_alike(SENTENCE_TABLES, 'true')}), "
        f"t as materialized (select rec_id, list_sort(list_distinct({words_sql('text')})) as ws from (select distinct rec_id, text from ({rows}) a where text <> '') b), "
        "k as materialized (select rec_id, min(rec_id) over (partition by ws) as rep from t where len(ws) >= 10), "
        "l as (select distinct a.rep as x, b.rep as y from pairs p join k a on a.rec_id = p.id_a join k b on b.rec_id = p.id_b where a.rep <> b.rep), "
        "n as (select rep, count(distinct other) as links from (select x as rep, y as other from l union all select y, x from l) m group by rep), "
        "e as materialized (select id_a as u, id_b as v from pairs union all select id_b, id_a from pairs), "
        "g as (select rec_id as id, rec_id as root from t union select g.id, e.v from g join e on e.u = g.root) "
        "select t.rec_id, min(g.root) as group_id, coalesce(min(n.links), 0) as links from t join g on g.id = t.rec_id left join k on k.rec_id = t.rec_id left join n on n.rep = k.rep group by t.rec_id"
    )


def _quality() -> str:
    """The plain statistics of each record; lines are told by what is left of them in the consistent form."""
    rows = " union all ".join(TEXTS[t] for t in ("conv_sentences", "wiki_articles"))
    clean = f"translate(regexp_replace(coalesce(text, ''), '{WIDTHLESS}', '', 'g'), {q(WIDE[0])}, {q(WIDE[1])})"
    blank = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    lines = f"list_filter(list_transform(string_split({clean}, chr(10)), lambda x: regexp_replace(x, '{blank}+$', '')), lambda x: x <> '')"
    stops = "'[.;!?…·»\"”)\\]:,'']$'"
    return (
        f"select rec_id, len(ws) as words, round(case when len(ws) > 0 then list_sum(list_transform(ws, lambda w: length(w)))::DOUBLE / len(ws) else 0 end, 6) as mean_word_length, "
        f"len(ls) as lines, round(case when len(ls) > 0 then len(list_filter(ls, lambda x: regexp_matches(x, {stops})))::DOUBLE / len(ls) else 0 end, 6) as stop_line_share "
        f"from (select rec_id, {words_sql('text')} as ws, {lines} as ls from (select distinct rec_id, coalesce(text, '') as text from ({rows}) a) b) c"
    )


def _windows(rel: str, key: str) -> str:
    return f"select distinct {key}, unnest(list_transform(range(1, len(ws) - 8), lambda k: array_to_string(list_slice(ws, k, k + 9), ' '))) as g from (select {key}, {words_sql('text')} as ws from {rel} where text is not null) a where len(ws) >= 10"


_ODD = r"[\x{a0}\x{ad}\x{b5}\x{300}-\x{36f}\x{3d0}-\x{3d6}\x{3f0}-\x{3f5}\x{1f71}\x{1f73}\x{1f75}\x{1f77}\x{1f79}\x{1f7b}\x{1f7d}\x{2000}-\x{200c}\x{200e}\x{200f}\x{202f}\x{205f}\x{2060}\x{2126}\x{3000}\x{fb00}-\x{fb06}\x{feff}\x{ff01}-\x{ff5e}]"
_MIXED = "|".join(f"{a}{b}" for a in (GREEK, LATIN, CYRILLIC) for b in (GREEK, LATIN, CYRILLIC) if a != b)
_PICTURE = r"[\x{1f300}-\x{1faff}\x{2600}-\x{27bf}]"
_CHANGED = f"regexp_matches(text, '{_ODD}') or regexp_matches(regexp_replace(text, '{_PICTURE}\\x{{200d}}{_PICTURE}', '', 'g'), '\\x{{200d}}') or regexp_matches(text, '{_MIXED}')"

_SIZES = (
    f"with r as (select rec_id, source, max(len({words_sql('text')})) as words, max(length(text)) as chars, 1 as records from (" + " union all ".join(f"select rec_id, '{t}' as source, text from ({sql}) x" for t, sql in TEXTS.items())
    + ") a where text <> '' group by rec_id, source), "
    "u as (select mix_id, r.source, r.rec_id, target_share, max_repeats, size_unit, total_factor, case size_unit when 'words' then words when 'chars' then chars else records end as size from r join (select distinct * from mix_targets) m on m.source_name = r.source), "
    "k as (select *, concat('0x', substr(md5(concat('20240607|', cast(rec_id as varchar))), 1, 15))::BIGINT as key, sum(size) over (partition by mix_id, source) as own, sum(size) over (partition by mix_id) as every from u), "
    "b as (select *, every * total_factor * target_share as budget, coalesce(sum(size) over (partition by mix_id, source order by key, rec_id rows between unbounded preceding and 1 preceding), 0) as before from k), "
    "e as (select *, least(max_repeats, cast(floor(budget / own) as bigint)) as epochs from b), "
    "t as (select *, epochs + case when epochs < max_repeats and budget - epochs * own > 0 and before + size / 2.0 <= budget - epochs * own then 1 else 0 end as times from e) "
)

ORACLE = {
    "p1_found": _alike(("conv_sentences", "lit_sentences", "wiki_articles"), "(sa = 'train') <> (sb = 'train') and sa in ('train', 'val', 'test') and sb in ('train', 'val', 'test')"),
    "p2_found": f"select distinct rec_id from ({TEXTS['conv_sentences']} union all {TEXTS['wiki_articles']}) a where {_CHANGED}",
    "p3_found": _alike(("conv_sentences", "lit_sentences"), "true"),
    "p5_usage": _SIZES + "select mix_id, source as source_name, rec_id, cast(times as integer) as times from t",
    "p5_shares": _SIZES + "select mix_id, source_name, size_unit, target_share, round(actual_size::DOUBLE / sum(actual_size) over (partition by mix_id), 6) as actual_share, round(budget, 3) as budget, actual_size, "
    "round(actual_size / whole, 6) as share_of_target_size, max_used from (select mix_id, source as source_name, min(size_unit) as size_unit, min(target_share) as target_share, min(budget) as budget, "
    "sum(times * size)::BIGINT as actual_size, min(every * total_factor) as whole, cast(max(times) as integer) as max_used from t group by mix_id, source) z",
    "p8_found": f"select distinct doc_id, item_id from ({_windows('documents', 'doc_id')}) d join ({_windows('eval_items', 'item_id')}) i using (g)",
    "p3_groups": _groups(),
    "p6_ratios": _quality(),
    "p8_report": f"with d as materialized ({_windows('documents', 'doc_id')}), i as materialized ({_windows('eval_items', 'item_id')}), "
    "h as (select doc_id, item_id, count(*) as n from d join i using (g) group by doc_id, item_id), w as (select item_id, count(*) as n from i group by item_id) "
    "select suite, source, count(distinct h.item_id) as items, count(distinct h.doc_id) as documents, count(distinct case when h.n = w.n then h.doc_id end) as whole_documents "
    "from h join w on w.item_id = h.item_id join documents o on o.doc_id = h.doc_id join (select distinct item_id, suite from eval_items) s on s.item_id = h.item_id group by suite, source",
}
ORACLE["p1_shards"] = ORACLE["p1_found"]
