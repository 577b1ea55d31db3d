"""Relations that several queries start from, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions.text import ENTITY, NAMED, RENUMBERED, SHORT, SHORT_NAME
from ..sources.readers import sentence_pairs, split_lines

#: Sources of lines and their priority.
SOURCES = {"local": 1, "conversation": 2, "literature": 3, "encyclopedia": 4}
#: Caps of the priority queries: the defaults of the reference.
CAPS = {"local": None, "conversation": 200_000, "literature": 30_000, "encyclopedia": 70_000}
ORDER = ["priority", "doc_id", "line_no"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(d: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores is dealt out evenly; a larger one stays as it is."""
    try:
        cores, splits = d.sparkSession.sparkContext.defaultParallelism, d.rdd.getNumPartitions()
    except Exception:  # a session that shows no partitions
        return d
    return d if splits >= cores else d.repartition(cores)


def delivered_once(d: DataFrame, key: str) -> DataFrame:
    """Distinct rows. Keys that came again are found from the key column alone, and only their rows meet in a shuffle."""
    again = d.groupBy(F.col(key).alias("_k")).count().where("count > 1").select("_k")
    rows = spread(d)
    same = F.col(key).eqNullSafe(F.col("_k"))
    return rows.join(again, same, "left_anti").unionByName(rows.join(again, same, "left_semi").distinct())


def source_lines(spark: SparkSession, sf_dir: str, source: str, once: bool = True) -> DataFrame:
    """Raw lines of one source. With ``once`` redelivered rows count once; what removes copies of lines or words later
    leaves that out."""

    def rows(name: str, *columns: str) -> DataFrame:
        d = table(spark, sf_dir, name)
        d = (d.where("source = 'local_txt'") if name == "documents" else d).select(*columns)
        return delivered_once(d, columns[0]) if once else spread(d)

    if source == "local":
        return split_lines(rows("documents", "doc_id", "text"), "doc_id", F.col("text"), source, 1)
    if source == "encyclopedia":
        return split_lines(rows("wiki_articles", "rec_id", "text"), "rec_id", F.col("text"), source, 4)
    name = {"conversation": "conv_sentences", "literature": "lit_sentences"}[source]
    return sentence_pairs(rows(name, "rec_id", "translation"), "rec_id", source, SOURCES[source])


def all_lines(spark: SparkSession, sf_dir: str, once: bool = True) -> DataFrame:
    out = None
    for s in SOURCES:
        part = source_lines(spark, sf_dir, s, once)
        out = part if out is None else out.unionByName(part)
    return out


def corpus(spark: SparkSession, sf_dir: str, once: bool = True) -> DataFrame:
    """Plain corpus of the audits: stripped, non-blank lines of all sources, blanks collapsed."""
    from ..functions.text import strip

    rows = all_lines(spark, sf_dir, once).select(*ORDER, "source", strip(F.regexp_replace("line", f"{X.W}+", " ")).alias("line"))
    return rows.where("line <> ''")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{X.W}+|{X.W}+$', '', 'g')"


def words_sql(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{X.W}+'), lambda w: w <> '')"


def edges_sql(c: str) -> str:
    return f"trim({c}, {q(X.EDGE)})"


def plain_sql(c: str) -> str:
    return f"translate({c}, '{X.ACCENTED}', '{X.PLAIN}')"


def count_sql(c: str, pattern: str) -> str:
    return f"len(regexp_extract_all({c}, {q(pattern)}))"


def lower_sql(c: str) -> str:
    """Lower case with the final sigma as Java and Python write it: a capital sigma at the end of a word after a letter."""
    return f"regexp_replace(lower(regexp_replace({c}, '([\\p{{L}}])Σ($|[^\\p{{L}}])', '\\1ς\\2', 'g')), 'x^', '')"


def _split(table_name: str, key: str, text: str, source: str, priority: int, where: str = "true") -> str:
    return (
        f"select '{source}' as source, {priority} as priority, {key} as doc_id, n as line_no, {strip_sql('l')} as line from "
        f"(select {key}, unnest(string_split({text}, chr(10))) as l, unnest(range(1, len(string_split({text}, chr(10))) + 1)) as n from (select distinct {key}, {text} from {table_name} where {text} is not null and {where}) a) b "
        f"where {strip_sql('l')} <> ''"
    )


def _pairs(table_name: str, source: str, priority: int) -> str:
    return f"select '{source}' as source, {priority} as priority, rec_id as doc_id, 1::BIGINT as line_no, t as line from (select distinct rec_id, translation.el as t from {table_name} where translation.el <> '') a"


SOURCE_SQL = {
    "local": _split("documents", "doc_id", "text", "local", 1, "source = 'local_txt'"),
    "conversation": _pairs("conv_sentences", "conversation", 2),
    "literature": _pairs("lit_sentences", "literature", 3),
    "encyclopedia": _split("wiki_articles", "rec_id", "text", "encyclopedia", 4),
}
LINES_SQL = " union all ".join(SOURCE_SQL.values())
CORPUS_SQL = f"select priority, doc_id, line_no, source, line from (select priority, doc_id, line_no, source, {strip_sql(f'''regexp_replace(line, '{X.W}+', ' ', 'g')''')} as line from ({LINES_SQL}) l) m where line <> ''"

GREEK_SQL = lambda c: count_sql(f"regexp_replace({c}, '[^\\p{{L}}]', '', 'g')", X.GREEK)
LETTERS_SQL = lambda c: count_sql(c, r"\p{L}")


def _map_sql(d: dict) -> str:
    return "map {" + ", ".join(f"{q(k) if isinstance(k, str) else k}: {q(v)}" for k, v in d.items()) + "}"


def unescape_sql(c: str) -> str:
    """Every HTML 5 entity of a text."""
    s, e = "substr(e, 2)", "e"
    number = f"case when regexp_matches({s}, '^#[xX]') then try_cast(concat('0x0', regexp_extract({s}, '^#[xX]0*([0-9a-fA-F]*)', 1)) as bigint) else try_cast(concat('0', regexp_extract({s}, '^#0*([0-9]*)', 1)) as bigint) end"
    renumbered = {k: v for k, v in RENUMBERED.items() if k < 0xA0}
    numbered = (
        f"list_transform([{number}], lambda n: coalesce({_map_sql(renumbered)}[n], case when n is null or n > 1114111 or n between 55296 and 57343 then chr(65533) "
        "when n between 64976 and 65007 or n % 65536 >= 65534 then '' else chr(n::integer) end))[1]"
    )
    name = f"regexp_extract({s}, {q(SHORT_NAME)}, 1)"
    named = f"coalesce({_map_sql(NAMED)}[{s}], case when {name} <> '' then concat({_map_sql(SHORT)}[{name}], substr({s}, length({name}) + 1)) else {e} end)"
    found, between = f"regexp_extract_all({c}, {q(ENTITY)})", f"string_split_regex({c}, {q(ENTITY)})"
    read = f"list_transform({found}, lambda e: case when starts_with({s}, '#') then {numbered} else {named} end)"
    return f"case when contains({c}, '&') then list_reduce(list_transform(list_zip({between}, {read}), lambda p: concat(p[1], coalesce(p[2], ''))), lambda a, b: concat(a, b)) else {c} end"


def cascade_sql(lines: str) -> str:
    """The whole cleaning of a relation with priority, doc_id, line_no, source, line."""
    r = lambda c, p, to="": f"regexp_replace({c}, {q(p)}, {q(to)}, 'g')"
    keep = "priority, doc_id, line_no, source, raw"
    email = rf"(^|[^\p{{L}}\p{{N}}_])[A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}"
    read = f"select priority, doc_id, line_no, source, line as raw, {unescape_sql('line')} as line from ({lines}) l00"
    a = f"select priority, doc_id, line_no, source, raw, {r(r(r(f'translate(line, {q(X.SYMBOLS_FROM)}, {q(X.SYMBOLS_TO)})', X.URL), email, chr(92) + '1'), X.CUE)} as a from ({read}) l0"
    marks = r(r(r("a", X.BRACKETED), X.SPEAKER), X.NUMBERING)
    b = f"""select {keep}, a, translate({marks}, {q(';?«»“”’`')}, {q(';;' + '"' * 4 + "''")}) as b from ({a}) l1"""
    e = r("replace(b, '…', '...')", r"\.{2,}", "...")
    e = r(e, r"\.\.\.([^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}.,!?" + "\"';»)])", r"... \1")
    e = r(e, rf"{X.W}+\.\.\.", "...")
    e = r(e, rf"{X.W}+([.,;:!?])", r"\1")
    e = strip_sql(r(e, rf"(?:[,:\-–—]|{X.W})+$", ""))
    e = strip_sql(r(e, f"{X.W}+", " "))
    c = f"select {keep}, a, b, {e} as c from ({b}) l2"
    word = f"case when regexp_matches({edges_sql('w')}, {q(X.GREEK)}) then translate(replace(replace(w, 'pi', 'π'), 'Pi', 'Π'), {q(X.LATIN)}, {q(X.GREEK_LOOK)}) else w end"
    d = f"select {keep}, a, b, c, list_transform({words_sql('c')}, lambda w: {word}) as ws from ({c}) l3"
    f = f"select *, coalesce(array_to_string(ws, ' '), '') as d, len(ws) as n from ({d}) l4"
    ci = lambda col, p: f"regexp_matches({col}, {q('(?i)(?:' + p + ')')})"
    alpha = LETTERS_SQL("d")
    repeated = "len(list_filter(range(1, length(c) - 2), lambda i: c[i] <> chr(10) and c[i] = c[i + 1] and c[i] = c[i + 2] and c[i] = c[i + 3])) > 0"
    reason = (
        "case when raw is null or raw = '' then 'empty' "
        f"when regexp_matches({strip_sql('a')}, {q('^' + chr(92) + 'p{Nd}+$')}) then 'digits_only' when {ci('a', X.CREDITS)} then 'credits' when {ci('a', X.BOILERPLATE)} then 'boilerplate' "
        f"when {ci('a', X.ALMANAC)} then 'almanac' when {ci('a', X.NAVIGATION)} then 'navigation' when {ci('b', X.CALENDAR)} then 'calendar' when c = '' then 'empty_after' "
        f"when {repeated} then 'repeated_char' when len(list_filter(ws, lambda w: regexp_matches({edges_sql('w')}, {q(X.MIXED)}))) > 0 then 'mixed_script' "
        f"when n not between 3 and 40 then 'word_count' when {alpha} = 0 or 100 * {GREEK_SQL('d')} < 85 * {alpha} then 'not_greek' "
        f"when 100 * {count_sql('d', chr(92) + 'p{Lu}')} > 25 * {alpha} and n > 3 then 'capitals' when 100 * {count_sql('d', X.DIGIT)} > 8 * length(d) then 'digits' "
        f"when len(list_filter(ws, lambda w: regexp_matches(w, {q('^' + X.DIGIT + '+$')}))) > 1 then 'numbers' end"
    )
    return f"select {keep}, case when drop_reason is null then d end as clean, drop_reason from (select *, {reason} as drop_reason from ({f}) l5) l6"
