"""Registered queries over the supplied tables, and the same in ANSI SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions import text as T
from ..operators import audit, clean, corrupt, dedup, logs, metrics, model_meta, sequence, split, vocab
from ..sources import readers
from .base import CAPS, CORPUS_SQL, GREEK_SQL, LETTERS_SQL, LINES_SQL, ORDER, SOURCE_SQL, SOURCES, all_lines, cascade_sql, corpus, count_sql, edges_sql, lower_sql, plain_sql, q, source_lines, strip_sql, table, unescape_sql, words_sql
from .shared import written
from .typo_oracle import typos_sql

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def rnd(c: str) -> str:
    return f"round({c}, 6)"


# Sources


@query(
    f"select source, count(*) as lines from (select source, line from ({CORPUS_SQL}) c where len({words_sql('line')}) between 3 and 40 and {LETTERS_SQL('line')} > 0 "
    f"and 100 * {GREEK_SQL('line')} >= 85 * {LETTERS_SQL('line')} group by source, line) d group by source"
)
def greek_lines_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct Greek lines of fitting length by source."""
    c = corpus(spark, sf_dir, once=False)
    n = T.letters(F.col("line"))
    kept = c.where(F.size(T.words(F.col("line"))).between(3, 40) & (n > 0) & (100 * T.greek_letters(F.col("line")) >= 85 * n))
    return kept.select("source", "line").distinct().groupBy("source").agg(F.count("*").alias("lines"))


@query(f"select source, doc_id, line_no, line from ({LINES_SQL}) l")
def read_lines_all(spark, sf_dir):
    """Lines of all four sources."""
    return all_lines(spark, sf_dir).select("source", "doc_id", "line_no", "line")


@query("select rec_id as doc_id, translation.el as line from (select distinct rec_id, translation from conv_sentences where translation.el <> '') a")
def read_nested_pairs(spark, sf_dir):
    return source_lines(spark, sf_dir, "conversation").select("doc_id", "line")


@query(f"select doc_id, line_no, line from ({SOURCE_SQL['encyclopedia'].replace('rec_id as doc_id', 'rec_id as doc_id')}) l")
def read_jsonl_lines(spark, sf_dir):
    """Articles as JSON records, and back to lines."""
    d = table(spark, sf_dir, "wiki_articles").select("rec_id", "text").distinct()
    return readers.parse_json_lines(d.select("rec_id", F.to_json(F.struct("text")).alias("json")), "rec_id", "json")


# Scalar functions


def _unescape_sql(c: str) -> str:
    for entity, char in X.ENTITIES:
        c = f"replace({c}, {q(entity)}, {q(char)})"
    return c


@query(f"select doc_id, line_no, source, {_unescape_sql('line')} as line from ({LINES_SQL}) l where contains(line, '&')")
def html_unescape_bounded(spark, sf_dir):
    return all_lines(spark, sf_dir).where(F.col("line").contains("&")).select("doc_id", "line_no", "source", T.unescape(F.col("line")).alias("line"))


@query(f"select doc_id, line_no, source, {unescape_sql('line')} as line from ({LINES_SQL}) l where contains(line, '&')")
def html_unescape(spark, sf_dir):
    """Every HTML 5 entity."""
    return all_lines(spark, sf_dir).where(F.col("line").contains("&")).select("doc_id", "line_no", "source", T.unescape_all(F.col("line")).alias("line"))


@query(f"select doc_id, line_no, source, translate(line, {q(X.SYMBOLS_FROM)}, {q(X.SYMBOLS_TO)}) as line from ({LINES_SQL}) l")
def normalise_symbols(spark, sf_dir):
    return all_lines(spark, sf_dir).select("doc_id", "line_no", "source", clean.normalise_symbols(F.col("line")).alias("line"))


@query(f"""select doc_id, line_no, source, translate(line, {q(';?«»“”’`')}, {q(';;' + '"' * 4 + "''")}) as line from ({LINES_SQL}) l""")
def normalise_punctuation(spark, sf_dir):
    return all_lines(spark, sf_dir).select("doc_id", "line_no", "source", clean.normalise_punctuation(F.col("line")).alias("line"))


def _r(c: str, p: str, to: str = "") -> str:
    return f"regexp_replace({c}, {q(p)}, {q(to)}, 'g')"


_DOTS = r"\.\.\.([^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}.,!?" + "\"';»)])"
_ELLIPSIS = _r(_r(_r("replace(line, '…', '...')", r"\.{2,}", "..."), _DOTS, r"... \1"), rf"{X.W}+\.\.\.", "...")
_TIDY = strip_sql(_r(strip_sql(_r(_r(_ELLIPSIS, rf"{X.W}+([.,;:!?])", r"\1"), rf"(?:[,:\-–—]|{X.W})+$")), f"{X.W}+", " "))


@query(f"select doc_id, line_no, source, {_TIDY} as line from ({LINES_SQL}) l")
def normalise_ellipsis(spark, sf_dir):
    return all_lines(spark, sf_dir).select("doc_id", "line_no", "source", clean.tidy_spacing(clean.normalise_ellipsis(F.col("line"))).alias("line"))


_MARKS = _r(_r(_r(_r("line", X.CUE), X.BRACKETED), X.SPEAKER), X.NUMBERING)


@query(f"select doc_id, line_no, source, {_MARKS} as line from ({LINES_SQL}) l")
def strip_artifacts(spark, sf_dir):
    """Cues, bracketed spans, speakers and list numbers."""
    return all_lines(spark, sf_dir).select("doc_id", "line_no", "source", clean.strip_marks(clean.strip_cues(F.col("line"))).alias("line"))


_EMAIL = rf"(^|[^\p{{L}}\p{{N}}_])[A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}"


@query(f"select doc_id, line_no, source, {_r(_r('line', X.URL), _EMAIL, chr(92) + '1')} as line from ({LINES_SQL}) l")
def strip_links(spark, sf_dir):
    return all_lines(spark, sf_dir).select("doc_id", "line_no", "source", clean.strip_links(F.col("line")).alias("line"))


_FLAGS = {"credits": X.CREDITS, "boilerplate": X.BOILERPLATE, "almanac": X.ALMANAC, "navigation": X.NAVIGATION, "calendar": X.CALENDAR}


@query(f"select source, {', '.join(f'''sum(cast(regexp_matches(line, {q('(?i)(?:' + p + ')')}) as bigint))::BIGINT as {n}''' for n, p in _FLAGS.items())}, count(*) as lines from ({LINES_SQL}) l group by source")
def boilerplate_flags(spark, sf_dir):
    return all_lines(spark, sf_dir).groupBy("source").agg(*[F.sum(F.col("line").rlike(clean.any_case(p)).cast("bigint")).alias(n) for n, p in _FLAGS.items()], F.count("*").alias("lines"))


_REPAIR = f"case when regexp_matches({edges_sql('w')}, {q(X.GREEK)}) then translate(replace(replace(w, 'pi', 'π'), 'Pi', 'Π'), {q(X.LATIN)}, {q(X.GREEK_LOOK)}) else w end"
_WORDS_SQL = f"select unnest({words_sql('line')}) as w from ({CORPUS_SQL}) c"


@query(f"select w as word, repaired, count(*) as n from (select w, {_REPAIR} as repaired from ({_WORDS_SQL}) a) b where w <> repaired group by w, repaired")
def homoglyph_repair(spark, sf_dir):
    """Words that the look-alike repair changes."""
    w = corpus(spark, sf_dir).select(F.explode(T.words(F.col("line"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return w.withColumn("repaired", T.repair_word(F.col("word"))).where("word <> repaired").select("word", "repaired", "n")


@query(f"select word, count(*) as n from (select {_REPAIR} as word from ({_WORDS_SQL}) a) b where regexp_matches({edges_sql('word')}, {q(X.MIXED)}) group by word")
def mixed_script_words(spark, sf_dir):
    """Words of two scripts after the repair."""
    w = corpus(spark, sf_dir).select(F.explode(T.words(F.col("line"))).alias("w")).select(T.repair_word(F.col("w")).alias("word"))
    return w.where(T.strip_edges(F.col("word")).rlike(X.MIXED)).groupBy("word").agg(F.count("*").alias("n"))


@query(
    f"select source, count(*) as lines, sum(cast(len({words_sql('line')}) not between 3 and 40 as bigint))::BIGINT as word_count, "
    f"sum(cast({LETTERS_SQL('line')} = 0 or 100 * {GREEK_SQL('line')} < 85 * {LETTERS_SQL('line')} as bigint))::BIGINT as not_greek, "
    f"sum(cast(100 * {count_sql('line', chr(92) + 'p{Lu}')} > 25 * {LETTERS_SQL('line')} and len({words_sql('line')}) > 3 as bigint))::BIGINT as capitals, "
    f"sum(cast(100 * {count_sql('line', X.DIGIT)} > 8 * length(line) as bigint))::BIGINT as digits, "
    f"sum(cast(len(list_filter({words_sql('line')}, lambda w: regexp_matches(w, {q('^' + X.DIGIT + '+$')}))) > 1 as bigint))::BIGINT as numbers from ({CORPUS_SQL}) c group by source"
)
def line_density_flags(spark, sf_dir):
    c = corpus(spark, sf_dir).withColumn("ws", T.words(F.col("line")))
    checks = clean.density_checks(F.col("line"), F.col("ws"))
    return c.groupBy("source").agg(F.count("*").alias("lines"), *[F.sum(hit.cast("bigint")).alias(name) for name, hit in checks])


# The cascade, deduplication and split


@query(f"select source, doc_id, line_no, clean as line from ({cascade_sql(LINES_SQL)}) c where drop_reason is null")
def clean_lines(spark, sf_dir):
    return clean.cleaned(all_lines(spark, sf_dir)).select("source", "doc_id", "line_no", "line")


@query(f"select source, coalesce(drop_reason, 'kept') as reason, count(*) as n from ({cascade_sql(LINES_SQL)}) c group by source, coalesce(drop_reason, 'kept')")
def drop_reason_counts(spark, sf_dir):
    return clean.cascade(all_lines(spark, sf_dir)).groupBy("source", F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


_KEPT = f"select priority, doc_id, line_no, source, clean as line, md5(clean) as hash from ({cascade_sql(LINES_SQL)}) c where drop_reason is null"


def _first(rel: str) -> str:
    return f"select priority, doc_id, line_no, source, line, hash from (select *, row_number() over (partition by hash order by priority, doc_id, line_no) as rn from ({rel}) x) y where rn = 1"


@query(f"select source, doc_id, line_no, hash from ({_first(_KEPT)}) z")
def exact_dedup(spark, sf_dir):
    return dedup.keep_first(clean.cleaned(all_lines(spark, sf_dir, once=False)), ORDER).select("source", "doc_id", "line_no", "hash")


def _priority_sql(caps: dict[str, int | None] = CAPS) -> str:
    parts, seen = [f"with kept as ({_KEPT})"], []
    for s, cap in caps.items():
        not_seen = "".join(f" and hash not in (select hash from d_{x})" for x in seen)
        first = f"select *, row_number() over (partition by hash order by priority, doc_id, line_no) as rn from kept where source = '{s}'{not_seen}"
        limit = f" order by priority, doc_id, line_no limit {cap}" if cap else ""
        parts.append(f"d_{s} as (select source, doc_id, line_no, hash, priority from ({first}) a where rn = 1{limit})")
        seen.append(s)
    return ", ".join(parts) + " " + " union all ".join(f"select source, doc_id, line_no, hash from d_{s}" for s in caps)


def _deduped(spark, sf_dir, caps: dict[str, int | None] = CAPS):
    return dedup.priority_keys([(clean.cleaned(source_lines(spark, sf_dir, s, once=False)), caps[s]) for s in SOURCES], ORDER)


@query(_priority_sql())
def priority_capped_dedup(spark, sf_dir):
    """Sources in order of priority, with the caps of the reference."""
    return _deduped(spark, sf_dir).select("source", "doc_id", "line_no", "hash")


_SPLIT = (
    f"with lines as ({_first(_KEPT)}), r as (select *, row_number() over (order by md5(concat('42|', hash)), hash) as rank, count(*) over () as n from lines), "
    "p as (select *, least(greatest(100, cast(floor(n * 0.025) as bigint)), n // 2) as part from r), "
    "s as (select *, case when rank <= n - 2 * part then 'train' when rank <= n - part then 'val' else 'test' end as split from p) "
)


def _split(spark, sf_dir):
    """Of the hashes alone: the lines are neither sorted nor written."""
    return split.split_lines(dedup.keep_first(clean.cleaned(all_lines(spark, sf_dir, once=False)), ORDER).select("source", "doc_id", "line_no", "hash"))


@query(_SPLIT + "select source, doc_id, line_no, hash, rank, split from s")
def split_assign(spark, sf_dir):
    return _split(spark, sf_dir).select("source", "doc_id", "line_no", "hash", F.col("rank").cast("bigint").alias("rank"), "split")


@query(
    _SPLIT + "select count(*) as total_lines, sum(cast(split = 'train' as bigint))::BIGINT as train_lines, sum(cast(split = 'val' as bigint))::BIGINT as val_lines, sum(cast(split = 'test' as bigint))::BIGINT as test_lines, "
    "3 as min_words_per_line, 40 as max_words_per_line, 0.85::DOUBLE as min_greek_ratio from s"
)
def dataset_stats(spark, sf_dir):
    return split.dataset_stats(_split(spark, sf_dir))


# Audit


@query(f"select count(*) as lines, sum(len({words_sql('line')}))::BIGINT as words, sum(length(line))::BIGINT as chars, {rnd(f'sum(len({words_sql(chr(108) + 'ine')}))::DOUBLE / count(*)')} as words_per_line from ({CORPUS_SQL}) c")
def audit_totals(spark, sf_dir):
    return audit.totals(corpus(spark, sf_dir))


_CHARS = f"select c as char, count(*) as n from (select unnest(string_split(line, '')) as c from ({CORPUS_SQL}) x) y where c <> '' group by c"


@query(_CHARS)
def char_freq(spark, sf_dir):
    return audit.char_frequency(corpus(spark, sf_dir))


@query(
    f"select class, sum(n)::BIGINT as n from (select case when regexp_matches(char, {q(X.GREEK)}) then 'greek' when regexp_matches(char, '[A-Za-z]') then 'latin' "
    f"when regexp_matches(char, {q(X.DIGIT)}) then 'digit' when char = ' ' then 'space' else 'punct' end as class, n from ({_CHARS}) f) g group by class"
)
def script_classes(spark, sf_dir):
    return audit.script_classes(corpus(spark, sf_dir))


_EDGED = f"select {edges_sql('w')} as e from ({_WORDS_SQL}) a where {edges_sql('w')} <> ''"


@query(f"select {lower_sql('e')} as word, count(*) as n from ({_EDGED}) b group by {lower_sql('e')} order by n desc, word limit 20")
def word_top20(spark, sf_dir):
    return audit.top_words(corpus(spark, sf_dir))


_SYLL = f"case when {lower_sql('e')} in ({', '.join(q(m) for m in X.MONOSYLLABLES)}) then 1 else {count_sql(f'''regexp_replace({lower_sql('e')}, '{X.DIGRAPHS}', 'α', 'g')''', f'[{X.VOWELS}]')} end"


@query(
    f"select sum(n)::BIGINT as polysyllabic, sum(case when regexp_matches(e, '[{X.STRESSED}]') then n else 0 end)::BIGINT as accented, "
    f"{rnd(f'''sum(case when regexp_matches(e, '[{X.STRESSED}]') then n else 0 end)::DOUBLE / sum(n)''')} as accent_ratio from (select e, count(*) as n from ({_EDGED}) b group by e) d where {_SYLL} >= 2"
)
def accent_compliance(spark, sf_dir):
    return audit.accent_compliance(corpus(spark, sf_dir))


@query(f"select {lower_sql('e')} as word, sum(n)::BIGINT as n from (select e, count(*) as n from ({_EDGED}) b group by e) d where {_SYLL} >= 2 and not regexp_matches(e, '[{X.STRESSED}]') group by {lower_sql('e')} order by n desc, word limit 10")
def unaccented_top10(spark, sf_dir):
    return audit.unaccented_top(corpus(spark, sf_dir))


@query(f"select line, len({words_sql('line')}) as words, doc_id, line_no from ({CORPUS_SQL}) c order by words, priority, doc_id, line_no limit 5")
def shortest5(spark, sf_dir):
    return audit.shortest(corpus(spark, sf_dir), ORDER).select("line", F.col("words").cast("bigint").alias("words"), "doc_id", F.col("line_no").cast("bigint").alias("line_no"))


@query(f"select line, len({words_sql('line')}) as words, doc_id, line_no from ({CORPUS_SQL}) c order by words desc, priority, doc_id, line_no limit 5")
def longest5(spark, sf_dir):
    return audit.longest(corpus(spark, sf_dir), ORDER).select("line", F.col("words").cast("bigint").alias("words"), "doc_id", F.col("line_no").cast("bigint").alias("line_no"))


@query(f"select line, {rnd('ratio')} as ratio, doc_id, line_no from (select *, {GREEK_SQL('line')}::DOUBLE / {LETTERS_SQL('line')} as ratio from ({CORPUS_SQL}) c where {LETTERS_SQL('line')} > 0) d where ratio < 1 order by d.ratio, priority, doc_id, line_no limit 5")
def least_greek5(spark, sf_dir):
    return audit.least_greek(corpus(spark, sf_dir), ORDER).select("line", "ratio", "doc_id", F.col("line_no").cast("bigint").alias("line_no"))


@query(f"select doc_id, line_no, line from ({CORPUS_SQL}) c order by md5(concat('42|', cast(doc_id as varchar), '-', cast(line_no as varchar))) limit 100")
def audit_sample(spark, sf_dir):
    """A reproducible sample of 100 lines."""
    c = corpus(spark, sf_dir).withColumn("key", F.concat_ws("-", "doc_id", "line_no"))
    return audit.sample_lines(c, "key", 100).select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "line")


@query(
    f"with e as materialized (select e, count(*) as n from ({_EDGED}) b group by e), low as (select {lower_sql('e')} as word, sum(n)::BIGINT as n from e group by all), poly as (select e, n from e where {_SYLL} >= 2), "
    f"bare as (select {lower_sql('e')} as word, sum(n)::BIGINT as n from poly where not regexp_matches(e, '[{X.STRESSED}]') group by all), c as materialized ({CORPUS_SQL}), f as ({_CHARS}) "
    f"select 'totals' as section, unnest(['lines', 'words', 'chars']) as item, unnest([count(*), sum(len({words_sql('line')}))::BIGINT, sum(length(line))::BIGINT]) as n from c union all select 'totals', 'vocabulary', count(*) from low "
    f"union all select 'scripts', case when regexp_matches(char, {q(X.GREEK)}) then 'greek' when regexp_matches(char, '[A-Za-z]') then 'latin' when regexp_matches(char, {q(X.DIGIT)}) then 'digit' when char = ' ' then 'space' else 'punct' end as class, sum(n)::BIGINT from f group by class "
    f"union all select 'accents', 'polysyllabic', sum(n)::BIGINT from poly union all select 'accents', 'accented', sum(n)::BIGINT from poly where regexp_matches(e, '[{X.STRESSED}]') "
    "union all select * from (select 'frequent', word, n from low order by n desc, word limit 20) t union all select * from (select 'unaccented', word, n from bare order by n desc, word limit 10) u"
)
def audit_report(spark, sf_dir):
    """The audit from one pass over the lines."""
    return audit.report(written(audit.counts(corpus(spark, sf_dir)), "audit"))


# Vocabulary


_SEEDS = f"select e as word, count(*) as n from ({_EDGED}) b where not regexp_matches(e, {q(X.DIGIT)}) group by e"
_AUGMENTED = f"select word, sum(n)::BIGINT as n from (select word, n from ({_SEEDS}) s union all select {plain_sql('word')}, n from ({_SEEDS}) t where {plain_sql('word')} <> word) u group by word"


@query(_SEEDS)
def seed_words(spark, sf_dir):
    return vocab.seed_words(corpus(spark, sf_dir))


@query(_AUGMENTED)
def augmented_words(spark, sf_dir):
    return vocab.augmented(vocab.seed_words(corpus(spark, sf_dir)))


def _spaced(c: str) -> str:
    return strip_sql(_r(_r(c, r'([.,!?;:"«»()\[\]{}])', r" \1 "), f"{X.W}+", " "))


@query(f"select doc_id, line_no, source, {_spaced('line')} as line, {plain_sql(_spaced('line'))} as plain from ({CORPUS_SQL}) c")
def punct_spaced_lines(spark, sf_dir):
    s = T.space_punctuation(F.col("line"))
    return corpus(spark, sf_dir).select("doc_id", "line_no", "source", s.alias("line")).withColumn("plain", T.strip_accents(F.col("line")))


@query(
    f"select 'priority' as kind, {len(X.PRIORITY_WORDS) * 120} as rows union all "
    f"select 'word', sum(least(50, greatest(6, cast(floor(pow(n, 0.52)) as bigint))))::BIGINT from (select n from ({_AUGMENTED}) a order by n desc, word limit 14000) b union all "
    f"select 'line', 2 * count(*) from ({CORPUS_SQL}) c where {_spaced('line')} <> ''"
)
def seed_corpus_counts(spark, sf_dir):
    return vocab.seed_corpus(corpus(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("rows"))


_TOY = ["<unk>", "<s>", "</s>", "<pad>", "και▁", "το▁", "σπίτι▁", "σπιτι▁", "ματα▁", "ες▁", "ξε", "κατα", "βιβλίο▁", "βιβλιο▁", "ούσε▁", "α"]
_TOY_SQL = f"select unnest([{', '.join(q(p) for p in _TOY)}]) as piece"


@query(
    f"with p as ({_TOY_SQL}), w as (select distinct e from ({_EDGED}) b union select distinct {plain_sql('e')} from ({_EDGED}) b) "
    f"select class, count(*) as n, round(100.0::DOUBLE * count(*) / {len(_TOY)}, 4) as percent from (select case when starts_with(piece, '<') then 'special' "
    "when ends_with(piece, '▁') and regexp_replace(piece, '▁+$', '') in (select e from w) then 'whole' when ends_with(piece, '▁') then 'suffix' else 'prefix' end as class from p) c group by class"
)
def piece_composition(spark, sf_dir):
    """Classes of a small literal vocabulary against the words of the corpus."""
    return vocab.piece_composition(spark.createDataFrame([(p,) for p in _TOY], "piece string"), corpus(spark, sf_dir, once=False))


# Typing errors


def _first_words(spark, sf_dir):
    return corpus(spark, sf_dir, once=False).select(F.explode(T.words(F.col("line"))).alias("w")).select(T.strip_edges(F.col("w")).alias("word")).where("word <> ''").distinct()


_DISTINCT = f"select distinct e as word from ({_EDGED}) b"


@query(f"select word, {plain_sql('word')} as stripped from ({_DISTINCT}) d where {plain_sql('word')} <> word")
def accent_strip_pairs(spark, sf_dir):
    return corrupt.accent_pairs(_first_words(spark, sf_dir))


_EDGES_SQL = ", ".join(f"({q(k)}, {q(v)})" for k, vs in X.ADJACENT.items() for v in vs)


@query(
    f"select word, place, concat(substr(word, 1, place - 1), case when ch <> lower(ch) then upper(near) else near end, substr(word, place + 1)) as corrupted from "
    f"(select word, place, substr(word, place, 1) as ch from (select word, unnest(range(1, length(word) + 1)) as place from ({_DISTINCT}) d) e) f join (values {_EDGES_SQL}) as k(base, near) on lower({plain_sql('ch')}) = base"
)
def adjacency_candidates(spark, sf_dir):
    return corrupt.adjacency_candidates(_first_words(spark, sf_dir)).withColumn("place", F.col("place").cast("bigint"))


_PAIRS_SQL = ", ".join(f"({q(a)}, {q(b)})" for a, b in X.HOMOPHONES)


@query(
    f"select * from (select word, src, dst, concat(substr(word, 1, i - 1), case when substr(word, i, 1) <> lower(substr(word, i, 1)) then concat(upper(substr(dst, 1, 1)), substr(dst, 2)) else dst end, substr(word, i + length(src))) as corrupted "
    f"from (select word, src, dst, instr(lower(word), src) as i from ({_DISTINCT}) d join (values {_PAIRS_SQL}) as k(src, dst) on instr(lower(word), src) > 0) e) f where corrupted <> word"
)
def homophone_candidates(spark, sf_dir):
    return corrupt.homophone_candidates(_first_words(spark, sf_dir))


_SENTENCES = f"select concat(cast(doc_id as varchar), '-', cast(line_no as varchar), '-', source) as id, line as sentence from ({CORPUS_SQL}) c"
_TYPOS = typos_sql(f"({_SENTENCES}) sentences")


def _typos(spark, sf_dir):
    c = corpus(spark, sf_dir).select(F.concat_ws("-", "doc_id", "line_no", "source").alias("id"), "line")
    return corrupt.correction_samples(c, "id")


@query(_TYPOS)
def typo_draws(spark, sf_dir):
    """One drawn correction sample for each line."""
    return _typos(spark, sf_dir)


@query(f"select error_type, count(*) as n from ({_TYPOS}) t group by error_type")
def typo_type_counts(spark, sf_dir):
    return _typos(spark, sf_dir).groupBy("error_type").agg(F.count("*").alias("n"))


@query(
    f"select id, context, corrupted_word, target_word, error_type, full_sequence from (select *, row_number() over (partition by context, corrupted_word, target_word order by md5(concat('1337|', id)), id) as rn from ({_TYPOS}) t) u "
    "where rn = 1 order by md5(concat('1337|', id)), id limit 1000"
)
def typo_evaluation_set(spark, sf_dir):
    return corrupt.evaluation_set(written(_typos(spark, sf_dir), "typos"))


# Sequences


_IDS = "list_transform({w}, lambda w: cast(concat('0x', substr(md5(w), 1, 8))::BIGINT % 15001 + 7 as integer))"


def _packed_sql(rel: str) -> str:
    """rel: id, x (list of numbers with markers, cut), p (how many labels are masked)."""
    pad = lambda v, n: f"list_transform(range(0, 256 - {n}), lambda i: {v})"
    ids = f"list_concat(x, {pad(3, 'len(x)')})"
    mask = f"list_concat(list_transform(x, lambda i: 1), {pad(0, 'len(x)')})"
    labels = f"list_concat(list_transform(range(1, len(x) + 1), lambda i: case when i <= p then -100 else x[i] end), {pad(-100, 'len(x)')})"
    return f"select id, array_to_string({ids}, ' ') as input_ids, array_to_string({mask}, ' ') as attention_mask, array_to_string({labels}, ' ') as labels from ({rel}) r"


def _texts(df):
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), " ").alias(c)
    return df.select("id", join("input_ids"), join("attention_mask"), join("labels"))


@query(_packed_sql(f"select cast(doc_id as varchar) as id, list_slice(list_concat([1], {_IDS.format(w=words_sql('line'))}, [2]), 1, 256) as x, 0 as p from ({SOURCE_SQL['literature']}) l"))
def sequence_pack(spark, sf_dir):
    rows = source_lines(spark, sf_dir, "literature").select(F.col("doc_id").cast("string").alias("id"), sequence.toy_ids(T.words(F.col("line"))).alias("ids"))
    return _texts(sequence.pack_sequences(rows))


@query(_packed_sql(f"select concat(source, '-', cast(doc_id as varchar), '-', cast(line_no as varchar)) as id, list_slice(list_concat([1], {_IDS.format(w=words_sql('line'))}, [2]), 1, 256) as x, 0 as p from ({LINES_SQL}) l"))
def sequence_pack_lines(spark, sf_dir):
    """Training sequences of every line of all sources."""
    rows = all_lines(spark, sf_dir).select(F.concat_ws("-", "source", F.col("doc_id").cast("string"), F.col("line_no").cast("string")).alias("id"), sequence.toy_ids(T.words(F.col("line"))).alias("ids"))
    return _texts(sequence.pack_sequences(rows))


_SAMPLE_IDS = f"list_concat({_IDS.format(w=words_sql('''coalesce(context, '')'''))}, [4], {_IDS.format(w=words_sql('corrupted_word'))}, [5], {_IDS.format(w=words_sql('target_word'))}, [6])"


@query(_packed_sql(f"select id, x, coalesce(list_position(x, 5), 0) as p from (select cast(sample_id as varchar) as id, list_slice(list_concat([1], {_SAMPLE_IDS}, [2]), 1, 256) as x from (select distinct sample_id, context, corrupted_word, target_word from typo_samples) s) t"))
def label_mask(spark, sf_dir):
    """Correction prompts, labels masked up to the mark before the target."""
    s = table(spark, sf_dir, "typo_samples").select("sample_id", "context", "corrupted_word", "target_word").distinct()
    ids = lambda c: sequence.toy_ids(T.words(F.coalesce(F.col(c), F.lit(""))))
    one = lambda v: F.array(F.lit(v))
    rows = s.select(F.col("sample_id").cast("string").alias("id"), F.concat(ids("context"), one(4), ids("corrupted_word"), one(5), ids("target_word"), one(6)).alias("ids"), F.lit(True).alias("prompt"))
    return _texts(sequence.pack_sequences(rows, masked_col="prompt"))


@query(
    "select sample_id, concat(case when trim(coalesce(context, '')) <> '' then concat(trim(context), ' ') else '' end, '<XBU>', corrupted_word, '<XBC>', target_word, '<XEC>') as prompt from (select distinct sample_id, context, corrupted_word, target_word from typo_samples) s"
)
def prompts(spark, sf_dir):
    s = table(spark, sf_dir, "typo_samples").select("sample_id", "context", "corrupted_word", "target_word").distinct()
    return s.select("sample_id", T.prompt(F.col("context"), F.col("corrupted_word"), F.col("target_word")).alias("prompt"))


# Metrics


_LOGITS = "select vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) as e from embeddings"


def _top_sql(k: int, masked: int) -> str:
    return (
        f"select vec_id, rank, token, {rnd('p')} as prob from (select vec_id, token, p, row_number() over (partition by vec_id order by p desc, token) as rank from "
        f"(select vec_id, token, exp(v - top) / sum(exp(v - top)) over (partition by vec_id) as p from (select vec_id, list_max(list_slice(e, {masked + 1}, 64)) as top, unnest(list_slice(e, {masked + 1}, 64)) as v, unnest(range({masked}, 64)) as token from ({_LOGITS}) l) a) b) c where rank <= {k}"
    )


def _top(spark, sf_dir, k, masked=0):
    t = metrics.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k, masked)
    return t.select("vec_id", F.col("rank").cast("bigint").alias("rank"), F.col("token").cast("bigint").alias("token"), F.round("prob", 6).alias("prob"))


@query(_top_sql(5, 0))
def softmax_top5(spark, sf_dir):
    return _top(spark, sf_dir, 5)


@query(_top_sql(5, 7))
def masked_predictions(spark, sf_dir):
    """The likeliest tokens, special ones left out."""
    return _top(spark, sf_dir, 5, 7)


@query(f"select vec_id, array_to_string(list_transform(list_sort(list(rank * 100 + token)), lambda x: x % 100), ' ') as bar from ({_top_sql(3, 7)}) t group by vec_id")
def suggestion_bar(spark, sf_dir):
    s = metrics.suggestions(_top(spark, sf_dir, 5, 7), "vec_id")
    return s.select("vec_id", F.array_join(F.transform("tokens", lambda x: x.cast("string")), " ").alias("bar"))


@query("select vec_id, list_position(embedding, list_max(embedding)) - 1 as token from embeddings")
def argmax_tokens(spark, sf_dir):
    return metrics.argmax(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").select("vec_id", F.col("token").cast("integer").alias("token"))


@query(
    "select count(*) as test_tokens, round(avg(loss), 6) as cross_entropy_loss, "
    + ", ".join(f"round(avg(cast(rank <= {k} as integer)), 6) as top{k}_acc" for k in (1, 3, 5, 10))
    + ", round(exp(least(avg(loss), 20)), 5) as perplexity from (select vec_id, sum(cast(v > t or (v = t and token < label) as integer)) + 1 as rank, ln(sum(exp(v))) - max(t) as loss "
    f"from (select vec_id, label, e[label + 1] as t, unnest(e) as v, unnest(range(0, 64)) as token from ({_LOGITS}) l) a group by vec_id) b"
)
def topk_hit_rates(spark, sf_dir):
    r = metrics.hit_rates(table(spark, sf_dir, "embeddings"), "embedding", "label")
    return r.select("test_tokens", *[F.round(c, 6).alias(c) for c in ("cross_entropy_loss", "top1_acc", "top3_acc", "top5_acc", "top10_acc")], F.round("perplexity", 5).alias("perplexity"))


_SAMPLES = "select distinct sample_id, error_type, corrupted_word, target_word from typo_samples"


@query(f"select error_type, count(*) as total_tested, sum(cast(coalesce(corrupted_word = target_word, false) as bigint))::BIGINT as correct, {rnd('avg(cast(coalesce(corrupted_word = target_word, false) as integer))')} as accuracy from ({_SAMPLES}) s group by rollup(error_type)")
def accuracy_rollup(spark, sf_dir):
    """Accuracy by kind of error of a predictor that changes nothing."""
    s = table(spark, sf_dir, "typo_samples").select("sample_id", "error_type", "corrupted_word", "target_word").distinct()
    return metrics.accuracy_rollup(s, "corrupted_word", "target_word", "error_type").withColumn("accuracy", F.round("accuracy", 6))


@query(f"select count(*) as samples_evaluated, {rnd('avg(cast(coalesce(lower(corrupted_word) = lower(target_word), false) as integer))')} as accent_accuracy, avg(cast(coalesce(lower(corrupted_word) = lower(target_word), false) as integer)) >= 0.95 as target_met from ({_SAMPLES}) s where {plain_sql('target_word')} <> target_word")
def accent_restoration(spark, sf_dir):
    s = table(spark, sf_dir, "typo_samples").select("sample_id", "error_type", "corrupted_word", "target_word").distinct()
    return metrics.accent_restoration(s, "corrupted_word", "target_word").withColumn("accent_accuracy", F.round("accent_accuracy", 6))


@query("select count(*) as batches, round(avg(m), 6) as loss, round(exp(least(avg(m), 20)), 4) as perplexity from (select user_id, avg(value) as m from events group by user_id) a where m is not null and not isnan(m)")
def val_loss_mean_of_means(spark, sf_dir):
    """Mean of batch means over the events of users."""
    r = metrics.validation_loss(table(spark, sf_dir, "events"), "user_id", "value")
    return r.select("batches", F.round("loss", 6).alias("loss"), F.round("perplexity", 4).alias("perplexity"))


@query("select event_type, round(avg(value), 6) as mean_loss, count(*) as steps from events group by event_type")
def epoch_mean_loss(spark, sf_dir):
    return metrics.epoch_loss(table(spark, sf_dir, "events"), "event_type", "value").withColumn("mean_loss", F.round("mean_loss", 6))


# Logs


_LOG = "select distinct log_id, run_key, text from training_log where text is not null"
_P_SQL = logs.PROGRESS.replace("\\-", "-").replace("[0-9.e-+]", "[0-9.e+-]")


def _points_sql(pattern: str, names: tuple[str, str, str]) -> str:
    parts = [f"unnest(regexp_extract_all(text, {q(pattern)}, {i})) as c{i}" for i in (1, 2, 3)]
    a, b, c = names
    return f"select log_id, run_key, nth, c1::BIGINT as {a}, try_cast(c2 as double) as {b}, try_cast(c3 as double) as {c} from (select log_id, run_key, unnest(range(1, len(regexp_extract_all(text, {q(pattern)})) + 1)) as nth, {', '.join(parts)} from ({_LOG}) l) m"


_PROGRESS = _points_sql(_P_SQL, ("step", "loss", "lr"))


def _log(spark, sf_dir):
    return table(spark, sf_dir, "training_log").select("log_id", "run_key", "text").distinct()


def _progress(spark, sf_dir):
    return logs.progress_points(_log(spark, sf_dir), ["log_id", "run_key"]).withColumn("nth", F.col("nth").cast("bigint"))


@query(_PROGRESS)
def log_points(spark, sf_dir):
    return _progress(spark, sf_dir)


_VALIDATION = _points_sql(logs.VALIDATION, ("step", "loss", "ppl"))


def _validation(spark, sf_dir):
    return logs.validation_points(_log(spark, sf_dir), ["log_id", "run_key"]).withColumn("nth", F.col("nth").cast("bigint"))


@query(_VALIDATION)
def validation_points(spark, sf_dir):
    return _validation(spark, sf_dir)


@query(
    f"select log_id, run_key, step, loss, round(case when n < 10 then loss when i < 10 then first else mean end, 6) as smooth from (select *, row_number() over w as i, count(*) over (partition by run_key) as n, "
    f"first_value(loss) over w as first, avg(loss) over (partition by run_key order by log_id, nth rows between 9 preceding and current row) as mean from ({_PROGRESS}) p window w as (partition by run_key order by log_id, nth)) x"
)
def smoothed_loss(spark, sf_dir):
    r = logs.moving_average(_progress(spark, sf_dir), "run_key", ["log_id", "nth"], "loss")
    return r.select("log_id", "run_key", "step", "loss", F.round("smooth", 6).alias("smooth"))


@query(
    f"select log_id, run_key, step, loss from (select *, min(loss) over (partition by run_key order by log_id, nth rows between unbounded preceding and 1 preceding) as b from ({_VALIDATION}) v) x where b is null or loss < b"
)
def best_checkpoint(spark, sf_dir):
    return logs.best_checkpoints(_validation(spark, sf_dir), "run_key", ["log_id", "nth"], "loss").select("log_id", "run_key", "step", "loss")


@query(f"select run_key, arg_min(loss, log_id) as initial, min(loss) as lowest, max(loss) as highest, arg_max(loss, log_id) as current, count(*) as points from ({_PROGRESS}) p group by run_key")
def loss_summary(spark, sf_dir):
    return logs.loss_summary(_progress(spark, sf_dir), "run_key", "log_id", "loss")


@query(f"select log_id, run_key, step from ({_PROGRESS}) p where step % 50 = 0")
def eval_steps(spark, sf_dir):
    return logs.every(_progress(spark, sf_dir), "step", 50).select("log_id", "run_key", "step")


# Model catalogues


def _tensor_rows() -> list[tuple[str, list[int]]]:
    rows = [("model.embed_tokens.weight", [15008, 512]), ("model.norm.weight", [512])]
    for i in range(9):
        p = f"model.layers.{i}."
        rows += [(p + f"self_attn.{x}_proj.weight", [512, 512]) for x in "qkvo"]
        rows += [(p + f"mlp.{x}_proj.weight", s) for x, s in (("gate", [1376, 512]), ("up", [1376, 512]), ("down", [512, 1376]))]
        rows += [(p + x, [512]) for x in ("input_layernorm.weight", "post_attention_layernorm.weight")]
    return rows


_TENSORS = "(values " + ", ".join(f"({q(n)}, {s})" for n, s in _tensor_rows()) + ") as t(name, shape)"
_LAYER = "regexp_extract(name, '^model\\.layers\\.([^.]*)\\.(.*)$', {i})"
_NAME = (
    "case " + " ".join(f"when name = {q(a)} then {q(b)}" for a, b in X.TENSORS.items())
    + " " + " ".join(f"when {_LAYER.format(i=2)} = {q(a)} then concat('blk.', {_LAYER.format(i=1)}, '.{b}')" for a, b in X.LAYER_TENSORS.items()) + " else name end"
)


@query(f"select name, {_NAME} as export_name from {_TENSORS}")
def tensor_names(spark, sf_dir):
    return model_meta.export_names(model_meta.tensor_catalogue(spark)).select("name", "export_name")


@query(f"select case when contains({_NAME}, 'norm') then 'f32' else 'f16' end as dtype, count(*) as tensors from {_TENSORS} group by 1")
def dtype_hist(spark, sf_dir):
    return model_meta.dtype_histogram(model_meta.tensor_catalogue(spark))


@query(f"select case when regexp_matches(name, {q(X.UNDECAYED)}) then 'no_decay' else 'decay' end as decay_group, count(*) as tensors from {_TENSORS} group by 1")
def decay_groups(spark, sf_dir):
    return model_meta.tensor_catalogue(spark).groupBy(model_meta.decay_group(F.col("name")).alias("decay_group")).agg(F.count("*").alias("tensors"))


@query(f"select sum(case when len(shape) = 2 then shape[1] * shape[2] else shape[1] end)::BIGINT as total, sum(case when len(shape) = 2 then shape[1] * shape[2] else shape[1] end)::BIGINT as trainable from {_TENSORS}")
def param_count(spark, sf_dir):
    return model_meta.parameter_count(model_meta.tensor_catalogue(spark))


_PIECES = [("<unk>", "unknown"), ("<s>", "control"), ("</s>", "control"), ("<pad>", "control"), ("<XBU>", "normal"), ("<XBC>", "normal"), ("<XEC>", "normal"), ("<0x41>", "byte"), ("▁και", "normal"), ("<old>", "unused")]


@query(
    "select piece, case when kind = 'unknown' then 'UNKNOWN' when kind = 'control' then 'CONTROL' when kind = 'unused' then 'UNUSED' when kind = 'byte' then 'BYTE' when piece in ('<XBU>', '<XBC>', '<XEC>') then 'USER_DEFINED' else 'NORMAL' end as token_type from (values "
    + ", ".join(f"({q(a)}, {q(b)})" for a, b in _PIECES) + ") as p(piece, kind)"
)
def token_types(spark, sf_dir):
    p = spark.createDataFrame(_PIECES, "piece string, kind string")
    return p.select("piece", model_meta.token_type(F.col("piece"), F.col("kind")).alias("token_type"))


@query("select s as step, round(0.0005 * case when s < 500 then s / 500.0 else greatest(0, 0.5 * (1 + cos(pi() * (s - 500) / 5500.0))) end, 10)::DOUBLE as lr from (select unnest(range(0, 6000)) as s) a")
def lr_schedule(spark, sf_dir):
    return model_meta.learning_rates(spark, 2000, 6).withColumn("lr", F.round("lr", 10))


@query("select error_type, count(*) as n, count(distinct target_word) as words from typo_samples group by error_type")
def read_samples_by_type(spark, sf_dir):
    """The correction benchmark by kind of error."""
    return table(spark, sf_dir, "typo_samples").groupBy("error_type").agg(F.count("*").alias("n"), F.countDistinct("target_word").alias("words"))


@query(f"select source, doc_id, line_no, line from ({CORPUS_SQL}) c order by priority, doc_id, line_no limit 500")
def first_lines(spark, sf_dir):
    """The first 500 lines in order of arrival."""
    return corpus(spark, sf_dir).orderBy(*ORDER).limit(500).select("source", "doc_id", "line_no", "line")


_MANIFEST = '{"name": "catalogue", "version": 1, "models": [{"id": "small", "quantization": "Q6", "filesize_bytes": 22, "features": ["base", "correction"]}, {"id": "large", "quantization": "Q8", "filesize_bytes": 27, "features": ["base"]}]}'


@query("select * from (values ('catalogue', 1, 'small', 'Q6', 22::BIGINT, 2), ('catalogue', 1, 'large', 'Q8', 27::BIGINT, 1)) as m(catalogue, version, id, quantization, filesize_bytes, features)")
def manifest_models(spark, sf_dir):
    """Models of a nested manifest."""
    schema = "name string, version int, models array<struct<id: string, quantization: string, filesize_bytes: bigint, features: array<string>>>"
    m = spark.createDataFrame([(_MANIFEST,)], "j string").select(F.from_json("j", schema).alias("m")).select(F.col("m.name").alias("catalogue"), "m.version", F.explode("m.models").alias("x"))
    return m.select("catalogue", "version", "x.id", "x.quantization", "x.filesize_bytes", F.size("x.features").alias("features"))


_USE, _PLAIN = int(0.30 * 2**32), int(0.35 * 2**32)


@query(
    f"with t as ({_TYPOS}), l as (select id, sentence as line, concat('0x', substr(md5(concat('42-', id, '|use')), 1, 8))::BIGINT as u, concat('0x', substr(md5(concat('42-', id, '|plain')), 1, 8))::BIGINT as p from ({_SENTENCES}) s) "
    f"select l.id, case when u < {_USE} and full_sequence is not null then full_sequence when u >= {_USE} and p < {_PLAIN} then {plain_sql('line')} else line end as text, u < {_USE} and full_sequence is not null as is_prompt from l left join t on l.id = t.id"
)
def training_texts(spark, sf_dir):
    """What each line is trained on: a correction prompt, the plain line, or the line."""
    c = corpus(spark, sf_dir).select(F.concat_ws("-", "doc_id", "line_no", "source").alias("id"), "line")
    return sequence.training_text(c, corrupt.correction_samples(c, "id"), "id")
