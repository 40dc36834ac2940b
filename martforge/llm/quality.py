"""Quality rules: a table of thresholds compiled into one Spark projection.

Every figure is an expression over one row; nothing is shuffled and no user
function runs.  Repeated three-word windows are found by counting distinct
window hashes; only a text that has some is looked at again, by sorting its
windows and walking over the places where equal ones stand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martforge.llm import words as W
from martforge.llm.common import SPACE, read

SYMBOLS = "#*$%&|<>"
#: fixed values: frequent short words of English, German, French and Spanish
STOP_WORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "was", "for", "on", "with", "be", "this", "are", "as", "at", "by", "or",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "ist", "im", "für", "ein", "eine", "nicht", "auf", "dem", "des",
    "le", "la", "les", "de", "et", "un", "une", "est", "que", "qui", "dans", "pour", "en", "du", "il", "pas", "sur", "au",
    "el", "los", "las", "y", "del", "se", "con", "por", "una", "su", "al", "es", "lo", "como",
]
#: (measure, smallest, largest): a text passes if every measure lies within its bounds (None: open)
RULES: list[tuple[str, float | None, float | None]] = [
    ("n_words", 50, None),
    ("mean_word_chars", 2.5, 10),
    ("symbols_per_word", None, 0.1),
    ("marks_per_word", None, 0.5),
    ("stop_word_share", 0.03, None),
    ("dup_line_share", None, 0.5),
    ("bullet_line_share", None, 0.9),
    ("repeat_word_share", None, 0.5),
]


def _repeated(words: Column) -> Column:
    """Words that lie in a three-word window that stands twice or more (all its places count)."""
    def places(t: Column) -> Column:
        rows = F.array_sort(F.transform(t, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def same(r: Column) -> Column:
            twice = lambda x, k: (F.get(r, k - 1)["h"] == x["h"]) | (F.get(r, k + 1)["h"] == x["h"])
            return F.array_sort(F.transform(F.filter(r, lambda x, k: F.coalesce(twice(x, k), F.lit(False))), lambda x: x["i"]))
        return W.let(rows, same)

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - s, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def count(t: Column) -> Column:
        none = F.size(t) == F.size(F.array_distinct(t))
        return F.when(none, F.lit(0).cast("long")).otherwise(W.let(places(t), covered))

    return W.let(W.gram_hashes(words, 3), count)


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The given columns' doc_id with every measure the rules may name."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    bullets = lambda a: F.size(F.filter(a, lambda x: x.rlike("^[ \t]*([-*•]|[0-9]+[.)]) ")))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        W.let(W.plain_words(t), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stop"))).alias("w"),
        _count(t, SYMBOLS).cast("long").alias("n_symbols"),
        _count(t, "!").cast("long").alias("n_marks"),
        W.let(lines, lambda a: F.struct(F.size(a).alias("n"), (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("dup"),
                                        bullets(a).alias("bullets"))).alias("l"))
    return counted.select(
        "doc_id", "w.n_words", "w.word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), "w.n_repeat_words",
        share(F.col("w.word_chars"), F.col("w.n_words")).alias("mean_word_chars"),
        share(F.col("n_symbols"), F.col("w.n_words")).alias("symbols_per_word"),
        share(F.col("n_marks"), F.col("w.n_words")).alias("marks_per_word"),
        share(F.col("w.n_stop"), F.col("w.n_words")).alias("stop_word_share"),
        share(F.col("l.dup"), F.col("l.n")).alias("dup_line_share"),
        share(F.col("l.bullets"), F.col("l.n")).alias("bullet_line_share"),
        share(F.col("w.n_repeat_words"), F.col("w.n_words")).alias("repeat_word_share"))


def compile_rules(rules: list[tuple[str, float | None, float | None]] = RULES) -> Column:
    """One boolean expression from the table of thresholds."""
    parts = [F.col(m) >= F.lit(lo) for m, lo, _ in rules if lo is not None] + [F.col(m) <= F.lit(hi) for m, _, hi in rules if hi is not None]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def judge(docs: DataFrame, rules: list[tuple[str, float | None, float | None]] = RULES) -> DataFrame:
    """Per document: (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    Null and empty texts have no words and fail; ties, repeated rows and extra
    columns have no effect, every row is judged by its own text."""
    m = measures(docs)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return m.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & compile_rules(rules)).alias("kept"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"))


def _sql_rules() -> str:
    parts = [f"{m} >= {lo}" for m, lo, _ in RULES if lo is not None] + [f"{m} <= {hi}" for m, _, hi in RULES if hi is not None]
    return " AND ".join(parts)


ORACLE = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
d AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT doc_id, s, w[s:s + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS s FROM d)),
r AS (SELECT doc_id, unnest(list(s)) AS s FROM g GROUP BY doc_id, g HAVING count(*) >= 2),
n AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([s, s + 1, s + 2]) AS p FROM r) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(n.n, 0) AS n_repeat_words, length(t) - length(replace(t, '!', '')) AS n_marks,
             len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}))) AS n_stop,
             len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*([-*•]|[0-9]+[.)]) '))) AS bullets, len(l) AS n_lines
      FROM d LEFT JOIN n ON n.doc_id = d.doc_id),
f AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
             CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
             CASE WHEN n_words > 0 THEN n_marks / n_words ELSE 0 END AS marks_per_word,
             CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_word_share,
             CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
             CASE WHEN n_lines > 0 THEN bullets / n_lines ELSE 0 END AS bullet_line_share,
             CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_word_share,
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND {_sql_rules()} AS kept
FROM f
"""
