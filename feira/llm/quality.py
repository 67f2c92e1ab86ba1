"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.llm.tables import with_results, words

# Frequent function words of the four languages of the documents.
STOP_WORDS = (
    "the of and to in is that it for with was on are as by be this have or an "
    "le la les de des du un une et en que qui dans pour par sur est "
    "der die das und zu den von mit ist nicht ein eine auf für im dem "
    "el los las y del una por con para es se lo al"
).split()


@dataclass(frozen=True)
class Rule:
    """`low` <= 1000 * measure / base <= `high`, in whole numbers; no bound where None."""

    name: str
    measure: str
    base: str | None = None
    low: int | None = None
    high: int | None = None

    def holds(self, value=F.col) -> Column:
        measured = value(self.measure)
        scale = F.lit(1)
        if self.base is not None:
            measured, scale = measured * 1000, value(self.base)
        bounds = []
        if self.low is not None:
            bounds.append(measured >= scale * self.low)
        if self.high is not None:
            bounds.append(measured <= scale * self.high)
        return reduce(Column.__and__, bounds, F.lit(True))


# The base rules reject short texts and texts that repeat themselves.
BASE_RULES = (
    Rule("enough_words", "n_words", low=50),
    Rule("few_repeats", "n_repeat_words", "n_words", high=500),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2000, high=12000),
    Rule("few_symbols", "n_symbols", "n_words", high=100),
    Rule("stop_words", "n_stop_words", "n_words", low=50),
    Rule("few_shouted_words", "n_shouted_words", "n_words", high=300),
    Rule("few_equal_lines", "n_dup_lines", "n_lines", high=500),
)
# What the rules may measure; the results keep their names.
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_stop_words",
    "n_shouted_words",
)


def _pick(array: Column, position: Column) -> Column:
    return F.get(array, position)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of `docs` in a struct `row`, and the measures as long columns.

    Each step is a projection of its own, so that arrays used more than once are built once.
    A three-word window stands for itself by a 64-bit hash, compared inside one text only.
    """
    split = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("whole"),
    ).select("row", "whole", words(F.col("whole")).alias("words"))
    ws = F.col("words")

    def window(i: Column) -> Column:
        key = F.xxhash64(_pick(ws, i), _pick(ws, i + 1), _pick(ws, i + 2))
        return F.struct(key.alias("key"), i.alias("at"))

    last = F.size(ws) - 3
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    lines = F.filter(
        F.split(F.col("whole"), "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    )
    read = split.select(
        "row",
        "words",
        "whole",
        lines.alias("lines"),
        F.sort_array(F.transform(starts, window)).alias("windows"),
    )
    windows = F.col("windows")
    repeated = F.filter(
        windows,
        lambda w, i: F.coalesce(_pick(windows, i + 1)["key"] == w["key"], F.lit(False))
        | F.coalesce(_pick(windows, i - 1)["key"] == w["key"], F.lit(False)),
    )
    counted = read.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("whole", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.transform(repeated, lambda w: w["at"])).alias("starts"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS)))
        .cast("long")
        .alias("n_stop_words"),
        F.size(F.filter("words", lambda w: w.rlike(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$")))
        .cast("long")
        .alias("n_shouted_words"),
    )
    at = F.col("starts")
    # A window covers three words, less those that the next repeated window covers too.
    covered = F.aggregate(
        F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(_pick(at, i + 1) - p, F.lit(3)))),
        F.lit(0),
        lambda total, n: total + n,
    )
    return counted.withColumn("n_repeat_words", covered.cast("long")).drop("starts")


def compiled(rules: Sequence[Rule]) -> Column:
    """True where every rule holds."""
    return reduce(Column.__and__, [rule.holds() for rule in rules], F.lit(True))


def judged(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    base: Sequence[Rule] = BASE_RULES,
    text: str = "text",
) -> DataFrame:
    """Every row of `docs` with its measures, `base_failed` and `kept`; a result replaces an input
    column of its name.

    A NULL or empty text has no words and fails the base rules. Repeated rows are judged alike, each
    for itself; no row is looked at together with another, so nothing is shuffled. Rows with NULL in
    other columns, and tables without rows, pass through. To keep the good rows alone use
    `filter_quality`, not a filter on `kept`: Spark would write the measures out at every use.
    """
    found = measures(docs, text).withColumn("base_failed", ~compiled(base))
    found = found.withColumn("kept", ~F.col("base_failed") & compiled(rules))
    results = {name: F.col(name) for name in (*MEASURES, "base_failed", "kept")}
    taken = {name.lower() for name in results}
    rest = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in taken]
    return found.select(*rest, *[column.alias(name) for name, column in results.items()])


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` whose text passes all rules, with their columns unchanged.

    The row number in the test keeps Spark from moving it below the projections, where each measure would be
    written out in full, arrays and all, at every place that uses it.
    """
    numbered = measures(docs, text).withColumn("number", F.monotonically_increasing_id())
    found = numbered.filter(compiled((*BASE_RULES, *RULES)) & (F.col("number") >= 0))
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def sql_of(rules: Sequence[Rule]) -> str:
    """The same test as SQL text."""
    parts = []
    for rule in rules:
        measured, scale = (rule.measure, "1") if rule.base is None else (f"{rule.measure} * 1000", rule.base)
        if rule.low is not None:
            parts.append(f"{measured} >= {rule.low} * {scale}")
        if rule.high is not None:
            parts.append(f"{measured} <= {rule.high} * {scale}")
    return " AND ".join(parts) or "true"


_LISTED = ", ".join(f"'{word}'" for word in STOP_WORDS)
MEASURES_SQL = rf"""
split_docs AS (
  SELECT doc_id, coalesce(text, '') AS whole,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM {{documents}}
),
starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM split_docs
),
repeated AS (
  SELECT doc_id, i FROM starts
  QUALIFY count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) >= 2
),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) AS places
  GROUP BY doc_id
),
line_counts AS (
  SELECT doc_id, count(*) AS n_lines, count(DISTINCT line) AS n_unlike
  FROM (SELECT doc_id, unnest(string_split(whole, chr(10))) AS line FROM split_docs) AS lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY doc_id
),
word_counts AS (
  SELECT doc_id, sum(length(w)) AS word_chars,
         count(*) FILTER (WHERE lower(w) IN ({_LISTED})) AS n_stop_words,
         count(*) FILTER (WHERE regexp_matches(w, '^[^\p{{{{Ll}}}}]*\p{{{{Lu}}}}[^\p{{{{Ll}}}}]*\p{{{{Lu}}}}[^\p{{{{Ll}}}}]*$'))
           AS n_shouted_words
  FROM (SELECT doc_id, unnest(ws) AS w FROM split_docs) AS single_words
  GROUP BY doc_id
),
measured AS (
  SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(c.word_chars, 0)::BIGINT AS word_chars,
         (length(d.whole) - length(translate(d.whole, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(l.n_lines, 0)::BIGINT AS n_lines,
         coalesce(l.n_lines - l.n_unlike, 0)::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         coalesce(c.n_stop_words, 0)::BIGINT AS n_stop_words,
         coalesce(c.n_shouted_words, 0)::BIGINT AS n_shouted_words
  FROM split_docs AS d
  LEFT JOIN covered AS r USING (doc_id)
  LEFT JOIN line_counts AS l USING (doc_id)
  LEFT JOIN word_counts AS c USING (doc_id)
)"""
ORACLE = f"""
WITH {MEASURES_SQL.format(documents="documents")}
SELECT *, NOT ({sql_of(BASE_RULES)}) AS base_failed,
       ({sql_of(BASE_RULES)}) AND ({sql_of(RULES)}) AS kept
FROM measured"""
