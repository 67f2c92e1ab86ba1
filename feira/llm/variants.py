"""Spelling variants: words one edit apart by a sorted permuterm index, and the form each stands for."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.tables import stored

# Words are shorter or rarer than this no more.
LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form is so many times as frequent as the word.
RATIO = 5
# One run in so many loses a code point.
ODDS = 199
# Different words that a task remembers before it hands on their counts.
REMEMBERED = 400_000
# Texts beyond this many bytes are searched piece by piece.
PIECE = 4 << 20
# No word holds it.
END = "$"

# A run of A-Z, a-z and U+00C0 to U+00FF in UTF-8, and a byte that no run holds.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
APART = re.compile(rb"[\x00-@\[-`{-\x7f]")


def pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces that cut no run."""
    begin = 0
    while len(text) - begin > PIECE:
        cut = APART.search(text, begin + PIECE)
        end = cut.start() if cut else len(text)
        yield text[begin:end]
        begin = end
    yield text[begin:]


def misspelt(run: bytes, checksum: int) -> bytes:
    """The run, or the run without one code point if the checksum says so."""
    if checksum % ODDS:
        return run
    letters = run.decode()
    at = checksum % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(found: Counter) -> pa.RecordBatch:
        words = pa.array(list(found), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

    found: Counter = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            if not text.is_valid:
                continue
            begin = zlib.crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
            # bytes.lower changes A-Z only.
            for piece in pieces(text.as_py().encode()):
                for run, n in Counter(RUN.findall(piece.lower())).items():
                    if len(run) >= LEAST_LENGTH:
                        found[misspelt(run, zlib.crc32(run, begin))] += n
            if len(found) > REMEMBERED:
                yield out(found)
                found = Counter()
    yield out(found)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words long and frequent enough.

    The counts are added up in each task before they are dealt by word.
    """
    return (
        docs.select("doc_id", "text")
        .mapInArrow(_counts, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter((F.char_length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))
    )


def rotations(words: DataFrame) -> DataFrame:
    """(key, exact, indel, word, n): the rotations of `word` and END, as `key` and, if not exact, a last character.

    Words that are `key` and one more character differ by a replacement. A word that is exactly `key`
    is one of them without that character. `indel` marks the first of equal characters in a row, so that taking
    out any one of them counts once.
    """
    at = F.sequence(F.lit(0), F.char_length("word"))

    def head(i: Column) -> Column:
        return F.substring("word", F.lit(1), i)

    def tail(i: Column) -> Column:
        return F.substring("word", i + 1, F.char_length("word"))

    def entry(key: Column, exact: bool, indel: Column) -> Column:
        return F.struct(key.alias("key"), F.lit(exact).alias("exact"), indel.alias("indel"))

    whole = F.transform(at, lambda i: entry(F.concat(tail(i), F.lit(END), head(i)), True, F.lit(False)))
    skipping = F.transform(
        F.slice(at, 1, F.char_length("word")),
        lambda i: entry(
            F.concat(tail(i + 1), F.lit(END), head(i)),
            False,
            (i == 0) | (F.substring("word", i, F.lit(1)) != F.substring("word", i + 1, F.lit(1))),
        ),
    )
    return words.select(F.explode(F.concat(whole, skipping)).alias("r"), "word", "n").select("r.*", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of words that have near ones; best is (-n, word) of the most frequent, then least.

    The rotations are sorted in ranges of keys; a scan over each key's rows tells every one how many near words
    it meets there and the best of them, so no pairs are formed. A key has one row for each letter
    of the alphabet at most, and one exact.
    """
    index = rotations(words).repartitionByRange("key")
    rank = F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"))
    scan = Window.partitionBy("key").orderBy("exact", F.desc("n"), "word")
    range_ = scan.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scanned = index.select(
        "word",
        "exact",
        "indel",
        F.count_if(~F.col("exact")).over(range_).alias("replaced"),
        F.count_if("indel").over(range_).alias("longer"),
        F.first(rank).over(range_).alias("first"),
        F.nth_value(rank, 2).over(range_).alias("second"),
        F.first(F.when(F.col("indel"), rank), ignorenulls=True).over(range_).alias("first_longer"),
        F.max(F.when(F.col("exact"), rank)).over(range_).alias("shorter"),
    )
    # Exact rows come last, so the first two are replacements if there are two.
    other = F.when(F.col("first.word") == F.col("word"), F.when(F.col("replaced") > 1, F.col("second"))).otherwise(
        F.col("first")
    )
    shorter = F.when(F.col("indel"), F.col("shorter"))
    met = scanned.select(
        "word",
        F.when(F.col("exact"), F.col("longer"))
        .otherwise(F.col("replaced") - 1 + shorter.isNotNull().cast("int"))
        .alias("n_near"),
        F.when(F.col("exact"), F.col("first_longer")).otherwise(F.least(other, shorter)).alias("best"),
    )
    return met.filter("n_near > 0").groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of (word, form) that have one: the last form reached.

    Each round doubles the length of the way behind a word. Forms are at least RATIO times as frequent
    as their words, so no way leads back, and its length is bounded by the logarithm of the counts.
    """
    ways = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "variant-roots")
    while not ways.filter("moved").isEmpty():
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = stored(
            ways.join(on, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "variant-roots",
        )
    return ways.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word long and frequent enough.

    A NULL or empty text has no words. A NULL id counts as empty in the checksum. Repeated documents are
    counted as often as they stand; of near words with equal counts the least in code-point order is taken. Other
    columns are not read. A table without words gives no rows.
    """
    words = stored(word_counts(docs), "variant-words")
    near = neighbours(words)
    form_n = -F.col("best.less")
    known = stored(
        words.join(near, "word", "left")
        .withColumn("far", form_n >= RATIO * F.col("n"))
        .select(
            "word",
            F.when(F.col("far"), F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("far"), form_n).alias("form_n"),
        ),
        "variant-forms",
    )
    ends = roots(known.filter("form IS NOT NULL"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


# The same in DuckDB, from all pairs that agree but for one place.
ORACLE = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
),
counted AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM runs WHERE length(run) >= 6 GROUP BY ALL
),
bytes AS (
  SELECT *, hex(concat(doc_id, ':', run)) AS h FROM counted
),
sums AS (
  SELECT run, c, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i:
      (strpos('0123456789ABCDEF', h[2 * i + 1]) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 17)::BIGINT)),
    lambda a, b: list_reduce(
      list_prepend(xor(a, b), range(8)), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)
  )) AS crc FROM bytes
),
words AS (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT c, CASE WHEN crc % 199 = 0
      THEN concat(left(run, (crc % length(run))::INTEGER), substr(run, (crc % length(run))::INTEGER + 2)) ELSE run END AS word
    FROM sums) AS s
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
),
holes AS (
  SELECT word, n, left(word, i::INTEGER) AS l, substr(word, i::INTEGER + 2) AS r
  FROM (SELECT *, unnest(range(length(word))) AS i FROM words) AS p
),
shorter AS (SELECT DISTINCT h.word AS long, w.word AS short FROM holes AS h JOIN words AS w ON w.word = concat(h.l, h.r)),
pairs AS (
  SELECT a.word, b.word AS other FROM holes AS a JOIN holes AS b ON a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION ALL SELECT long, short FROM shorter
  UNION ALL SELECT short, long FROM shorter
),
best AS (
  SELECT p.word, count(*) AS n_near, max(o.n) AS most, arg_min(o.word, {'a': -o.n, 'b': encode(o.word)}) AS other
  FROM pairs AS p JOIN words AS o ON o.word = p.other GROUP BY p.word
),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.most >= 5 * w.n THEN b.other END AS form,
    CASE WHEN b.most >= 5 * w.n THEN b.most END AS form_n
  FROM words AS w LEFT JOIN best AS b ON b.word = w.word
),
ways AS (
  SELECT word, word AS root, form FROM forms
  UNION ALL
  SELECT y.word, f.word, f.form FROM ways AS y JOIN forms AS f ON f.word = y.form
)
SELECT f.word, f.form, y.root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM forms AS f JOIN ways AS y ON y.word = f.word AND y.form IS NULL"""
