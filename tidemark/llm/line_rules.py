"""Quality rules by cross-document line frequency (operator 2). DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stage import staged

SYMBOLS = "[#*$%&|<>]"
#: A line is boilerplate of its host if more than so many documents hold it, and more than so many in a thousand.
MOST_DOCS, MOST_PER_MILLE = 10, 1
#: A document is depleted if less than this share of the words in its distinct lines is left.
LEAST_LEFT_PERCENT = 30


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once for each row, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    """Words of a text: white space is brought to one kind first, so that the split is by a plain character."""
    spaced = F.when(text.rlike(r"[\t\x0B\f\r]"), F.regexp_replace(text, r"[\t\x0B\f\r]", " ")).otherwise(text)
    return F.array_remove(F.split(F.replace(spaced, F.lit("\n"), F.lit(" ")), " "), "")


def _windows(words: Column) -> Column:
    """Hashes of the three-word windows, in order."""
    each = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) > 3, F.slice(each, F.lit(1), F.size(words) - 2)).otherwise(F.array().cast("array<bigint>"))


def _repeat_words(windows: Column) -> Column:
    """Words inside windows that occur at least twice: equal hashes meet by sorting (hash, place).

    Most texts have no equal windows, which a hash set tells without the sort.
    """

    def places(found: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(found, a)["h"] == F.get(found, b)["h"], F.lit(False))
        repeated = F.filter(F.transform(found, lambda x, j: F.when(same(j, j - 1) | same(j, j + 1), x["i"])), lambda i: i.isNotNull())
        return F.sort_array(repeated)

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, s: total + s)

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    unequal = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(unequal, F.lit(0).cast("long")).otherwise(let(ordered, lambda s: let(places(s), covered)))


def with_text_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; a null text has none of anything."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.withColumn("_words", _words(text)).withColumn("_windows", _windows(F.col("_words")))
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeat_words(F.col("_windows")),
    }
    return split.withColumns({name: value.cast("long") for name, value in counts.items()}).drop("_words", "_windows")


def normal_lines(text: Column) -> Column:
    """Lines in lower case with digits as 0 and runs of white space as one space; empty ones left out."""
    low = F.lower(F.coalesce(text, F.lit("")))
    digits = F.when(low.rlike("[1-9]"), F.regexp_replace(low, "[1-9]", "0")).otherwise(low)
    flat = F.when(digits.rlike(r"[\t\x0B\f\r]|  "), F.regexp_replace(digits, r"[ \t\x0B\f\r]+", " ")).otherwise(digits)
    return F.filter(F.transform(F.split(flat, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, row, first, host_key, key, n_words) for the distinct normal lines of each row; the key is a hash of host and line.

    ``row`` tells rows of one doc_id apart by host and text; equal rows are told by ``first``, which each row has once.
    """
    spaces = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))
    line = lambda x: F.struct(F.xxhash64(F.col("host"), x).alias("key"), (spaces(x) + 1).cast("long").alias("n_words"))
    found = F.posexplode(F.array_distinct(F.transform(normal_lines(F.col("text")), line))).alias("place", "line")
    return docs.select("doc_id", "row", F.xxhash64("host").alias("host_key"), found).select("doc_id", "row", (F.col("place") == 0).alias("first"), "host_key", "line.*")


def frequent_lines(lines: DataFrame, docs: DataFrame, most_docs: int, most_per_mille: int) -> DataFrame:
    """Keys of the lines that more than ``most_docs`` and ``most_per_mille`` of the host's documents hold."""
    counts = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("host_key").alias("host_key")).where(F.col("n_docs") > most_docs)
    sizes = docs.groupBy(F.xxhash64("host").alias("host_key")).agg(F.count(F.lit(1)).alias("host_docs"))
    return counts.join(sizes, "host_key").where(F.col("n_docs") * 1000 > F.col("host_docs") * most_per_mille).select("key")


def judge_lines(docs: DataFrame, host: str = "source", most_docs: int = MOST_DOCS, most_per_mille: int = MOST_PER_MILLE, least_left_percent: int = LEAST_LEFT_PERCENT, clean_text: bool = False) -> DataFrame:
    """The text counts, base_failed, kept, line_words, removed_words of each row (with ``clean_text``: the text without its frequent lines).

    Lines are compared within a host; every row counts as a document; a null host is a host of its own. Lines are
    grouped by a 64-bit hash, counted on the map side before the shuffle, and joined back (adaptive execution splits a
    hot line). Every row is judged by its own lines, also where doc_ids repeat or are null; equal rows are judged alike.
    A null or empty text has no words, so it fails. Extra columns are ignored; an empty table gives no rows.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col(host).alias("host"))
    docs = docs.withColumn("row", F.xxhash64("host", "text"))
    lines = staged(line_rows(docs), "lines")
    often = frequent_lines(lines, docs, most_docs, most_per_mille).withColumn("hit", F.lit(True))
    removed = F.coalesce(F.sum(F.when(F.col("hit"), F.col("n_words"))), F.lit(0)).alias("removed_words")
    keys = [F.collect_set(F.when(F.col("hit"), F.col("key"))).alias("removed_keys")] if clean_text else []
    same = F.count_if("first").alias("same")  # equal rows, whose lines are added up
    by_row = lines.join(often, "key", "left").groupBy(F.col("doc_id").alias("line_doc"), F.col("row").alias("line_row")).agg(F.sum("n_words").alias("line_words"), removed, same, *keys)
    counted = with_text_counts(docs)
    joined = counted if clean_text else counted.drop("text", "host")
    joined = joined.join(by_row, F.col("doc_id").eqNullSafe(F.col("line_doc")) & (F.col("row") == F.col("line_row")), "left")
    left = joined.withColumns({c: F.coalesce((F.col(c) / F.col("same")).cast("long"), F.lit(0).cast("long")) for c in ("line_words", "removed_words")})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = 100 * (F.col("line_words") - F.col("removed_words")) < least_left_percent * F.col("line_words")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = [F.col("doc_id"), *counts, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "line_words", "removed_words"]
    if clean_text:
        gone = lambda x: F.coalesce(F.array_contains("removed_keys", F.xxhash64(F.col("host"), let(normal_lines(x), lambda n: F.get(n, F.lit(0))))), F.lit(False))
        out.append(F.array_join(F.filter(F.split("text", "\n"), lambda x: ~gone(x)), "\n").alias("clean_text"))
    return left.select(*out)


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source FROM documents),
w AS (SELECT r, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM d),
win AS (SELECT r, i, list_slice(words, i, i + 2) AS g FROM w, unnest(range(1, len(words) - 1)) AS t(i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS v(k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
norm AS (SELECT DISTINCT r, trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line FROM lines),
rows AS (SELECT norm.r, source, line, len(string_split(line, ' ')) AS n_words FROM norm JOIN d USING (r) WHERE line <> ''),
freq AS (SELECT source, line FROM rows GROUP BY source, line
  HAVING count(*) > {MOST_DOCS} AND count(*) * 1000 > (SELECT count(*) FROM d WHERE d.source IS NOT DISTINCT FROM rows.source) * {MOST_PER_MILLE}),
gone AS (SELECT r, sum(rows.n_words) AS total, coalesce(sum(rows.n_words) FILTER (freq.line IS NOT NULL), 0) AS removed
  FROM rows LEFT JOIN freq ON rows.line = freq.line AND rows.source IS NOT DISTINCT FROM freq.source GROUP BY r),
base AS (SELECT doc_id, len(words) AS n_words, len(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, coalesce(total, 0) AS line_words, coalesce(removed, 0) AS removed_words
  FROM d JOIN w USING (r) LEFT JOIN cov USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND 100 * (line_words - removed_words) >= {LEAST_LEFT_PERCENT} * line_words AS kept,
  CAST(line_words AS BIGINT) AS line_words, CAST(removed_words AS BIGINT) AS removed_words
FROM judged
"""
