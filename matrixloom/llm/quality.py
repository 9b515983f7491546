"""Quality rules with cross-document line frequency, in DataFrame operations only.

Lines are normalised (lower case, digits as 0, white space as one blank) and hashed. For each host the distinct
documents of a line are counted; copies of one text are one document, since else a document that was copied often would have
nothing but frequent lines. A line is above the limit if it stands in more than ``most`` documents of its host, however
large the host is. Such lines are removed, and a document is depleted if fewer than ``words`` words are left or less than ``left``
of what it had.

Defined results: a null text has no words and fails the base rules; a null host is a host of its own, and so is an empty one; repeated rows are
judged alike and count once; extra columns are kept where rows are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted, stored

#: White space that separates words, as a Java pattern.
GAP = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP + "+"), "")


def with_word(lines: Column) -> Column:
    return F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def windows_in_order(hashes: Column) -> Column:
    """(hash, place) of the windows, equal hashes together; null if no window occurs twice."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), placed)


def covered_words(places: Column) -> Column:
    """How many words lie in the three-word windows that begin at ``places``, which are in order."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    return F.aggregate(places, start, lambda a, i: F.struct((i + 3).alias("end"), (a["total"] + i + 3 - F.greatest(a["end"], i)).alias("total")))["total"]


def counted(docs: DataFrame, text_column: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with the base counts; the names of these columns."""
    text = fresh("whole_text", docs.columns)
    words, hashes, placed, places, lines = (fresh(x, docs.columns) for x in ("words_of_text", "window_hashes", "windows_in_order", "window_places", "lines_of_text"))
    out = docs.withColumn(text, F.coalesce(quoted(text_column).cast("string"), F.lit("")))
    out = out.withColumn(words, words_of(F.col(text))).withColumn(lines, with_word(F.split(text, "\n")))
    w = F.col(words)
    window = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    # Each step is a column of its own: an array that a lambda looks into must not be built anew for each element.
    out = out.withColumn(hashes, F.when(F.size(w) > 3, window).otherwise(F.expr("cast(array() as array<bigint>)")))
    out = out.withColumn(placed, windows_in_order(F.col(hashes)))
    order = F.col(placed)
    twice = F.transform(order, lambda x, j: F.when((F.get(order, j - 1)["h"] == x["h"]) | (F.get(order, j + 1)["h"] == x["h"]), x["i"]))
    out = out.withColumn(places, F.sort_array(F.filter(twice, lambda x: x.isNotNull())))
    repeat = F.coalesce(covered_words(F.col(places)), F.lit(0))
    out = out.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.regexp_replace(text, GAP + "+", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeat.cast("long"),
    })
    return out.drop(text, words, hashes, placed, places, lines), ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def normal(line: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(F.trim(line), r"\s+", " "), "[0-9]", "0"))


def frequent_lines(docs: DataFrame, most: int = 20, text_column: str = "text", host_column: str = "source") -> DataFrame:
    """(host, text_hash, place, words) of every line above its host's limit, for each distinct text, in the shared folder."""
    host = quoted(host_column).cast("string").alias("host")
    text = quoted(text_column).cast("string")
    rows = docs.filter(text.isNotNull()).select(host, F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")).alias("place", "line"))
    rows = rows.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select("host", "text_hash", "place", F.xxhash64(normal(F.col("line"))).alias("line_hash"), F.size(words_of(F.col("line"))).alias("words"))
    lines = stored(rows.distinct(), "lines")
    # By way of distinct rows, so that a line in a third of all documents is added up before it is shuffled.
    counts = lines.select("host", "line_hash", "text_hash").distinct().groupBy("host", "line_hash").agg(F.count("*").alias("n"))
    above = stored(counts.filter(F.col("n") > most).select(F.col("host").alias("above_host"), F.col("line_hash").alias("above_line")), "frequent")
    same = F.col("host").eqNullSafe(F.col("above_host")) & (F.col("line_hash") == F.col("above_line"))
    return lines.join(above, same).select("host", "text_hash", "place", "words")


def judged(docs: DataFrame, most: int = 20, words: int = 50, left: float = 0.5, text_column: str = "text", host_column: str = "source") -> DataFrame:
    """``docs`` with the base counts, base_failed, n_line_words_removed and kept."""
    frequent = frequent_lines(docs, most, text_column, host_column)
    gone = stored(frequent.groupBy("host", "text_hash").agg(F.sum("words").alias("gone")), "depleted")
    names = [c for c in docs.columns if c != text_column]
    out, _ = counted(docs, text_column)
    host, text_hash, g1, g2, g3 = (fresh(x, out.columns) for x in ("host_of_row", "hash_of_row", "gone_host", "gone_hash", "gone_words"))
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = out.withColumns({host: quoted(host_column).cast("string"), text_hash: F.xxhash64(quoted(text_column).cast("string"))})
    out = out.select(*(quoted(c) for c in dict.fromkeys([*names, *added])), host, text_hash)
    gone = gone.select(F.col("host").alias(g1), F.col("text_hash").alias(g2), F.col("gone").alias(g3))
    out = out.join(gone, F.col(host).eqNullSafe(F.col(g1)) & (F.col(text_hash) == F.col(g2)), "left")
    removed = F.coalesce(F.col(g3), F.lit(0)).cast("long")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stay = F.col("n_words") - removed
    out = out.withColumns({"base_failed": failed, "n_line_words_removed": removed, "kept": ~failed & ((removed == 0) | ((stay >= words) & (stay >= left * F.col("n_words"))))})
    return out.drop(host, text_hash, g1, g2, g3)


def cleaned(docs: DataFrame, most: int = 20, text_column: str = "text", host_column: str = "source") -> DataFrame:
    """``docs`` without the lines above their host's limit; the other lines keep their order."""
    frequent = frequent_lines(docs, most, text_column, host_column)
    host, text_hash, places = (fresh(x, docs.columns) for x in ("frequent_host", "frequent_hash", "frequent_places"))
    lists = stored(frequent.groupBy(F.col("host").alias(host), F.col("text_hash").alias(text_hash)).agg(F.collect_set("place").alias(places)), "line-places")
    same = quoted(host_column).cast("string").eqNullSafe(F.col(host)) & (F.xxhash64(quoted(text_column).cast("string")) == F.col(text_hash))
    text = F.when(F.col(places).isNull(), quoted(text_column)).otherwise(
        F.array_join(F.filter(F.split(quoted(text_column).cast("string"), "\n"), lambda x, i: ~F.array_contains(F.col(places), i)), "\n")
    )
    return docs.join(lists, same, "left").select(*(text.alias(c) if c == text_column else quoted(c) for c in docs.columns))


#: The query's DuckDB twin. Lines are compared by their normalised text.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source AS host, text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), b AS (
  SELECT doc_id, host, text, w, l, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines
  FROM d
), p AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM b WHERE len(w) > 2)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS n FROM p) WHERE n > 1
), c AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY doc_id
), t AS (SELECT DISTINCT host, text FROM b WHERE text IS NOT NULL
), n AS (
  SELECT host, text, lower(regexp_replace(regexp_replace(trim(x), '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g')) AS line,
         len(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS words
  FROM (SELECT host, text, unnest(string_split(text, chr(10))) AS x FROM t)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), f AS (
  SELECT host, line FROM n GROUP BY host, line HAVING count(DISTINCT text) > 20
), g AS (
  SELECT n.host, text, sum(words) AS gone FROM n JOIN f ON n.host IS NOT DISTINCT FROM f.host AND n.line = f.line GROUP BY n.host, text
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
       (n_words < 50 OR 100 * coalesce(c.n, 0) > 50 * n_words) AS base_failed,
       CAST(coalesce(gone, 0) AS BIGINT) AS n_line_words_removed,
       NOT (n_words < 50 OR 100 * coalesce(c.n, 0) > 50 * n_words)
         AND (coalesce(gone, 0) = 0 OR (n_words - gone >= 50 AND n_words - gone >= 0.5 * n_words)) AS kept
FROM b LEFT JOIN c USING (doc_id) LEFT JOIN g ON b.host IS NOT DISTINCT FROM g.host AND b.text = g.text
"""
