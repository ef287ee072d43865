"""Quality rules with cross-document line frequency, in DataFrame operations alone.

Base rules look at one text: word, symbol and repeated-line counts, and the words inside 5-word windows that the text
holds twice or more. Windows are compared by 64-bit hashes of word hashes, in arrays of the row: nothing is exploded.

Line frequency looks across documents. Lines are normalised (lower case, blanks collapsed and trimmed) and hashed with
their host, here the source. Of a host's distinct documents (equal texts are one document), those that hold a line are
counted; a line above both limits, ``min_docs`` documents and ``max_share`` of the host's documents, is removed. A
document is depleted, and rejected, if less than ``min_left`` words or less than ``min_left_share`` of its words remain.

Lines are split and hashed once: their hashes and counts are a written table that both the counting and the join back read.
A line that a third of all documents share is one row per map task after partial aggregation; the join back splits
skewed partitions, and groups by (host, text), so copies of a text meet in one small row.

Defined results: a null text counts as empty; empty texts fail the base rules; null sources are a host of their own;
repeated rows are each returned; ties do not occur; other columns are ignored by ``quality`` and pass through ``cleaned``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, WORD, cut, shielded, words

#: Limits of the line rule, in documents of a host and in words of a document.
MIN_DOCS, MAX_SHARE, MIN_LEFT, MIN_LEFT_SHARE = 5, 0.02, 10, 0.3
#: Words in a window, and the rules' fixed values.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20


def text_of(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def without_blanks(text: Column) -> Column:
    for c in BLANKS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def normalised(line: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def host_of() -> Column:
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))


def line_hash(host: Column | str, line: Column) -> Column:
    return F.xxhash64(host, normalised(line))


def repeat_words(windows: str) -> Column:
    """Words covered by windows that occur twice or more, from the column of windows' hashes in order."""
    return F.expr(f"""
        aggregate(
          array_sort(transform(filter(__sorted, (e, i) -> (i > 0 AND __sorted[i - 1].h = e.h) OR (i + 1 < size(__sorted) AND __sorted[i + 1].h = e.h)), e -> e.i)),
          named_struct('n', 0L, 'last', -{WINDOW}),
          (a, i) -> named_struct('n', a.n + least({WINDOW}, i - a.last), 'last', i),
          a -> a.n)""")


def base_rules(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with __n_words, __word_chars, __n_symbols, __n_dup_lines, __n_repeat_words and __base_failed."""
    text = text_of()
    rows = docs.select(*keep, F.transform(words(text), lambda w: F.xxhash64(w)).alias("__w"), F.filter(F.split(text, "\n", -1), lambda x: F.length(without_blanks(x)) > 0).alias("__lines"), F.length(without_blanks(text)).cast("long").alias("__word_chars"), F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("__n_symbols"))
    n = F.size("__w")
    at = ", ".join(f"__w[i + {k}]" for k in range(WINDOW))
    windows = F.when(n >= WINDOW, F.expr(f"transform(sequence(0, greatest(0, size(__w) - {WINDOW})), i -> xxhash64({at}))")).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(*keep, "__word_chars", "__n_symbols", n.cast("long").alias("__n_words"), (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("__n_dup_lines"), windows.alias("__h"))
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    rows = rows.withColumn("__sorted", F.when(repeats, F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    rows = rows.withColumn("__n_repeat_words", F.when(F.col("__sorted").isNotNull(), repeat_words("__h")).otherwise(F.lit(0)).cast("long"))
    failed = (F.col("__n_words") < LEAST_WORDS) | (100 * F.col("__n_repeat_words") > MOST_REPEATED * F.col("__n_words"))
    return rows.select(*keep, "__n_words", "__word_chars", "__n_symbols", "__n_dup_lines", "__n_repeat_words", failed.alias("__base_failed"))


def fingerprint() -> list[Column]:
    return [F.xxhash64(text_of()).alias("__f1"), F.xxhash64(text_of(), F.lit(1)).alias("__f2")]


def removed_lines(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(__host, __f1, __f2, __removed array<long>, __removed_words): per host and distinct text, the lines above the limits."""
    texts = docs.select(host_of().alias("__host"), *fingerprint(), text_of().alias("__text"))
    lines = texts.select("__host", "__f1", "__f2", F.explode(F.split("__text", "\n", -1)).alias("__line"))
    lines = lines.select("__host", "__f1", "__f2", line_hash("__host", F.col("__line")).alias("__l"), F.regexp_count("__line", F.lit(WORD)).alias("__n")).filter("__n > 0")
    # Copies of a text repeat its lines: a sum over them is cut to one copy's by the count of copies.
    each = cut(lines.groupBy("__host", "__f1", "__f2", "__l").agg(F.sum("__n").alias("__n")), "lines")
    copies = docs.select(host_of().alias("__host"), *fingerprint()).groupBy("__host", "__f1", "__f2").agg(F.count("*").alias("__copies"))
    hosts = copies.groupBy("__host").agg(F.count("*").alias("__docs"))
    often = each.groupBy("__host", "__l").agg(F.count("*").alias("__in")).filter(F.col("__in") > min_docs).join(hosts, "__host").filter(F.col("__in") > max_share * F.col("__docs")).select("__host", "__l")
    found = each.join(often, ["__host", "__l"]).groupBy("__host", "__f1", "__f2").agg(F.collect_list("__l").alias("__removed"), F.sum("__n").alias("__sum"))
    return found.join(copies, ["__host", "__f1", "__f2"]).select("__host", "__f1", "__f2", "__removed", F.expr("__sum div __copies").alias("__removed_words"))


def judged(docs: DataFrame, keep: list[str], min_left: int = MIN_LEFT, min_left_share: float = MIN_LEFT_SHARE) -> DataFrame:
    """``keep`` columns with the base rules' columns, __removed, __left (words that remain) and __kept."""
    rows = base_rules(docs.withColumns({"__host": host_of(), "__f1": fingerprint()[0], "__f2": fingerprint()[1]}), [*keep, "__host", "__f1", "__f2"])
    rows = rows.join(removed_lines(docs), ["__host", "__f1", "__f2"], "left")
    left = F.col("__n_words") - F.coalesce("__removed_words", F.lit(0))
    rows = rows.withColumn("__left", left)
    depleted = F.col("__removed").isNotNull() & ((F.col("__left") < min_left) | (F.col("__left") < min_left_share * F.col("__n_words")))
    return rows.withColumn("__kept", ~F.col("__base_failed") & ~depleted)


def quality(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, left_words, kept) of each row of ``docs`` (doc_id, source, text)."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = judged(docs.select("doc_id", "source", "text"), ["doc_id"])
    return rows.select("doc_id", *(F.col(f"__{x}").alias(x) for x in names), F.col("__left").alias("left_words"), F.col("__kept").alias("kept"))


@shielded("doc_id", "source", "text", "n_chars")
def cleaned(docs: DataFrame) -> DataFrame:
    """The documents that are kept, without the lines above the limits (n_chars follows)."""
    # One condition over both sides of the join: a part that names the base rules alone would be pushed down to the scan, and there evaluated anew for each use.
    good = F.when(F.col("__kept"), F.lit(1)).otherwise(F.lit(0)) + F.coalesce(F.size("__removed"), F.lit(0)) * 0
    rows = judged(docs, docs.columns).withColumn("__good", good).filter(F.col("__good") == 1)
    lines = F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains("__removed", line_hash("__host", x)))
    rows = rows.withColumn("text", F.when(F.col("__removed").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("__removed").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(dict(docs.dtypes)["n_chars"])))
    return rows.select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, 'n') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5),
h AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS g FROM g),
c AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM h) WHERE n >= 2),
p AS (SELECT r, sum(least(5, coalesce(i - before, 5))) AS n_repeat_words FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM c) GROUP BY r),
b AS (SELECT w.r, doc_id, host, text, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN p ON w.r = p.r),
t AS (SELECT DISTINCT host, text FROM d),
x AS (SELECT host, text, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT host, text, unnest(string_split(text, chr(10))) AS line FROM t)),
e AS (SELECT host, text, line, sum(n) AS n FROM x WHERE n > 0 GROUP BY ALL),
hosts AS (SELECT host, count(*) AS docs FROM t GROUP BY host),
f AS (SELECT e.host, line FROM e JOIN hosts ON e.host = hosts.host GROUP BY e.host, line, docs HAVING count(*) > 5 AND count(*) > CAST(0.02 AS DOUBLE) * docs),
m AS (SELECT e.host, text, CAST(sum(n) AS BIGINT) AS removed_words FROM e JOIN f ON e.host = f.host AND e.line = f.line GROUP BY e.host, text),
j AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             n_words - coalesce(removed_words, 0) AS left_words, removed_words IS NOT NULL AS hit FROM b LEFT JOIN m ON b.host = m.host AND b.text = m.text)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, CAST(left_words AS BIGINT) AS left_words,
       NOT base_failed AND NOT (hit AND (left_words < 10 OR left_words < CAST(0.3 AS DOUBLE) * n_words)) AS kept FROM j
"""
