"""Mixing sources to target weights, in DataFrame operations alone.

Sources in code point order, null last, weigh 3, 1, 2, repeating, and share ``share`` of all words. A target stops at
``cap`` times its source's words; the excess goes to the others by weight until none is above: sources are capped in
order of cap by weight, which a running sum finds at once.

Each row gets a hash-random key, of its doc_id and its text. Rows are range-partitioned by source and by the key's first
three hexadecimal digits; sums per range give each range its first position, a window within a range the row's. A source of
any size is thus 4096 ranges, and no window spans a source. A source's words are taken from the front of this order: whole
epochs first, then up to the budget's last word, so that the words taken are the target rounded down.

Sums over sources, of which there may be many, are prefix sums too: sources are range-partitioned by the order asked for, and
only a row for each partition meets in one window.

Defined results: null texts count 0 words; a source without words has target 0; rows of a null doc_id take part, spread by
their texts; repeated rows are rows of their own (those that agree in doc_id and text are interchangeable); other columns
pass through ``mixed_documents`` and are ignored by ``mix``; reruns agree, as keys are hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, WORD, cut, shielded

#: The weights of sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
SEED = "mix-1:"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of the mix: size, source's key, hash-random key, range."""
    own = F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    source = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    return docs.withColumns({"__size": n_words(), "__source": source, "__key": F.md5(own.cast("binary"))}).withColumn("__range", F.substring("__key", 1, 3))


def running(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with ``at``, their number from 1 in ``order`` (total), and for each of ``sums`` the sum over the rows up to each."""
    rows = rows.withColumns({f"__{n}": c for n, c in sums.items()})
    placed = cut(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")
    of_part = placed.groupBy("__part").agg(F.count("*").alias("at"), *(F.sum(f"__{n}").alias(n) for n in sums))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = of_part.select("__part", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__start_{n}") for n in ("at", *sums)))
    within = Window.partitionBy("__part").orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumns({"at": F.row_number().over(within), **{n: F.sum(f"__{n}").over(upto) for n in sums}}).join(F.broadcast(starts), "__part")
    return placed.withColumns({n: F.col(n) + F.col(f"__start_{n}") for n in ("at", *sums)}).drop("__part", *(f"__{n}" for n in sums), *(f"__start_{n}" for n in ("at", *sums)))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), cap: int = 2) -> DataFrame:
    """(__source, source_size, target, budget) from (__source, source_size), a row per source. ``share`` is a fraction."""
    a, b = share
    # 's...' sorts after 'n', which is the null source and comes last
    ranked = running(sizes, [(F.col("__source") == "n").cast("int"), F.col("__source")], {}).withColumnRenamed("at", "rank")
    weighed = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    stepped = running(weighed, [F.col("source_size") / F.col("weight"), F.col("rank")], {"words": F.col("source_size"), "parts": F.col("weight")})
    words, parts = stepped.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    # Of this source and those after it: b times the words that are left, and the weights.
    stepped = stepped.withColumn("left", F.lit(a * words) - b * cap * (F.col("words") - F.col("source_size"))).withColumn("rest", F.lit(parts) - F.col("parts") + F.col("weight"))
    capped = F.lit(cap * b) * F.col("source_size") * F.col("rest") <= F.col("left") * F.col("weight")
    free = stepped.agg(F.min(F.when(~capped, F.struct("at", "left", "rest"))).alias("free")).first()["free"]
    target = (cap * F.col("source_size")).cast("double")
    if free is not None:
        shared = (F.col("weight") * F.lit(free["left"])).cast("double") / F.lit(b * free["rest"]).cast("double")
        target = F.when(F.col("at") < free["at"], target).otherwise(shared)
    return stepped.select("__source", "source_size", target.alias("target")).withColumn("budget", F.floor("target").cast("long"))


def taken_rows(rows: DataFrame, keep: list[str], weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), cap: int = 2) -> DataFrame:
    """``keep`` columns of ``rows``, which are ``keyed``, with size, source_size, target and taken, under names with two leading underscores."""
    ranges = cut(rows.groupBy("__source", "__range").agg(F.sum("__size").alias("words")), "ranges")
    by_source = Window.partitionBy("__source")
    starts = ranges.withColumn("first", F.sum("words").over(by_source.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))).select("__source", "__range", F.coalesce("first", F.lit(0)).alias("first"))
    goal = targets(ranges.groupBy("__source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    starts = starts.join(goal, "__source").select("__source", "__range", *(F.col(x).alias(f"__{x}") for x in ("first", "source_size", "target", "budget")))
    within = Window.partitionBy("__source", "__range").orderBy("__key", "doc_id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__before", F.coalesce(F.sum("__size").over(within), F.lit(0))).join(starts, ["__source", "__range"])
    epochs = F.when(F.col("__source_size") > 0, F.expr("__budget div __source_size")).otherwise(F.lit(0))
    rest = F.col("__budget") - epochs * F.col("__source_size")
    part = F.greatest(F.lit(0), F.least(F.col("__size"), rest - F.col("__first") - F.col("__before")))
    return placed.select(*keep, "__size", "__source_size", "__target", (epochs * F.col("__size") + part).cast("long").alias("__taken"))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each row of ``docs`` (doc_id, source, text); see the module's text."""
    rows = cut(keyed(docs.select("doc_id", "source", "text")).drop("text", "source"), "sizes")  # texts are read once
    return taken_rows(rows, ["doc_id"]).select("doc_id", *(F.col(f"__{x}").alias(x) for x in ("size", "source_size", "target", "taken")))


def first_words(text: Column, n: Column) -> Column:
    """The text up to its nth word."""
    gaps = "[" + BLANKS + "]*"
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(gaps + WORD), F.lit(0)), F.lit(1), n.cast("int")), "")


@shielded("doc_id", "source", "text", "n_chars")
def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken, the source's last one cut after the budget's last word (n_chars follows)."""
    rows = taken_rows(keyed(docs), docs.columns).filter(F.col("__taken") > 0)
    whole = F.expr("__taken div __size")
    rows = rows.withColumn("__copies", F.when(F.col("__taken") % F.col("__size") == 0, whole).otherwise(whole + 1)).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    short = F.col("__taken") - (F.col("__copy") - 1) * F.col("__size")
    rows = rows.withColumn("text", F.when(short < F.col("__size"), first_words(F.col("text"), short)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(short < F.col("__size"), F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k, coalesce('s' || source, 'n') AS s FROM documents),
z AS (SELECT s, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY s),
w AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN s = 'n' THEN 1 ELSE 0 END, s) AS rank FROM z),
v AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM w),
l AS (SELECT *, row_number() OVER (ORDER BY source_size / CAST(weight AS DOUBLE), rank) AS r,
             3 * (SELECT sum(source_size) FROM v) - 4 * coalesce(sum(source_size) OVER (ORDER BY source_size / CAST(weight AS DOUBLE), rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_left,
             sum(weight) OVER (ORDER BY source_size / CAST(weight AS DOUBLE), rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM v),
f AS (SELECT r AS free_r, words_left AS free_left, rest AS free_rest FROM l WHERE 4 * source_size * rest > words_left * weight ORDER BY r LIMIT 1),
t AS (SELECT s, source_size, CASE WHEN free_r IS NULL OR r < free_r THEN CAST(2 * source_size AS DOUBLE)
                                  ELSE CAST(weight * free_left AS DOUBLE) / CAST(2 * free_rest AS DOUBLE) END AS target FROM l LEFT JOIN f ON true),
p AS (SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
             coalesce(sum(size) OVER (PARTITION BY d.s ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM d JOIN t ON d.s = t.s),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - prior)) AS BIGINT) AS taken FROM e
"""
