"""Mixing sources to target weights by Efraimidis-Spirakis keys (operator 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hypercube.llm.common import WORD, columns, spare, table, written

#: Weights of the sources by code point, null last, repeating.
WEIGHTS = (5, 2, 1)
#: A target stops at so many times its source's size.
MOST_EPOCHS = 3
#: Sampling weight of a document by its quality label; without one, the middle.
QUALITY = {1: 2.0, None: 1.0, 0: 0.5}
SEED = 7
#: Documents of a source that are put in order together, about.
BUCKET = 2048


def word_count(text: Column) -> Column:
    """Number of words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, size: Column, seed: int = SEED) -> Column:
    """A number in (0, 1) fixed by the document: 52 bits of an MD5 digest."""
    name = F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"))
    return (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def quality_weights(labels: DataFrame) -> DataFrame:
    """``(doc_id, quality_weight)`` per labelled document: the best of its labels."""
    weight = F.when(F.col("quality") == 1, QUALITY[1]).when(F.col("quality") == 0, QUALITY[0]).otherwise(QUALITY[None])
    return (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
            .agg(F.max(weight).alias("quality_weight")))


def sized(docs: DataFrame, quality: DataFrame, seed: int = SEED) -> DataFrame:
    """``(doc_id, source, size, w, u)`` per row of ``docs``; w: its sampling weight."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return (rows.join(quality, "doc_id", "left")
            .select("doc_id", "source", "size", F.coalesce("quality_weight", F.lit(QUALITY[None])).alias("w"),
                    uniform(F.col("doc_id"), F.col("size"), seed).alias("u")))


def targets(sources: DataFrame, most: int = MOST_EPOCHS) -> DataFrame:
    """``target`` for each row of ``sources(source, weight, source_size, ...)``.

    All words are shared by weight; a target stops at ``most`` times its
    source's size, and the excess is shared again until none is above.  Each
    round aggregates two sums, so the sources are never gathered.
    """
    limit = most * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        full = F.col("weight") * F.lit(level) > limit
        row = sources.agg(F.sum(F.when(full, limit).otherwise(0)).alias("full"),
                          F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open")).first()
        if not row["open"] or (total - row["full"]) / row["open"] <= level:
            break
        level = (total - row["full"]) / row["open"]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), limit.cast("double")))


def _by_code_point(sources: DataFrame) -> DataFrame:
    """Every source's weight, by its place in code point order, null last.

    Sources are numbered within ranges of their order, after those of the
    ranges before, so any number of sources may come.
    """
    by_name = F.col("source").asc_nulls_last()
    ranged = written(sources.repartitionByRange(by_name).withColumn("part", F.spark_partition_id()), "mix-order")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", before.alias("ahead"))
    place = F.col("ahead") + F.row_number().over(Window.partitionBy("part").orderBy(by_name)) - 1
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    return (ranged.join(ahead, "part")
            .withColumn("weight", F.element_at(weights, (place % len(WEIGHTS) + 1).cast("int"))).drop("part", "ahead"))


def plan_mix(rows: DataFrame, most: int = MOST_EPOCHS) -> DataFrame:
    """Per source: target, complete epochs, and the key up to which documents
    are taken once more.

    ``rows`` are those of ``sized``.  Keys are -ln(u) / w, smallest first.  A
    document is taken once more if half of it at least fits the words that
    are left of the target after the documents before it.  Prefix sums run
    over buckets of keys; only the bucket in which the words run out, of about
    ``BUCKET`` documents whatever the size of the source, is put in order.
    """
    sources = rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"), F.min("w").alias("w_min"))
    sources = written(_by_code_point(sources), "mix-sources")
    sources = (targets(sources, most)
               .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
               .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
               .withColumn("buckets", F.ceil(F.col("docs") / BUCKET)))
    named = sources.withColumnRenamed("source", "__source")
    bucketed = (rows.join(named, F.col("source").eqNullSafe(F.col("__source")))
                .select("doc_id", "source", "size", "rest", _key().alias("key"),
                        F.floor((1 - F.pow("u", F.col("w_min") / F.col("w"))) * F.col("buckets")).alias("bucket")))
    sums = bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    last = (sums.withColumn("before", F.coalesce(before, F.lit(0)))
            .filter("before <= rest AND rest < before + words")
            .select(F.col("source").alias("__source"), F.col("bucket").alias("__bucket"), "before"))
    inner = bucketed.join(last, F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket")))
    run = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    taken = (inner.withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0)))
             .filter(F.col("at") + F.col("size") / 2 <= F.col("rest"))
             .groupBy("source").agg(F.max("key").alias("last_key")))
    out = (named.join(last.select(F.col("__source").alias("__last"), "__bucket"), F.col("__source").eqNullSafe(F.col("__last")), "left")
           .join(taken.withColumnRenamed("source", "__taken"), F.col("__source").eqNullSafe(F.col("__taken")), "left"))
    return written(out.select("__source", "source_size", "target", "epochs", "w_min", "buckets",
                              F.col("__bucket").alias("last_bucket"), "last_key"), "mix-plan")


def _key() -> Column:
    return -F.log("u") / F.col("w")


def mix(rows: DataFrame, most: int = MOST_EPOCHS) -> DataFrame:
    """``rows`` of ``sized`` with source_size, target, and copies: how often the mix takes each.

    Null sources form one source.  Empty texts have size 0 and add nothing.
    Repeated rows (equal doc_id and size) share a key and are taken alike.
    An empty table gives no rows.
    """
    plan = plan_mix(rows, most)
    bucket = F.floor((1 - F.pow("u", F.col("w_min") / F.col("w"))) * F.col("buckets"))
    once_more = (F.col("last_bucket").isNotNull()
                 & ((bucket < F.col("last_bucket")) | ((bucket == F.col("last_bucket")) & (_key() <= F.coalesce("last_key", F.lit(-1.0))))))
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("__source")))
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("epochs") + F.when(once_more, 1).otherwise(0)).alias("copies")))


def mixed_documents(docs: DataFrame, quality: DataFrame, most: int = MOST_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns kept.

    Rows with equal doc_id and size are taken alike, so one decision serves
    them all.
    """
    doc, of, size, n, words, copy = spare(docs, "__doc", "__of", "__size", "__n", "__words", "__copy")
    taken = mix(written(sized(docs, quality, seed), "mix-sized"), most).filter("copies > 0")
    copies = (taken.groupBy("doc_id", "source", "size").agg(F.first("copies").cast("int").alias(n))
              .select(F.col("doc_id").alias(doc), F.col("source").alias(of), F.col("size").alias(size), n))
    found = docs.withColumn(words, word_count(F.col("text"))).join(
        copies, F.col("doc_id").eqNullSafe(F.col(doc)) & F.col("source").eqNullSafe(F.col(of)) & (F.col(words) == F.col(size)))
    return found.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*columns(docs))


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: how many words of every document the mix takes."""
    rows = written(sized(table(spark, sf_dir, "documents"), quality_weights(table(spark, sf_dir, "labels"))), "mix-sized")
    return mix(rows).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"),
                            (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = f"""
WITH RECURSIVE lab AS (
  SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) AS qw
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
r AS (
  SELECT d.doc_id, d.source, d.size, coalesce(qw, 1.0::DOUBLE) AS w,
         (('0x' || substr(md5('{SEED}|' || coalesce(d.doc_id::VARCHAR, '') || '|' || d.size::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496.0::DOUBLE AS u
  FROM d LEFT JOIN lab USING (doc_id)),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM r GROUP BY source),
cum AS (
  SELECT sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER o, 0) AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS open
  FROM s WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (
  SELECT max((total - capped)::DOUBLE / open) AS level FROM cum),
t AS (
  SELECT source, source_size, least(weight * level, 3.0::DOUBLE * source_size) AS target
  FROM s, lev),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
k AS (
  SELECT r.doc_id, r.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY -ln(u) / w, r.doc_id, r.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       ((epochs + CASE WHEN size > 0 AND ahead + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM k
"""
