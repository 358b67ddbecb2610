"""Line dedup by site-relative frequency (operator 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.llm.common import columns, spare, table

#: A line is boilerplate if more than this share of its host's pages hold it ...
RATIO = 0.05
#: ... and so many pages at least: what stands on one page alone repeats nowhere.
MIN_PAGES = 2


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _name(line: Column) -> Column:
    """128 bits that stand for a line, compared without spaces at its ends."""
    line = F.trim(line)
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def boilerplate(docs: DataFrame, host: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, h1, h2)`` of the lines on more than ``ratio`` of their host's pages.

    A page counts a line once however often it holds it.  Both counts are
    pre-aggregated before they are shuffled.  Null hosts form one host; lines
    of nothing but spaces are never boilerplate.
    """
    pages = docs.groupBy(F.col(host).alias("__host")).agg(F.count(F.lit(1)).alias("__pages"))
    with_line = (docs.select(F.col(host).alias("host"), F.explode(F.array_distinct(F.transform(
                    F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""), _name))).alias("l"))
                 .groupBy("host", "l.h1", "l.h2").agg(F.count(F.lit(1)).alias("n"))
                 .filter(F.col("n") >= min_pages))
    return (with_line.join(pages, F.col("host").eqNullSafe(F.col("__host")))
            .filter(F.col("n") > ratio * F.col("__pages")).select("host", "h1", "h2"))


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; other columns as they are.

    The lines that stay keep their order and are joined by one line feed.
    Null texts stay null, texts without boilerplate stay as they are, and a
    text all of whose lines go becomes empty.  Repeated rows count as pages
    each.  An empty table gives no rows.
    """
    doc, of, drop = spare(docs, "__doc", "__of", "__drop")
    found = boilerplate(docs.select(host, "text"), host, ratio, min_pages).select(
        F.col("host").alias("__host"), F.struct("h1", "h2").alias("__name"))
    # of each document only the names of its boilerplate lines cross the shuffle
    held = (docs.select(F.col("doc_id").alias(doc), F.col(host).alias(of),
                        F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _name))).alias("__line"))
            .join(found, F.col(of).eqNullSafe(F.col("__host")) & (F.col("__line") == F.col("__name")), "left_semi")
            .groupBy(doc, of).agg(F.collect_set("__line").alias(drop)))
    joined = docs.join(held, F.col("doc_id").eqNullSafe(F.col(doc)) & F.col(host).eqNullSafe(F.col(of)), "left")
    kept = F.array_join(F.filter(_lines(F.col("text")), lambda x: ~F.array_contains(F.col(drop), _name(x))), "\n")
    text = F.when(F.col(drop).isNull(), F.col("text")).otherwise(kept)
    return joined.select(*[text.alias("text") if n == "text" else c for n, c in zip(docs.columns, columns(docs))])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every document without the boilerplate lines of its source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text", F.length("text").alias("whole"))
    out = drop_boilerplate(docs)
    return out.select("doc_id", "source", "text", F.length("text").cast("long").alias("n_chars"),
                      (F.col("whole") - F.length("text")).cast("long").alias("dropped_chars"))


ORACLE = f"""
WITH l AS (
  SELECT doc_id, source, text, i, string_split(text, chr(10))[i] AS line
  FROM (SELECT doc_id, source, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents
        WHERE text IS NOT NULL)),
p AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
b AS (
  SELECT l.source, trim(line, ' ') AS name
  FROM l JOIN p ON l.source IS NOT DISTINCT FROM p.source
  WHERE trim(line, ' ') <> ''
  GROUP BY l.source, trim(line, ' ')
  HAVING count(DISTINCT doc_id) >= {MIN_PAGES} AND count(DISTINCT doc_id) > {RATIO} * any_value(pages)),
k AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text
  FROM l ANTI JOIN b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line, ' ') = b.name
  GROUP BY doc_id)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END)::BIGINT AS n_chars,
       (length(d.text) - length(coalesce(k.text, '')))::BIGINT AS dropped_chars
FROM documents d LEFT JOIN k USING (doc_id)
"""
