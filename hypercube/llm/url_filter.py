"""URL filters by host-suffix and path-prefix expressions (operator 10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.llm.common import columns, spare, table

#: Fixed rules: host, path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Verdict of a url that no rule fits.
DEFAULT = "allow"
#: Hex digits of a digest that are joined on; the rest confirms.
SHORT = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """``rules`` as a table ``(host, path, verdict)``."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Every suffix of the host that has as many labels as some rule's host, with
    every prefix of the path that has the length of some rule's path, as
    ``host suffix`` + line feed + ``path prefix``."""
    n_labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    suffixes = F.filter(F.array(*[F.when(n_labels >= n, F.substring_index(host, ".", -n)) for n in labels]),
                        lambda s: s.isNotNull())
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(
        fitting, lambda n: F.concat(s, F.lit("\n"), F.substring(path, F.lit(1), n)))))


def url_verdicts(urls: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``(url, host, path, rule, verdict)`` per row of ``urls(url)``.

    A rule fits its host and all its subdomains if the url's path starts with
    the rule's path.  Of the rules that fit, the one with the longest host and
    path together wins; of equally long ones that with the longer host, then
    block before allow.  Urls that no rule fits get ``default``.  Null urls and
    urls without ``://`` have empty host and path.  Rules without host, path or
    verdict fit nothing.

    The rules' distinct path lengths and numbers of host labels, a few numbers,
    are read first, so a url's expressions are as many as these, however long
    its host and path are.  Urls and rules meet on ``SHORT`` digits of their digests; full digests confirm.
    """
    rules = (rules.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
             .select(F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
             .withColumn("r_digest", _digest(F.concat("r_host", F.lit("\n"), F.col("r_path"))))
             .withColumn("r_short", F.substring("r_digest", 1, SHORT)))
    sizes = rules.agg(F.sort_array(F.collect_set(F.length("r_path"))),
                      F.sort_array(F.collect_set(F.size(F.split("r_host", r"\.", -1))))).first()
    lengths, labels = sizes
    parts = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not lengths:
        return parts.select("url", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    rank = F.struct(F.length(F.concat("r_host", "r_path")).alias("long"), F.length("r_host").alias("host"),
                    (F.col("r_verdict") == "block").alias("block"), F.concat("r_host", "r_path").alias("rule"),
                    F.col("r_verdict").alias("verdict"))
    won = (parts.filter("host <> '' OR path <> ''").select("url", "host", "path").distinct()
           .select("url", F.explode(_expressions(F.col("host"), F.col("path"), labels, lengths)).alias("e"))
           .select("url", _digest(F.col("e")).alias("digest"))
           .join(rules, (F.substring("digest", 1, SHORT) == F.col("r_short")) & (F.col("digest") == F.col("r_digest")))
           .groupBy("url").agg(F.max(rank).alias("won")).select(F.col("url").alias("__url"), "won"))
    return (parts.join(won, F.col("url") == F.col("__url"), "left")
            .select("url", "host", "path", F.col("won.rule").alias("rule"),
                    F.coalesce("won.verdict", F.lit(default)).alias("verdict")))


def judged(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule and verdict of each row's url.

    Every row gets exactly one verdict, repeated urls the same one.  An empty
    table gives no rows.  Columns of ``pages`` with these names are replaced.
    """
    own = pages.drop("host", "path", "rule", "verdict")
    (judged_url,) = spare(pages, "__judged")
    verdicts = url_verdicts(pages.select("url").distinct(), rules, default).withColumnRenamed("url", judged_url)
    return (own.join(verdicts, F.col("url").eqNullSafe(F.col(judged_url)))
            .select(*columns(own), "host", "path", "rule", "verdict"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the verdict on every page's url."""
    found = judged(table(spark, sf_dir, "pages").select("page_id", "url"), rule_table(spark))
    return found.select("page_id", "host", "path", "rule", "verdict")


ORACLE = """
WITH r(host, path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
a AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
m AS (
  SELECT u.page_id, u.host, u.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST, length(r.host) DESC) AS place
  FROM u LEFT JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE place = 1
"""
