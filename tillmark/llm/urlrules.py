"""URL filters by hashed host-suffix and path-prefix expressions.

A URL is expanded into the expressions that a rule could have: host suffixes with as many labels as some
rule's host, followed by path prefixes as long as some rule's path. Rules are found by an equi-join on a
short prefix of the expression's SHA-256, confirmed by the full digest, and ranked by length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.native import ascii_lower
from tillmark.session import checkpointed

#: Fixed rules of the registered query: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"
PREFIX_DIGITS = 8


def rules_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """``(verdict, host, path)`` of a short list of rules."""
    quoted = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return spark.sql("select * from values " + ", ".join(f"({', '.join(map(quoted, r))})" for r in rules) + " as r(verdict, host, path)")


def split_url(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host`` and ``path``, both empty if the url is null or has no ``://``."""
    rest = F.coalesce(F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return pages.withColumn("host", ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).withColumn(
        "path", F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every row of ``pages``.

    A rule (verdict, host, path) fits a URL if its host is the URL's or ends it after a dot, and its path
    begins the URL's. The longest rule (host and path together) wins, of equals the one that blocks;
    without a rule the verdict is ``default`` and ``rule`` is null. Rules with a null are left out, hosts
    are compared in lower case. Null urls and urls without ``://`` fit no rule. Repeated rows are rows of
    the result; each distinct URL is judged once. Other columns are not read. No rows give no rows.
    """
    listed = rules.where("verdict is not null and host is not null and path is not null")
    listed = checkpointed(listed.select("verdict", ascii_lower(F.col("host")).alias("host"), "path").distinct())
    expression = F.concat("host", "path")
    hashed = listed.select("verdict", expression.alias("rule"), F.sha2(expression, 256).alias("digest")).distinct()
    hashed = hashed.groupBy("rule", "digest").agg(F.max("verdict").alias("verdict")).select("*", F.substring("digest", 1, PREFIX_DIGITS).alias("short"))
    shapes = listed.select(F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("chars"))
    label_counts = [r[0] for r in shapes.select("labels").distinct().collect()]  # as many as rules have shapes
    path_lengths = [r[0] for r in shapes.select("chars").distinct().collect()]
    urls = split_url(pages.select("page_id", "url"))
    distinct = urls.select("host", "path").where("host != ''").distinct()
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in sorted(label_counts)]).cast("array<string>"))
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(path_lengths)]).cast("array<string>")
    expanded = distinct.select("host", "path", F.explode(suffixes).alias("suffix")).select(
        "host", "path", "suffix", F.explode(F.array_compact(prefixes)).alias("prefix")
    )
    digest = F.sha2(F.concat("suffix", "prefix"), 256)
    expanded = expanded.select("host", "path", digest.alias("full")).withColumn("short", F.substring("full", 1, PREFIX_DIGITS))
    fitting = expanded.join(hashed, "short").where("full = digest")
    best = fitting.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "verdict", "rule")).alias("best"))
    best = best.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "best")
    judged = urls.join(best, (urls.host == F.col("__host")) & (urls.path == F.col("__path")), "left")
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
