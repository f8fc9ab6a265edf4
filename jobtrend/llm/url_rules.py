"""URL filters: hashed host-suffix and path-prefix expressions (DataFrame functions only).

Each URL is expanded into the expressions ``host suffix + path prefix`` of the shapes
(number of labels, length of path) that the rules have. Expressions meet rules in an
equi-join on the first four bytes of their SHA-256; the full digest confirms, and the
longest rule wins.

Defined results: a null URL or one without ``://`` has an empty host and path and gets the
default verdict. A rule whose host or path is null is ignored; repeated rules count once; of
rules with equal text, block wins. An empty rule table leaves the default everywhere. Input
columns come back inside ``row``, results inside ``found``, so no names can clash; every
input row is returned once, repeated rows too. Partitions with a hot host stay as they were
read: the large side of the join is dealt out again only where the rules exceed Spark's own
broadcast threshold, and adaptive execution then splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtrend.llm.common import whole_row

#: The rules that the contract states.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Verdict where no rule fits.
DEFAULT_VERDICT = "allow"
#: Bytes of the digest that the join compares.
PREFIX_BYTES = 4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """``row`` (the input's columns) and ``found`` (host, path, rule, verdict) for every row."""
    known = (
        rules.where("host is not null and path is not null")
        .select("verdict", F.translate("host", _UPPER, _LOWER).alias("host"), "path")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.concat("host", "path").alias("rule"),
            "verdict",
            F.size(F.split("host", r"\.")).alias("labels"),
            F.length("path").alias("path_length"),
        )
        .withColumn("rule_digest", _digest(F.col("rule")))
        .withColumn("rule_prefix", F.substring("rule_digest", 1, PREFIX_BYTES))
    )
    # one value: the shapes that rules have, at most (labels of a host) x (lengths of a path)
    shapes = known.agg(F.collect_set(F.struct("labels", "path_length")).alias("shapes")).scalar()
    split = pages.select(
        F.monotonically_increasing_id().alias("row_id"), whole_row(pages).alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    labels = F.split("host", r"\.")
    fitting = F.filter(F.col("shapes"), lambda s: (s["labels"] <= F.size(labels)) & (s["path_length"] <= F.length("path")))
    expression = lambda s: F.concat(
        F.array_join(F.slice(labels, F.size(labels) - s["labels"] + 1, s["labels"]), "."), F.substring(F.col("path"), F.lit(1), s["path_length"])
    )
    asked = (
        split.withColumn("shapes", shapes)
        .withColumn("digest", F.explode_outer(F.transform(fitting, lambda s: _digest(expression(s)))))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_BYTES))
        .drop("shapes")
    )
    met = asked.join(known, F.col("prefix") == F.col("rule_prefix"), "left")
    confirmed = F.when(F.col("digest") == F.col("rule_digest"), F.struct(F.length("rule").alias("length"), F.col("verdict"), F.col("rule")))
    return (
        met.groupBy("row_id")
        .agg(F.first("row").alias("row"), F.first("host").alias("host"), F.first("path").alias("path"), F.max(confirmed).alias("best"))
        .select("row", F.struct("host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")).alias("found"))
    )
