"""URL filter: rules first, then gradient-boosted trees on lexical features.

The rules label the URLs they fit.  From all different ones of those, weighted by how often
they occur, Spark's boosted trees learn which shapes are blocked: length, depth, digit ratio,
entropy, parameter counts, and how often the labelled URLs with its host suffixes and first
path segment are blocked.  A labelled URL's own label is left out of its suffix statistics.
The numbers go into the trees by BINS quantiles over all labelled URLs.  The trees then judge
what no rule fits.

Defined cases: a null URL, or one without ``://``, has empty host and path and is
judged by its features; a rule fits its host and all subdomains if the path starts with
the rule's, and the longest rule wins; without labels of both kinds every URL that no
rule fits gets the one kind there is, or ``allow``; a score of one half blocks; rows are judged one
by one, so repeated rows and null ids stay as they are; a long URL is judged whole; empty
tables give empty results.  Extra columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import QuantileDiscretizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.components import save
from rollbook.operators.relate import small_side
from rollbook.session import workspace

BLOCK, ALLOW = "block", "allow"
#: (verdict, host, path).  The rule is written as host and path together.
RULES: tuple[tuple[str, str, str], ...] = (
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
)
SAMPLE = None  # the trees learn from every labelled URL; a limit set here has no effect
TREES, DEPTH, BINS = 10, 4, 32
SUFFIXES = ("last_label", "last_labels", "first_segment")
NUMBERS = (
    "url_length", "host_length", "path_length", "host_labels", "depth", "digit_ratio",
    "entropy", "parameters", "hyphens",
)


def host_of(url: Column) -> Column:
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    longest_first = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    return F.coalesce(*[
        F.when(
            ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in longest_first
    ])


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character of the distribution of the text's characters."""
    length = F.length(text).cast("double")

    def bits(c: Column) -> Column:
        share = (length - F.length(F.replace(text, c, F.lit("")))) / length
        return -share * F.log2(share)

    letters = F.array_distinct(F.split(text, ""))
    filled = F.filter(letters, lambda c: c != "")
    return F.when(length > 0, F.aggregate(filled, F.lit(0.0), lambda total, c: total + bits(c))).otherwise(0.0)


def described(pages: DataFrame) -> DataFrame:
    """``row`` (all own columns), host, path, the rule's verdict, and features."""
    url = F.coalesce(F.col("row.url").cast("string"), F.lit(""))
    known = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"))
    known = known.select("row", url.alias("url")).select(
        "row", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    host, path, url = F.col("host"), F.col("path"), F.col("url")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    length = F.greatest(F.length(url), F.lit(1)).cast("double")
    return known.select(
        "row", "host", "path", rule_of(host, path).alias("told"),
        F.substring_index(host, ".", -1).alias("last_label"),
        F.substring_index(host, ".", -2).alias("last_labels"),
        F.regexp_extract(path, r"^/([^/]*)", 1).alias("first_segment"),
        F.length(url).cast("double").alias("url_length"),
        F.length(host).cast("double").alias("host_length"),
        F.length(path).cast("double").alias("path_length"),
        (count_of(host, r"\.") + 1).alias("host_labels"),
        count_of(path, "/[^/]").alias("depth"),
        (count_of(url, "[0-9]") / length).alias("digit_ratio"),
        entropy(url).alias("entropy"),
        count_of(query, "=").alias("parameters"),
        count_of(host, "-").alias("hyphens"),
    )


def with_rates(rows: DataFrame, rates: dict[str, DataFrame], own: Column) -> DataFrame:
    """The block rate of each suffix among the labelled URLs; ``own`` is 1 for rows that are
    part of them.  The tables grow with the suffixes: only small ones go to every task."""
    for name, rate in rates.items():
        rows = rows.join(small_side(rate), name, "left")
        blocked = F.coalesce(F.col(f"{name}_blocked"), F.lit(0)) - own * F.col("label")
        n = F.coalesce(F.col(f"{name}_n"), F.lit(0)) - own
        rows = rows.withColumn(f"{name}_rate", (blocked + 1) / (n + 2)).drop(f"{name}_blocked", f"{name}_n")
    return rows


def judge(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``row``, host, path, rule, verdict and score (the trees' chance of ``block``)."""
    folder = workspace(spark, "urls")
    rows = described(pages)
    label = F.when(F.col("told.verdict") == BLOCK, 1.0).otherwise(0.0)
    # Different URLs only, with their numbers as weights: a hot URL is one row.
    labelled = save(
        rows.filter("told IS NOT NULL").groupBy(F.col("row.url").alias("url"))
        .agg(F.first(label).alias("label"), F.count("*").cast("double").alias("weight"),
             *[F.first(c).alias(c) for c in (*SUFFIXES, *NUMBERS)]).drop("url"),
        f"{folder}/labelled",
    )
    kinds = [r["label"] for r in labelled.select("label").distinct().collect()]
    if len(kinds) < 2:
        rest = F.lit(BLOCK if kinds == [1.0] else ALLOW)
        return rows.select(
            "row", "host", "path", F.col("told.rule").alias("rule"),
            F.coalesce("told.verdict", rest).alias("verdict"), F.lit(None).cast("double").alias("score"),
        )
    rates = {
        name: save(
            labelled.groupBy(name).agg(F.sum("label").alias(f"{name}_blocked"), F.count("*").alias(f"{name}_n")),
            f"{folder}/{name}",
        )
        for name in SUFFIXES
    }
    numbers = [*NUMBERS, *[f"{name}_rate" for name in SUFFIXES]]
    learnt_from = save(
        with_rates(labelled, rates, F.lit(1)).select("label", "weight", *numbers), f"{folder}/learnt_from"
    )
    bins = QuantileDiscretizer(
        numBuckets=BINS, inputCols=numbers, outputCols=[f"{name}_bin" for name in numbers]
    ).fit(learnt_from)
    # An array, as the assembler would take a bin's number for a category's.
    features = array_to_vector(F.array(*bins.getOutputCols())).alias("features")
    # Spark looks for split points in maxBins ** 2 rows: in all of them, which have BINS values.
    most_bins = max(BINS, math.isqrt(learnt_from.count()) + 1)
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, maxBins=most_bins, seed=17, labelCol="label", weightCol="weight"
    ).fit(bins.transform(learnt_from).select("label", "weight", features))
    every = with_rates(rows.withColumn("label", F.lit(0.0)), rates, F.lit(0))
    scored = trees.transform(bins.transform(every).select("row", "host", "path", "told", features))
    score = vector_to_array("probability")[1]
    learnt = F.when(score >= 0.5, BLOCK).otherwise(ALLOW)
    return scored.select(
        "row", "host", "path", F.col("told.rule").alias("rule"),
        F.coalesce("told.verdict", learnt).alias("verdict"), score.alias("score"),
    )


def allowed(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The pages whose URL is not blocked, with their own columns only."""
    return judge(spark, pages).filter(F.col("verdict") == ALLOW).select("row.*")
