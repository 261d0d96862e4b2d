"""Mix sources to target weights, with DataFrame functions only.

The words of each source are counted, its target follows from its weight, and the
repetition rate is target / size.  Every document is emitted floor(rate) times, and
once more if a seeded hash of its doc_id, as a number from 0 to 1, is below the
fraction of the rate: a Bernoulli draw that comes out alike in every run and on every
executor.  A source of few or very uneven documents may miss its target by chance, so
each source takes, of SEEDS seeds, the one whose draw comes nearest to its target;
all are tried in one aggregation.

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating, and share
the words of the whole corpus.  A target stops at MOST_COPIES times the size of its
source and what it cannot take is shared anew by weight until no target is above.
The end of that is one level L with target = min(cap, weight * L): sources in order
of cap / weight fill up first, so L follows from running sums over the list of sources.

Defined cases: a null or empty text has size 0 and is emitted as its source's rate
says, at no cost; the null source is a source of its own; a source without words has
target 0 and rate 0; rows that share a doc_id draw alike; a null doc_id draws as the
empty text; an empty table gives an empty mix.  Extra columns are kept by ``mix`` and
never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.llm.components import save
from rollbook.session import workspace

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEEDS = 16  # four from each digest


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draws(doc_id: Column) -> Column:
    """For every seed a number from 0 to 1 that depends on the doc_id alone."""
    named = F.coalesce(doc_id.cast("string"), F.lit(""))
    digests = [F.md5(F.concat(F.lit(f"{i}:"), named).cast("binary")) for i in range(SEEDS // 4)]
    parts = [F.substring(d, 8 * k + 1, 8) for d in digests for k in range(4)]
    return F.array(*[F.conv(p, 16, 10).cast("double") / F.lit(float(1 << 32)) for p in parts])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: all that the plan needs of a document."""
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")
    )


def targets(measured: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target, rate: a row per source.

    Words are summed before the shuffle, so a source with a third of all rows is one
    row per task.  The windows run over the list of sources, which has a row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int")).cast("long")
    listed = (
        measured.groupBy("source").agg(F.sum("size").alias("source_size"))
        .select("source", "source_size", weight.alias("weight"))
        .withColumn("cap", F.lit(most).cast("long") * F.col("source_size"))
        .withColumn("fills", F.col("cap") / F.col("weight"))
    )
    turn = ("fills", "weight", "cap", F.col("source").asc_nulls_last())
    before = Window.orderBy(*turn).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = listed.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("rest"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("left"),
        F.row_number().over(Window.orderBy(*turn)).alias("turn"),
    )
    # The first source that its share does not fill sets the level for all after it.
    big = "decimal(18,0)"  # the products may go beyond a long
    is_open = F.col("weight").cast(big) * F.col("rest").cast(big) <= F.col("cap").cast(big) * F.col("left").cast(big)
    first = F.min(F.when(is_open, F.struct("turn", "rest", "left"))).over(everything)
    share = (F.col("weight") * F.col("first.rest")).cast("double") / F.col("first.left").cast("double")
    target = F.least(F.col("cap").cast("double"), share)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return level.select("*", first.alias("first")).select(
        "source", "source_size", target.alias("target"), rate.alias("rate")
    )


def of_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the plan of their source.  The plan is a written table of known size:
    Spark broadcasts it if it is small, else joins with a split of the hot sources."""
    named = plan.withColumnRenamed("source", "__source")
    same = F.col("source").cast("string").eqNullSafe(F.col("__source"))
    return rows.join(named, same, "left").drop("__source")


def plan_of(measured: DataFrame, folder: str) -> DataFrame:
    """source, source_size, target, rate, seed: a row per source."""
    rates = save(targets(measured), f"{folder}/targets")
    whole = F.floor("rate")
    tried = of_source(measured, rates).filter("size > 0").select(
        "source", "size", (F.col("rate") - whole).alias("part"), draws(F.col("doc_id")).alias("u")
    )
    drawn = tried.groupBy("source").agg(*[
        F.sum(F.when(F.col("u")[i] < F.col("part"), F.col("size")).otherwise(F.lit(0))).alias(f"s{i}")
        for i in range(SEEDS)
    ])
    miss = [
        F.struct(F.abs(F.col(f"s{i}") - wanted).alias("miss"), F.lit(i).alias("seed"))
        for wanted in [F.col("target") - whole * F.col("source_size")]
        for i in range(SEEDS)
    ]
    chosen = of_source(rates, drawn).select(
        "source", "source_size", "target", "rate",
        F.coalesce(F.array_min(F.array(*miss))["seed"], F.lit(0)).alias("seed"),
    )
    return save(chosen, f"{folder}/plan")


def copies(doc_id: Column, rate: Column, seed: Column) -> Column:
    """How often a document is emitted."""
    whole = F.floor(rate)
    extra = F.get(draws(doc_id), seed) < rate - whole
    return (whole + extra.cast("int")).cast("int")


def account(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken of every document."""
    folder = workspace(spark, "mix")
    measured = save(measure(docs), f"{folder}/sizes")
    found = of_source(measured, plan_of(measured, folder)).withColumn(
        "copies", copies(F.col("doc_id"), F.col("rate"), F.col("seed"))
    )
    return found.drop("seed").withColumn("taken", F.col("size") * F.col("copies"))


def mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mixed documents: a row for every copy, with the columns of ``docs``."""
    folder = workspace(spark, "mix")
    measured = save(measure(docs), f"{folder}/sizes")
    plan = plan_of(measured, folder).select(
        F.col("source").alias("__source"), F.col("rate").alias("__rate"), F.col("seed").alias("__seed")
    )
    same = F.col("source").cast("string").eqNullSafe(F.col("__source"))
    times = copies(F.col("doc_id"), F.col("__rate"), F.col("__seed"))
    emitted = docs.join(plan, same, "left").withColumn("__n", times)
    return emitted.filter("__n > 0").select(
        *[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__copy")
    ).drop("__copy")
