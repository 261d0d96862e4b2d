"""From raw documents to training shards: each stage reads what the one before kept.

A stage gets (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to the shared folder and reads it back, which cuts the lineage: a lost
executor costs the tasks of one stage.  All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import decontaminate, mixing, near_dups, quality_rules, sharding
from rollbook.session import workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy rejects go."""
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dups.keep_one(spark, docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean(spark, docs, items)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or thinned to their target weights."""
    return mixing.mix(spark, docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``documents``, then where each row goes: size, text_crc32, curve,
    shard and slot, with a ``_`` behind a name that ``documents`` has itself."""
    found = sharding.shard(spark, docs)
    taken = {c.lower() for c in docs.columns}
    placed = []
    for name in ("size", "text_crc32", "curve", "shard", "slot"):
        free = name
        while free.lower() in taken:
            free += "_"
        taken.add(free.lower())
        placed.append(F.col(name).alias(free))
    return found.select("row.*", *placed)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", benchmark),
    ("mix_sources", mix),
    ("shard", shards),
]

#: MinHash signatures and string tiling are beyond SQL; tests hold the stages
#: against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, in order."""
    sf_dir = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = workspace(spark, "pipeline")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
