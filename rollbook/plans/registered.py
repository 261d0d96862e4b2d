"""The list of checkable queries: a Spark function and, where SQL can say the
same over whole tables, the SQL text to compare it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollbook.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_tuned: set[str] = set()  # applications whose session was set up


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            app = spark.sparkContext.applicationId
            if app not in _tuned:
                tune(spark)
                _tuned.add(app)
            return run(spark, sf_dir)

        tuned.__name__ = run.__name__
        tuned.__doc__ = run.__doc__
        QUERIES[run.__name__] = tuned
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
