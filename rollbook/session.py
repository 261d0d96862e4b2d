"""Session settings and the shared folder that jobs write into."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE splits an oversized join partition by map output, which keeps a key that
# holds a third of the rows off a single task.  The "force" switch keeps that
# split even where a later operator would have liked the join's partitioning.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Sizes of catalog tables come from their column statistics where they have some: rows times
    # row size, not compressed bytes.
    "spark.sql.cbo.enabled": "true",
    # A fused method beyond 8000 bytes of bytecode is never compiled by HotSpot.
    # Wide cleaning projections get there; unfused they are split into small
    # methods and run about twice as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_local_roots: dict[str, str] = {}
_made: dict[str, list[str]] = {}  # work folders by application


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime option for as long as the block runs."""
    usual = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if usual is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, usual)


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster such a folder would exist on one machine only, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.conf.get("spark.app.id", "local")
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="rollbook-")
        root = _local_roots[app]
    made = f"{root.rstrip('/')}/rollbook/{label}-{uuid.uuid4().hex}"
    _made.setdefault(app, []).append(made)
    return made


def clear_workspaces(spark: SparkSession) -> int:
    """Delete the work folders that this application has made, and return how many there were.

    Results that read from them are gone as well: call it when they are written or shown.
    """
    made = _made.pop(spark.conf.get("spark.app.id", "local"), [])
    jvm = spark.sparkContext._jvm
    for path in made:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return len(made)
