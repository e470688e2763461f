"""Session, shuffle sizes and scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Bytes that one shuffle partition should hold.
PARTITION_BYTES = 256 * 1024**2


def build_session(app: str = "safetymart", **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; any of them can be overridden.

    Adaptive execution merges small shuffle partitions at run time and splits
    skewed ones in joins and, at the fact table's rebalance, skewed months. It
    cannot split a partition of a window or an aggregate, for which the runs
    raise the number of partitions by the size of their input.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def isolated(spark: SparkSession, conf: dict[str, str] | None = None) -> SparkSession:
    """A session beside ``spark`` with its settings and ``conf``; changes stay within it.

    Both share the cluster and the catalog's tables, not temporary views.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    for name, value in (conf or {}).items():
        session.conf.set(name, value)
    return session


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session with ``conf`` within the block, as it was afterwards."""
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def partitions_for(size: int, configured: int) -> int:
    """Shuffle partitions for so many bytes, never fewer than configured."""
    return max(configured, -(-size // PARTITION_BYTES))


@contextmanager
def sized_shuffles(df: DataFrame) -> Iterator[int]:
    """Within the block, shuffles have partitions enough for the size of ``df``.

    The size is Catalyst's estimate from the files below. A number set for
    adaptive execution to start from is left alone.
    """
    spark = df.sparkSession
    name = "spark.sql.shuffle.partitions"
    partitions = int(spark.conf.get(name))
    if not spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None):
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        partitions = partitions_for(int(size), partitions)
    with settings(spark, {name: str(partitions)}):
        yield partitions


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for intermediate tables, in the cluster's shared folder.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session, as in tests, may do without it and use the machine's own folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="safetymart-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
