"""Tables, Arrow buffers and distributed ranks that the operators share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from safetymart.session import PARTITION_BYTES, scratch_dir
from safetymart.sources.layout import delete_dir

# Rows that one window partition should hold at most.
GROUP_ROWS = 200_000

# ASCII upper case to lower case, and the white space of the contracts.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACES = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Where ``stored`` notes its folders down, within a stage of a pipeline.
_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


class Intermediates:
    """The folders that a pipeline's stages write on their way; nobody else's."""

    def __init__(self) -> None:
        self.folders: list[str] = []

    def of_stage(self, stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        """``stage`` (spark, docs, ...), which first drops what earlier stages left.

        Their results have been written by then and come in as ``docs``. Should ``docs``
        still read one of the folders, that one stays.
        """

        @wraps(stage)
        def run(spark: SparkSession, docs: DataFrame, *args) -> DataFrame:
            self.drop(docs)
            token = _noted.set(self.folders)
            try:
                return stage(spark, docs, *args)
            finally:
                _noted.reset(token)

        return run

    def drop(self, docs: DataFrame) -> None:
        read, kept = docs.inputFiles(), []
        for folder in self.folders:
            if any(folder.rpartition("/")[2] in file for file in read):
                kept.append(folder)
            else:
                delete_dir(docs.sparkSession, folder)
        self.folders[:] = kept


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage is cut."""
    path = scratch_dir(df.sparkSession, label)
    if _noted.get() is not None:
        _noted.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the folder of a table that ``stored`` returned and nobody reads any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        delete_dir(df.sparkSession, folder)


def shuffle_partitions(df: DataFrame) -> int:
    """Partitions for shuffling ``df`` whole: the session's number, or more by its size."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(configured, min(-(-size // PARTITION_BYTES), 2**31 - 1))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def crc_of_id(column: Column) -> Column:
    """crc32 of an id as text, which the contracts deal out folds by."""
    return F.crc32(F.encode(column.cast("string"), "UTF-8"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each row starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.binary()) if pa.types.is_string(column.type) else column
    column = column.cast(pa.large_binary())
    starts = np.frombuffer(column.buffers()[1], np.int64)
    starts = starts[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data or b"", np.uint8), starts


def row_chunks(starts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together; a longer row is alone."""
    first, rows = 0, len(starts) - 1
    while first < rows:
        last = int(np.searchsorted(starts, starts[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def ranked(
    df: DataFrame, keys: list[str], order: list[Column], name: str = "rank"
) -> DataFrame:
    """``df`` with each row's place within its keys, gapless from 0.

    A key of any size is numbered by many tasks: rows are dealt into buckets by a
    hash of the order, buckets are counted, and a row's place is its place in its
    bucket after all earlier buckets. Only the counts, ``keys`` times buckets
    rows, are looked at as a whole.
    """
    bucket, before, size = (unused(df, n) for n in ("_bucket", "_before", "_size"))
    total = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    buckets = max(1, math.ceil(total / GROUP_ROWS))
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    ordered = [c.asc_nulls_first() for c in order]
    inner = F.row_number().over(W.partitionBy(*keys, bucket).orderBy(*ordered)) - 1
    if buckets == 1:
        return dealt.withColumn(name, inner.cast("long")).drop(bucket)
    earlier = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    counts = dealt.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias(size))
    counts = counts.select(
        *(F.col(k).alias(unused(df, f"_{k}")) for k in keys),
        F.col(bucket).alias(f"{bucket}_c"),
        F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(before),
    )
    same = F.col(bucket) == F.col(f"{bucket}_c")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(unused(df, f"_{k}")))
    joined = dealt.join(counts, same)
    return joined.withColumn(name, (inner + F.col(before)).cast("long")).select(
        *df.columns, name
    )
