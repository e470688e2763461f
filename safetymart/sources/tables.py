"""Tables: raw replace, silver day, current silver, staging view, fact and marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from safetymart.schemas import SILVER_COLUMNS
from safetymart.session import settings
from safetymart.sources.layout import (
    day_dir,
    new_version,
    publish,
    replace_dir,
    resolve_day,
    silver_dir,
)

FACT_MONTH = "recall_month_start"

# Partitions of the rebalance by month, whatever the session's number: far more than
# there are months, and few enough (2,000) for map tasks to report the size of each,
# which adaptive execution needs to see that one month is large.
MONTH_PARTITIONS = 1_000

# Without these a rebalance is a plain hash shuffle: one task per month.
_SPLIT_LARGE_MONTHS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def read_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """NDJSON with whatever fields it has; the inference is one more pass."""
    return spark.read.json(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Full replacement of a Parquet table."""
    replace_dir(df.sparkSession, path, lambda fresh: df.write.parquet(fresh))


def write_silver(df: DataFrame, base: str, day: date | str | None = None) -> str:
    """Write one day of silver, replacing it; returns its folder.

    The number of files follows the data: adaptive execution sizes the
    partitions of the deduplicating shuffle, and each becomes one file.
    """
    target = day_dir(silver_dir(base), day)
    replace_table(df, target)
    return target


def read_silver(
    spark: SparkSession, base: str, day: date | str | None = None, as_of: bool = False
) -> DataFrame:
    folder = silver_dir(base)
    return spark.read.parquet(day_dir(folder, resolve_day(spark, folder, day, as_of)))


def load_current(
    spark: SparkSession,
    silver_day: str,
    table: str,
    copy: bool = True,
    versions: str | None = None,
) -> int:
    """Make ``table`` hold exactly the silver day; returns its number of rows.

    The day is copied to a new version below ``versions`` (default: a folder of the
    warehouse), and then the table's location in the catalog is changed, in one step: a reader sees the old rows or the
    new, and the table is never gone. The version before stays, for those who still read
    it. ``copy=False`` lets the table point at the day's folder instead, which moves no
    data: at a large scale that is the one to use. A managed table of that name holds
    data of its own and is refused, as are other columns than it has.
    """
    location, version = silver_day, None
    day = spark.read.parquet(silver_day)
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "MANAGED":
            raise ValueError(f"{table} is a managed table; drop it or load another")
        if spark.table(table).dtypes != day.dtypes:
            raise ValueError(f"{table} has other columns than {silver_day}")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    folder = versions or f"{warehouse}/_versions/{table}"
    if copy:
        version, location = new_version(folder)
        day.write.parquet(location)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    else:
        spark.catalog.createTable(table, path=location, source="parquet", schema=day.schema)
    spark.catalog.refreshTable(table)
    if version:
        publish(spark, folder, version)
    return spark.table(table).count()


def staging_view(spark: SparkSession, table: str, view: str = "stg_recalls") -> DataFrame:
    """The staging projection of ``table`` as a view in the catalog, and its rows.

    The view follows the table: it shows what was loaded last.
    """
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(SILVER_COLUMNS)} "
        f"FROM {table} WHERE recall_id IS NOT NULL"
    )
    return spark.table(view)


def by_month(fct: DataFrame) -> DataFrame:
    """Fact rows laid out for writing: together by month, sorted for skipping.

    The rebalance lets adaptive execution split a month that is too large for
    one task and merge small ones. Within each file rows are sorted, so that a
    filter on classification or state skips pages and row groups. The month
    leads the sort because the partitioned write wants it there; otherwise
    Spark would sort again and lose the rest.
    """
    return (
        fct.withColumn(FACT_MONTH, F.trunc("recall_date", "MM"))
        .hint("rebalance", MONTH_PARTITIONS, FACT_MONTH)
        .sortWithinPartitions(FACT_MONTH, "classification", "state")
    )


def write_fact(fct: DataFrame, path: str) -> None:
    """Full replacement of the fact table, one folder per month of the recall date.

    Rows without a date go to the default partition.
    """
    with settings(fct.sparkSession, _SPLIT_LARGE_MONTHS):
        replace_dir(
            fct.sparkSession,
            path,
            lambda fresh: by_month(fct).write.partitionBy(FACT_MONTH).parquet(fresh),
        )


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def fact_between(fct: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """Fact rows dated ``first`` to ``last``, both included.

    A filter on the date alone reads every folder, as Spark does not derive the
    month's bounds from it; so both are stated.
    """
    lo, hi = (F.lit(str(d)).cast("date") for d in (first, last))
    return fct.filter(
        F.col(FACT_MONTH).between(F.trunc(lo, "MM"), F.trunc(hi, "MM"))
        & F.col("recall_date").between(lo, hi)
    )
