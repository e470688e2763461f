"""Raw feeds: pages and arrays into records, records into dated NDJSON, and back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safetymart.schemas import CORRUPT, FEEDS
from safetymart.sources.arrays import array_elements
from safetymart.sources.layout import (
    MissingFeedError,
    as_day,
    day_dir,
    empty_files,
    feed_dir,
    list_days,
    replace_dir,
    resolve_day,
)

# A record as it was received: its JSON text, in one column of this name.
RECORD = "value"


def _elements(records: Column) -> Column:
    return F.explode(records).alias(RECORD)


def page_records(pages: DataFrame, text_col: str = RECORD) -> DataFrame:
    """Records of page envelopes, from the ``results`` array of each page.

    A record's JSON text is kept but for the form of its numbers (``1.10`` becomes
    ``1.1``); what follows the end of the page's value is passed over. A page
    without ``results`` gives no records; blank text, or text that is not JSON,
    fails the job.
    """
    text = F.col(text_col)
    blank = F.coalesce(text, F.lit("")).rlike(r"\A\s*\z")
    checked = F.when(blank, F.raise_error(F.lit("empty response, expected JSON"))).otherwise(text)
    envelope = F.from_json(checked, "results array<string>", {"mode": "FAILFAST"})
    return pages.select(_elements(envelope["results"]))


def array_records(arrays: DataFrame, text_col: str = RECORD) -> DataFrame:
    """Records of JSON arrays; text that is no array fails the job."""
    text = F.col(text_col)
    checked = F.when(
        F.json_array_length(text).isNull(),
        F.raise_error(F.concat(F.lit("expected a JSON array: "), F.left(text, F.lit(80)))),
    ).otherwise(text)
    return arrays.select(_elements(F.from_json(checked, "array<string>")))


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file, its whole text: API responses as they were saved.

    Each file is read by one task, many files by many tasks: pages are small, and
    whole arrays have ``read_array_feed``. An empty file stops the read: it would
    be no row, and landing it would replace a day by nothing.
    """
    _refuse_empty(spark, path)
    return spark.read.text(path, wholetext=True)


def _refuse_empty(spark: SparkSession, path: str | list[str]) -> None:
    empty = empty_files(spark, path)
    if empty:
        raise ValueError(f"empty responses: {empty}")


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return page_records(read_documents(spark, path))


def read_array_feed(
    spark: SparkSession, path: str | list[str], split_bytes: int | None = None
) -> DataFrame:
    """Records of files that are one JSON array each, of any size, cut by many tasks."""
    _refuse_empty(spark, path)
    return array_elements(spark, path, split_bytes, RECORD)


def parse_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of JSON record texts."""
    return records.select(F.from_json(RECORD, schema).alias("r")).select("r.*")


def land_bronze(
    records: DataFrame,
    base: str,
    feed: str,
    day: date | str | None = None,
    order_by: str | None = None,
) -> str:
    """Write records as NDJSON into the folder of their ingest day; returns it.

    Landing a day again replaces that day, also by nothing. Records are JSON
    texts in one ``value`` column, written unchanged, or rows of any schema.
    There is no shuffle; ``order_by`` sorts within each file.
    """
    target = day_dir(feed_dir(base, feed), day)
    if records.columns != [RECORD]:
        lines = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
        if order_by:
            records = records.sortWithinPartitions(F.col(order_by).asc_nulls_last())
        records = records.select(lines.alias(RECORD))
    elif order_by:
        field = F.get_json_object(RECORD, f"$.{order_by}")
        records = records.sortWithinPartitions(field.asc_nulls_last())
    replace_dir(
        records.sparkSession, target, lambda path: records.write.text(path)
    )
    return target


def scan_bronze(
    spark: SparkSession,
    base: str,
    feed: str,
    day: date | str | None = None,
    as_of: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One day of a feed: its fields and the text of any malformed line.

    Only the folder of that day is listed and read. A line that is not valid
    JSON comes as nulls with its text in ``_corrupt_record``. A line that holds an
    array gives a row for each of its records; blank lines give none.
    """
    folder = feed_dir(base, feed)
    fields = schema or FEEDS[feed]
    found = resolve_day(spark, folder, day, as_of)
    return (
        spark.read.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(day_dir(folder, found))
    )


def scan_bronze_days(
    spark: SparkSession, base: str, feed: str, first: date | str, last: date | str
) -> DataFrame:
    """All days of a feed from ``first`` to ``last``, with ``ingest_date``.

    Each day is a full snapshot, so that only folders of the wanted days are
    listed: the names of the folders tell which.
    """
    folder = feed_dir(base, feed)
    days = [d for d in list_days(spark, folder) if as_day(first) <= d <= as_day(last)]
    if not days:
        raise MissingFeedError(f"no data from {first} to {last} in {folder}")
    parts = [T.StructField(p, T.IntegerType()) for p in ("year", "month", "day")]
    corrupt = T.StructField(CORRUPT, T.StringType())
    ingest_date = F.make_date("year", "month", "day").alias("ingest_date")
    return (
        spark.read.schema(T.StructType([*FEEDS[feed], corrupt, *parts]))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("basePath", folder)
        .json([day_dir(folder, d) for d in days])
        .select(*FEEDS[feed].fieldNames(), CORRUPT, ingest_date)
    )


def _parsed(scan: DataFrame) -> Column:
    """Always true; needs a field, as Spark does not read corrupt lines' texts alone."""
    field = next(c for c in scan.columns if c != CORRUPT)
    return F.length(F.coalesce(F.col(field).cast("string"), F.lit(""))) >= 0


def well_formed(scan: DataFrame) -> DataFrame:
    return scan.filter(F.col(CORRUPT).isNull() & _parsed(scan)).drop(CORRUPT)


def malformed(scan: DataFrame) -> DataFrame:
    """Lines that are not valid JSON, for a quarantine folder."""
    lines = scan.filter(F.col(CORRUPT).isNotNull() & _parsed(scan))
    return lines.withColumnRenamed(CORRUPT, "line")
