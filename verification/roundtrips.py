"""Queries for sources and sinks: each writes its tables and reads them back.

Files go to a new folder below the one that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from safetymart.operators import marts
from safetymart.operators.fingerprint import fingerprint
from safetymart.plans.gold import QualityError, read_gold, run_gold
from safetymart.plans.silver import build_silver, run_silver
from safetymart.schemas import FDA_RAW, FSIS_RAW
from safetymart.session import scratch_dir
from safetymart.sources import bronze, tables
from safetymart.sources.fixtures import fda_raw, fsis_raw
from safetymart.sources.staging import stage_feed

_DAY = "2024-04-14"
_EARLIER = "2024-04-07"


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records out of page envelopes, among them pages without results."""
    record = F.to_json(F.struct("*"))
    page = F.concat(F.lit('{"meta":{},"results":['), record, F.lit("]}"))
    pages = fda_raw(spark, sf_dir).select(page.alias("value"))
    empty = fsis_raw(spark, sf_dir).select(F.lit('{"meta":{}}').alias("value"))
    records = bronze.page_records(pages.unionByName(empty))
    return bronze.parse_records(records, FDA_RAW)


def _enclosed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines, nulls aside, between those that open and close an array."""

    def line(text: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([text])], names=["value"])

    yield line('[{"field_title":"first"}')
    for batch in batches:
        yield batch.filter(batch.column(0).is_valid())
    yield line("]")


def array_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records out of one file that is one JSON array, cut at 64 KB; each stands twice.

    A saved response is one file, so one task writes it, line by line. The array's ends
    are put around the lines as they pass: a sort would hold all lines in that task.
    """
    record = F.to_json(F.struct("*", F.struct(F.lit('"}],{').alias("x")).alias("nested")))
    raw = fsis_raw(spark, sf_dir).select(F.concat(F.lit(","), record).alias("value"))
    # Without any row the lines would not pass through at all.
    some = spark.range(1).select(F.lit(None).cast("string").alias("value"))
    lines = raw.unionByName(raw).unionByName(some)
    folder = scratch_dir(spark, "array")
    lines.coalesce(1).mapInArrow(_enclosed, "value string").write.text(folder)
    records = bronze.read_array_feed(spark, folder, split_bytes=1 << 16)
    return bronze.parse_records(records, FSIS_RAW).filter("field_title <> 'first'")


def bronze_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days landed, one of them twice; the second day read back."""
    base = scratch_dir(spark, "bronze")
    raw = fda_raw(spark, sf_dir)
    bronze.land_bronze(raw.filter("classification = 'Class I'"), base, "fda", _EARLIER)
    bronze.land_bronze(raw.filter("classification = 'Class II'"), base, "fda", _DAY)
    bronze.land_bronze(raw, base, "fda", _DAY, order_by="report_date")
    return bronze.well_formed(bronze.scan_bronze(spark, base, "fda", _DAY))


def bronze_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per ingest day over a range of landed days."""
    base = scratch_dir(spark, "bronze")
    raw = fda_raw(spark, sf_dir)
    bronze.land_bronze(raw.filter("classification = 'Class I'"), base, "fda", "2024-03-31")
    bronze.land_bronze(raw.filter("classification = 'Class II'"), base, "fda", _EARLIER)
    bronze.land_bronze(raw, base, "fda", _DAY)
    days = bronze.scan_bronze_days(spark, base, "fda", _EARLIER, _DAY)
    return days.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("row_count"))


def bronze_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed lines of a feed, with the counts of all its lines by kind.

    Every record of Class III is landed as a line that is no JSON.
    """
    base = scratch_dir(spark, "malformed")
    raw = fda_raw(spark, sf_dir)
    broken = F.concat(F.lit('{"recall_number": "'), F.coalesce("recall_number", F.lit("?")))
    line = F.when(F.col("classification") == "Class III", broken).otherwise(
        F.to_json(F.struct(*FDA_RAW.fieldNames()))
    )
    bronze.land_bronze(raw.select(line.alias("value")), base, "fda", _DAY)
    staged = stage_feed(bronze.scan_bronze(spark, base, "fda", _DAY), f"{base}/staged")
    counts = staged.profile("fda", ["recall_number"])[0]
    return staged.lines().groupBy("line").agg(F.count(F.lit(1)).alias("line_count")).select(
        "line",
        "line_count",
        F.lit(counts["malformed"]).cast("long").alias("malformed"),
        F.lit(counts["row_count"]).cast("long").alias("row_count"),
        F.lit(counts["missing"]).cast("long").alias("missing"),
    )


def _silver_day(spark: SparkSession, sf_dir: str, base: str) -> str:
    """A written silver day with all recalls."""
    silver = build_silver(fda_raw(spark, sf_dir), fsis_raw(spark, sf_dir))
    return tables.write_silver(silver, base, _DAY)


def _silver_days(spark: SparkSession, sf_dir: str, base: str) -> tuple[str, str]:
    """Two written silver days: the recalls of one agency, then all."""
    whole = _silver_day(spark, sf_dir, base)
    part = spark.read.parquet(whole).filter("source_agency = 'FDA'")
    return tables.write_silver(part, base, _EARLIER), whole


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def current_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current table after two loads, the second in the place of the first."""
    base = scratch_dir(spark, "current")
    table = _table_name("current")
    for day in _silver_days(spark, sf_dir, base):
        tables.load_current(spark, day, table, versions=f"{base}/versions")
    return spark.table(table)


def staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by agency and year through the catalog's view of the current table.

    The view is made over the first load and shows the second.
    """
    first, second = _silver_days(spark, sf_dir, scratch_dir(spark, "view"))
    table, view = _table_name("current"), _table_name("stg_recalls")
    tables.load_current(spark, first, table, copy=False)
    tables.staging_view(spark, table, view)
    tables.load_current(spark, second, table, copy=False)
    return spark.sql(
        f"SELECT source_agency, recall_year, count(*) AS row_count FROM {view} "
        "WHERE status = 'Ongoing' GROUP BY source_agency, recall_year"
    )


def gold_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is published after a good build and one that its checks stop.

    The first build has the rows that meet all checks; the second has a
    classification that no list holds.
    """
    base = scratch_dir(spark, "gate")
    whole = spark.read.parquet(_silver_day(spark, sf_dir, base))
    dated = whole.filter("classification IS NOT NULL AND recall_date IS NOT NULL")
    # A company without a state and one whose state is that word share their key. Both
    # are stored: the join is planned by the companies' real size, and made once.
    dated.filter("state = 'UNKNOWN'").select("company").distinct().write.parquet(f"{base}/unknown")
    unknown = spark.read.parquet(f"{base}/unknown")
    dated.join(unknown, "company", "left_anti").write.parquet(f"{base}/passing")
    silver = spark.read.parquet(f"{base}/passing")
    run_gold(spark, silver, f"{base}/gold")
    stopped = 0
    try:
        run_gold(spark, silver.withColumn("classification", F.lit("Class IV")), f"{base}/gold")
    except QualityError:
        stopped = 1
    published = read_gold(spark, f"{base}/gold")["agg_recalls_by_year"]
    return published.withColumn("stopped", F.lit(stopped))


def gold_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and order-free fingerprints of the staging view and all published models."""
    base = scratch_dir(spark, "gold")
    silver = spark.read.parquet(_silver_day(spark, sf_dir, base))
    run_gold(spark, silver, f"{base}/gold", on_failure="warn")
    models = {k: v for k, v in read_gold(spark, f"{base}/gold").items() if k != "rollup"}
    models["fct_recalls"] = models["fct_recalls"].drop(tables.FACT_MONTH)
    models["stg_recalls"] = marts.stg_recalls(silver)
    found = [fingerprint(df, name) for name, df in models.items()]
    return reduce(DataFrame.unionByName, found)


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw Parquet table with inferred schema, replaced as a whole."""
    base = scratch_dir(spark, "raw")
    landed = bronze.land_bronze(fsis_raw(spark, sf_dir), base, "fsis", _DAY)
    inferred = tables.read_inferred(spark, landed)
    tables.replace_table(inferred.filter("field_states IS NULL"), f"{base}/table")
    tables.replace_table(inferred, f"{base}/table")
    return spark.read.parquet(f"{base}/table")


def silver_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole silver run from landed feeds, the written day read back."""
    base = scratch_dir(spark, "silver")
    bronze.land_bronze(fda_raw(spark, sf_dir), base, "fda", _DAY)
    bronze.land_bronze(fsis_raw(spark, sf_dir), base, "fsis", _DAY)
    return run_silver(spark, base, base, _DAY).read(spark)


def fact_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows of some months, from the month-partitioned table."""
    path = f"{scratch_dir(spark, 'fact')}/fct_recalls"
    silver = build_silver(fda_raw(spark, sf_dir), fsis_raw(spark, sf_dir))
    tables.write_fact(marts.fct_recalls(marts.stg_recalls(silver)), path)
    fct = tables.read_fact(spark, path)
    return tables.fact_between(fct, "1997-02-10", "1997-11-20").drop(tables.FACT_MONTH)


def gold_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole gold run; the published yearly shares read back."""
    base = scratch_dir(spark, "gold")
    silver = build_silver(fda_raw(spark, sf_dir), fsis_raw(spark, sf_dir))
    tables.write_silver(silver, base, _DAY)
    written = tables.read_silver(spark, base, _DAY)
    run_gold(spark, written, f"{base}/gold", on_failure="warn")
    return read_gold(spark, f"{base}/gold")["agg_contaminants_by_year"]


QUERIES = {
    "page_records": page_records,
    "array_records": array_records,
    "bronze_day": bronze_day,
    "bronze_days": bronze_days,
    "bronze_malformed": bronze_malformed,
    "raw_table": raw_table,
    "current_table": current_table,
    "staging_view": staging_view,
    "gold_gate": gold_gate,
    "gold_fingerprints": gold_fingerprints,
    "silver_run": silver_run,
    "fact_range": fact_range,
    "gold_run": gold_run,
}
