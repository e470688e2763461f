"""Run statistics and the questions of the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetymart import rules as R
from safetymart.operators.aggregates import add_change, count_by
from safetymart.schemas import QUALITY_COLUMNS


def stats_by_source(silver: DataFrame) -> DataFrame:
    return count_by(silver, "source_agency", name="row_count")


def stats_by_classification(silver: DataFrame) -> DataFrame:
    return count_by(silver, "classification", name="row_count").orderBy(
        F.desc("row_count"), "classification"
    )


def stats_by_category(silver: DataFrame, top: int = 20) -> DataFrame:
    """The most frequent categories; names break ties."""
    return (
        count_by(silver, "contamination_category", name="row_count")
        .orderBy(F.desc("row_count"), "contamination_category")
        .limit(top)
    )


def dq_flag_counts(silver: DataFrame, flags=QUALITY_COLUMNS) -> DataFrame:
    """Rows flagged, per flag, all flags in one scan."""
    counts = silver.agg(*[F.count_if(flag).alias(flag) for flag in flags])
    return counts.unpivot([], list(flags), "flag", "flagged")


def stage_row_counts(unified: DataFrame, silver: DataFrame, fct: DataFrame) -> DataFrame:
    """Rows per stage. Feeds and their union come from one scan."""
    feeds = (
        unified.groupBy()
        .agg(
            *[
                F.count_if(F.col("source_agency") == agency).alias(f"{agency}_raw")
                for agency in R.AGENCIES
            ],
            F.count(F.lit(1)).alias("unified"),
        )
        .unpivot([], [*[f"{a}_raw" for a in R.AGENCIES], "unified"], "stage", "row_count")
    )
    later = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(stage).alias("stage"), "row_count"
        )
        for stage, df in (("silver", silver), ("fct_recalls", fct))
    ]
    return feeds.unionByName(later[0]).unionByName(later[1])


def raw_year_histogram(raw: DataFrame, date_col: str = "field_recall_date") -> DataFrame:
    """Raw records per year, newest first, from the first four characters."""
    return (
        raw.filter(F.length(date_col) >= 4)
        .groupBy(F.substring(date_col, 1, 4).alias("year"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("year"))
    )


def raw_sample(raw: DataFrame, columns: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by the given columns, nulls last: a repeatable peek."""
    return (
        raw.select(*columns)
        .orderBy(*[F.col(c).asc_nulls_last() for c in columns])
        .limit(n)
    )


def describe_columns(df: DataFrame) -> DataFrame:
    """Name and type of each column, in order."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, start=1)]
    schema = "position int, column_name string, column_type string"
    return df.sparkSession.createDataFrame(rows, schema)


def trend_by_year(fct: DataFrame, weight: str | None = None) -> DataFrame:
    """How have notices developed over time?"""
    return count_by(
        fct.filter(F.col("recall_year").isNotNull()), "recall_year", weight=weight
    ).orderBy("recall_year")


def top_contaminants(fct: DataFrame, weight: str | None = None) -> DataFrame:
    """Which contaminants are most common?"""
    return count_by(fct, "contamination_category", weight=weight).orderBy(
        F.desc("recall_count"), "contamination_category"
    )


def contaminant_growth(fct: DataFrame, weight: str | None = None) -> DataFrame:
    """Which contaminants grow fastest? Change to the calendar year before."""
    counts = count_by(
        fct.filter(F.col("recall_year").isNotNull()),
        "contamination_category",
        "recall_year",
        weight=weight,
    )
    return add_change(
        counts, "contamination_category", "recall_year", "recall_count", "growth"
    )


def class1_totals(fct: DataFrame, weight: str | None = None) -> DataFrame:
    """What are the most dangerous notices about?"""
    return count_by(
        fct.filter(
            (F.col("classification") == R.MOST_SERIOUS_CLASS)
            & F.col("recall_year").isNotNull()
        ),
        "contamination_category",
        weight=weight,
    ).orderBy(F.desc("recall_count"), "contamination_category")


def firms_by_state(fct: DataFrame) -> DataFrame:
    """Which states have most recalling firms? A firm under both agencies counts once."""
    return (
        fct.filter(F.col("state").isNotNull() & (F.col("state") != ""))
        .groupBy("state")
        .agg(F.count_distinct("company").alias("unique_firms"))
        .orderBy(F.desc("unique_firms"), "state")
    )
