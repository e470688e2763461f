"""Staging view, fact, dimensions and aggregates.

The ``agg_*`` functions over year, classification, category and agency take
``weight``: with it they read a table of counts (see ``recall_rollup``) instead
of single notices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetymart import rules as R
from safetymart.functions.text import surrogate_key
from safetymart.operators.aggregates import add_share, count_by
from safetymart.schemas import FACT_COLUMNS, SILVER_COLUMNS

ROLLUP_KEYS = (
    "recall_year",
    "classification",
    "contamination_category",
    "source_agency",
)

# The order that each aggregate is shown in; "-" is descending. The columns after the
# first two only decide between rows that are equal in these.
REPORT_ORDER = {
    "agg_recalls_by_year": ("recall_year", "classification", "source_agency"),
    "agg_contaminants_by_year": ("recall_year", "contamination_category"),
    "agg_recalls_by_state": ("-recall_count", "state", "source_agency"),
    "agg_class1_by_contaminant": (
        "recall_year",
        "-recall_count",
        "contamination_category",
        "source_agency",
    ),
}


def in_report_order(name: str, df: DataFrame) -> DataFrame:
    """The rows of an aggregate in its order. Stored tables have none: a sort for
    reading them would be lost with the next shuffle."""
    order = [
        F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in REPORT_ORDER[name]
    ]
    return df.orderBy(*order)


def stg_recalls(silver: DataFrame) -> DataFrame:
    """Silver rows that have an id."""
    return silver.filter(F.col("recall_id").isNotNull()).select(*SILVER_COLUMNS)


def fct_recalls(stg: DataFrame) -> DataFrame:
    """One row per notice."""
    return stg.select(*FACT_COLUMNS)


def dim_contaminants(df: DataFrame) -> DataFrame:
    """Each category that occurs, with its group."""
    category = F.col("contamination_category")
    group = (
        F.when(category.isin(*R.BIOLOGICAL_CATEGORIES), "Biological")
        .when(category.startswith(R.ALLERGEN_PREFIX), "Allergen")
        .when(category == R.PHYSICAL_CATEGORY, "Physical")
        .when(category == R.LABELING_CATEGORY, "Labeling")
        .otherwise("Other")
    )
    return df.select(category).distinct().withColumn("contaminant_group", group)


def dim_dates(stg: DataFrame, date_col: str = "recall_date") -> DataFrame:
    """Each date that occurs, with its calendar attributes (1 = Sunday)."""
    day = F.col("date_day")
    return (
        stg.select(F.col(date_col).alias("date_day"))
        .filter(day.isNotNull())
        .distinct()
        .select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.quarter(day).alias("quarter"),
            F.dayofweek(day).alias("day_of_week"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.date_format(day, "EEEE").alias("day_name"),
        )
    )


def dim_firms(stg: DataFrame) -> DataFrame:
    """One row per company and state, with its notices and first and last date."""
    firm_id = surrogate_key(
        F.col("company"),
        F.coalesce(F.col("state"), F.lit(R.UNKNOWN_STATE)),
        null_marker=R.KEY_NULL_MARKER,
    )
    return (
        stg.filter(F.col("company").isNotNull())
        .groupBy("company", "state")
        .agg(
            F.count(F.lit(1)).alias("total_recalls"),
            F.min("recall_date").alias("first_recall_date"),
            F.max("recall_date").alias("last_recall_date"),
        )
        .select(
            firm_id.alias("firm_id"),
            "company",
            "state",
            "total_recalls",
            "first_recall_date",
            "last_recall_date",
        )
    )


def recall_rollup(fct: DataFrame) -> DataFrame:
    """Counts by year, classification, category and agency.

    A few thousand rows at any data size: the yearly aggregates, the trend
    reports and the category dimension all follow from this one scan.
    """
    return count_by(fct, *ROLLUP_KEYS)


def agg_recalls_by_year(fct: DataFrame, weight: str | None = None) -> DataFrame:
    return count_by(
        fct.filter(F.col("recall_year").isNotNull()),
        "recall_year",
        "classification",
        "source_agency",
        weight=weight,
    )


def agg_contaminants_by_year(fct: DataFrame, weight: str | None = None) -> DataFrame:
    counts = count_by(
        fct.filter(F.col("recall_year").isNotNull()),
        "recall_year",
        "contamination_category",
        weight=weight,
    )
    return add_share(counts, "recall_year", "recall_count", "pct_of_year")


def agg_class1_by_contaminant(fct: DataFrame, weight: str | None = None) -> DataFrame:
    return count_by(
        fct.filter(
            (F.col("classification") == R.MOST_SERIOUS_CLASS)
            & F.col("recall_year").isNotNull()
        ),
        "recall_year",
        "contamination_category",
        "source_agency",
        weight=weight,
    )


def agg_recalls_by_state(fct: DataFrame) -> DataFrame:
    """Per state and agency: notices, companies (exact) and Class I notices.

    Spark plans the distinct count with a first aggregate on (state, agency,
    company), so that a state with most of the rows is spread over all tasks.
    """
    return (
        fct.filter(F.col("state").isNotNull() & (F.col("state") != ""))
        .groupBy("state", "source_agency")
        .agg(
            F.count(F.lit(1)).alias("recall_count"),
            F.count_distinct("company").alias("unique_firms"),
            F.count_if(F.col("classification") == R.MOST_SERIOUS_CLASS).alias(
                "class_1_count"
            ),
        )
    )
