"""Declarative checks. Every check is an aggregate: no failing row is collected,
and one scan serves all columns of a table where that is possible.

A check is one row (check, model, column, failures); zero failures is a pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetymart import rules as R
from safetymart.schemas import CORRUPT

# Checks on the built tables: model -> column -> what must hold.
UNIQUE = {
    "stg_recalls": ["recall_id"],
    "fct_recalls": ["recall_id"],
    "dim_firms": ["firm_id"],
    "dim_contaminants": ["contamination_category"],
}
NOT_NULL = {
    "stg_recalls": ["recall_id", "classification", "recall_date"],
    "fct_recalls": ["recall_id"],
    "dim_firms": ["firm_id"],
    "dim_contaminants": ["contamination_category"],
}
ACCEPTED = {
    "stg_recalls": {
        "classification": R.CLASSIFICATIONS,
        "source_agency": R.AGENCIES,
    }
}


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of values that occur more than once; nulls do not count."""
    repeated = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .agg(F.count(F.lit(1)).alias("failures"))
    )
    return _labelled(repeated, "unique", model, F.lit(column))


def not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Number of rows that have null, per column, in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _labelled(
        counts.unpivot([], list(columns), "column_name", "failures"),
        "not_null",
        model,
        F.col("column_name"),
    )


def unaccepted_values(
    df: DataFrame, accepted: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Each value outside its column's list, with its rows; null passes.

    One scan for all columns; rows without an offence go no further than a filter.
    """
    offends = {c: ~F.col(c).isin(*values) for c, values in accepted.items()}
    pairs = [
        F.when(offence, F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
        for c, offence in offends.items()
    ]
    return (
        df.filter(reduce(or_, offends.values()))
        .select(F.inline(F.array_compact(F.array(*pairs))))
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def accepted_values(
    df: DataFrame, model: str, accepted: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Number of distinct values outside the list, per column."""
    offending = unaccepted_values(df, accepted)
    counts = offending.agg(
        *[F.count_if(F.col("column_name") == c).alias(c) for c in accepted]
    )
    return _labelled(
        counts.unpivot([], list(accepted), "column_name", "failures"),
        "accepted_values",
        model,
        F.col("column_name"),
    )


def feed_profile(raw: DataFrame, feed: str, required: Sequence[str]) -> DataFrame:
    """Size of a raw feed and its nulls per required field, in one scan.

    One row per required field: (feed, field, missing, row_count, malformed).
    Malformed lines, if the scan tells them, count as neither rows nor nulls.
    """
    valid = F.col(CORRUPT).isNull() if CORRUPT in raw.columns else F.lit(True)
    counts = raw.agg(
        F.count_if(valid).alias("row_count"),
        F.count_if(~valid).alias("malformed"),
        *[F.count_if(valid & F.col(c).isNull()).alias(c) for c in required],
    )
    return counts.unpivot(
        ["row_count", "malformed"], list(required), "field", "missing"
    ).select(F.lit(feed).alias("feed"), "field", "missing", "row_count", "malformed")


def required_fields(raw: DataFrame, feed: str, required: Sequence[str]) -> DataFrame:
    return feed_profile(raw, feed, required).drop("row_count", "malformed")


def min_rows(raw: DataFrame, feed: str, least: int) -> DataFrame:
    """Whether the feed has at least ``least`` rows."""
    return raw.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(feed).alias("feed"),
        F.lit(least).cast("bigint").alias("min_rows"),
        "row_count",
        (F.col("row_count") >= least).alias("passed"),
    )


def model_checks(
    models: Mapping[str, DataFrame],
    unique_columns: Mapping[str, Sequence[str]] = UNIQUE,
    not_null_columns: Mapping[str, Sequence[str]] = NOT_NULL,
    accepted: Mapping[str, Mapping[str, Sequence[str]]] = ACCEPTED,
) -> DataFrame:
    """All declared checks on the tables in ``models``, as one result."""
    checks = [
        unique(models[m], m, c) for m, columns in unique_columns.items() for c in columns
    ]
    checks += [not_null(models[m], m, cols) for m, cols in not_null_columns.items()]
    checks += [accepted_values(models[m], m, lists) for m, lists in accepted.items()]
    return reduce(DataFrame.unionByName, checks)


def _labelled(counts: DataFrame, check: str, model: str, column) -> DataFrame:
    return counts.select(
        F.lit(check).alias("check_name"),
        F.lit(model).alias("model"),
        column.alias("column_name"),
        "failures",
    )
