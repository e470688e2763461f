"""Generic aggregate building blocks.

All of them are ``groupBy`` aggregates with a map-side partial step, so that a
group holding a third of all rows reaches its reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_count(weight: str | None = None) -> Column:
    """Number of rows; over a table of counts, the sum of the ``weight`` column."""
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def count_by(
    df: DataFrame, *keys: str, name: str = "recall_count", weight: str | None = None
) -> DataFrame:
    return df.groupBy(*keys).agg(row_count(weight).alias(name))


def add_share(
    counts: DataFrame, within: str, count_col: str, out: str, digits: int = 2
) -> DataFrame:
    """Percentage that each row of ``counts`` has in its ``within`` group.

    ``counts`` is aggregated input: a group holds one row per category, a number
    set by the rules and not by the data.
    """
    total = F.sum(count_col).over(Window.partitionBy(within))
    return counts.withColumn(out, F.round(F.col(count_col) * F.lit(100.0) / total, digits))


def add_change(
    counts: DataFrame, series: str, period: str, count_col: str, out: str
) -> DataFrame:
    """Difference to the period just before, null when that period has no row.

    ``counts`` is aggregated input: a series holds one row per period.
    """
    by_period = Window.partitionBy(series).orderBy(period)
    follows = F.col(period) - F.lag(period).over(by_period) == 1
    change = F.col(count_col) - F.lag(count_col).over(by_period)
    return counts.withColumn(out, F.when(follows, change))
