"""Row-wise enrichments; none of them shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetymart import rules as R
from safetymart.functions.matching import first_match, regex_flags
from safetymart.functions.text import is_blank


def contamination_flags(
    df: DataFrame,
    text_col: str = "reason",
    rules: Sequence = R.CONTAMINATION_RULES,
    literals: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One boolean column per rule, from a search in the whole text."""
    if literals is None and rules is R.CONTAMINATION_RULES:
        literals = R.CONTAMINATION_LITERALS
    patterns = [(name, pattern) for name, _, pattern in rules]
    return regex_flags(df, text_col, patterns, R.FLAG_PREFIX, literals)


def contamination_category(
    df: DataFrame, rules: Sequence = R.CONTAMINATION_RULES
) -> DataFrame:
    """Label of the most important rule that matched, from the flag columns."""
    labels = [(R.FLAG_PREFIX + name, label) for name, label, _ in rules]
    return df.withColumn(
        "contamination_category", first_match(labels, R.DEFAULT_CATEGORY)
    )


def parse_contamination(
    df: DataFrame,
    text_col: str = "reason",
    rules: Sequence = R.CONTAMINATION_RULES,
    literals: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Flags and category; each pattern is searched at most once per row."""
    flagged = contamination_flags(df, text_col, rules, literals)
    return contamination_category(flagged, rules)


def add_time_dimensions(df: DataFrame, date_col: str = "recall_date") -> DataFrame:
    return df.withColumns(
        {
            "recall_year": F.year(date_col),
            "recall_month": F.month(date_col),
            "recall_quarter": F.quarter(date_col),
        }
    )


def add_data_quality_flags(df: DataFrame) -> DataFrame:
    """Flags for missing values; a blank classification is not flagged."""
    return df.withColumns(
        {
            "dq_missing_state": is_blank(F.col("state")),
            "dq_missing_reason": is_blank(F.col("reason")),
            "dq_missing_classification": F.col("classification").isNull(),
            "dq_missing_recall_date": F.col("recall_date").isNull(),
        }
    )
