"""Mapping of the raw feeds onto one schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetymart import rules
from safetymart.functions.text import (
    content_key,
    first_list_item,
    parse_date,
    state_code,
)
from safetymart.schemas import FSIS_RAW, UNIFIED_COLUMNS


def normalize_fda(raw: DataFrame) -> DataFrame:
    """FDA records in the unified 14 columns."""
    renamed = {
        "recall_id": F.col("recall_number"),
        "source_agency": F.lit("FDA"),
        "reason": F.col("reason_for_recall"),
        "recall_date": parse_date(F.col("recall_initiation_date"), "yyyyMMdd"),
        "report_date": parse_date(F.col("report_date"), "yyyyMMdd"),
        "company": F.col("recalling_firm"),
    }
    return _unified(raw, renamed)


def normalize_fsis(raw: DataFrame, blank_is_null: bool = False) -> DataFrame:
    """FSIS records in the unified 14 columns.

    The feed has no id, so that the content of a record makes its key. It has
    no city either: the whole list of states stands there. An empty closing
    date counts as closed unless ``blank_is_null``.
    """
    closed = F.col("field_closed_date")
    if blank_is_null:
        closed = F.nullif(F.trim(closed), F.lit(""))
    day = parse_date(F.col("field_recall_date"), "yyyy-MM-dd")
    renamed = {
        "recall_id": content_key("FSIS-", *FSIS_RAW.fieldNames()),
        "source_agency": F.lit("FSIS"),
        "classification": F.col("field_recall_classification"),
        "reason": F.col("field_recall_reason"),
        "recall_date": day,
        "report_date": day,
        "company": F.col("field_establishment"),
        "state": first_list_item(F.col("field_states")),
        "city": F.col("field_states"),
        "product_description": F.col("field_title"),
        "status": F.when(closed.isNotNull(), "Completed").otherwise("Ongoing"),
        "voluntary_mandated": F.lit(None).cast("string"),
        "distribution_pattern": F.col("field_states"),
        "product_quantity": F.lit(None).cast("string"),
    }
    return _unified(raw, renamed)


def _unified(raw: DataFrame, renamed: dict) -> DataFrame:
    """Unified columns in order; those not in ``renamed`` keep their raw name."""
    return raw.select(
        *[renamed.get(name, F.col(name)).alias(name) for name in UNIFIED_COLUMNS]
    )


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of the normalized feeds, duplicates included, matched by name."""
    return reduce(DataFrame.unionByName, feeds)


def normalize_state(
    df: DataFrame, col: str = "state", codes: dict[str, str] = rules.STATE_CODES
) -> DataFrame:
    """Replace state names in ``col`` by their two-letter codes."""
    return df.withColumn(col, state_code(F.col(col), codes))
