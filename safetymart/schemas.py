"""Explicit schemas: reading with them needs no inference pass over the data,
and a field that one day's feed leaves out becomes null instead of failing."""

from __future__ import annotations

from pyspark.sql import types as T

from safetymart.rules import CONTAMINATION_RULES, FLAG_PREFIX

# Column holding the text of a line that is not valid JSON.
CORRUPT = "_corrupt_record"


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


FDA_RAW = _strings(
    "recall_number",
    "classification",
    "reason_for_recall",
    "recall_initiation_date",
    "report_date",
    "recalling_firm",
    "state",
    "city",
    "product_description",
    "status",
    "voluntary_mandated",
    "distribution_pattern",
    "product_quantity",
)

FSIS_RAW = _strings(
    "field_title",
    "field_recall_classification",
    "field_recall_reason",
    "field_recall_date",
    "field_establishment",
    "field_states",
    "field_closed_date",
)

FEEDS = {"fda": FDA_RAW, "fsis": FSIS_RAW}

UNIFIED_COLUMNS = (
    "recall_id",
    "source_agency",
    "classification",
    "reason",
    "recall_date",
    "report_date",
    "company",
    "state",
    "city",
    "product_description",
    "status",
    "voluntary_mandated",
    "distribution_pattern",
    "product_quantity",
)

CONTAMINATION_COLUMNS = tuple(
    FLAG_PREFIX + name for name, _, _ in CONTAMINATION_RULES
)
TIME_COLUMNS = ("recall_year", "recall_month", "recall_quarter")
QUALITY_COLUMNS = (
    "dq_missing_state",
    "dq_missing_reason",
    "dq_missing_classification",
    "dq_missing_recall_date",
)

SILVER_COLUMNS = (
    *UNIFIED_COLUMNS,
    "contamination_category",
    *CONTAMINATION_COLUMNS,
    *TIME_COLUMNS,
    *QUALITY_COLUMNS,
)

# The fact table holds the same columns, those of common filters first.
FACT_COLUMNS = (
    "recall_id",
    "source_agency",
    "classification",
    "reason",
    "contamination_category",
    "recall_date",
    "report_date",
    *TIME_COLUMNS,
    "company",
    "state",
    "city",
    "product_description",
    "status",
    "voluntary_mandated",
    "distribution_pattern",
    "product_quantity",
    *CONTAMINATION_COLUMNS,
    *QUALITY_COLUMNS,
)
