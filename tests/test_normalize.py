from datetime import date

from pyspark.sql import functions as F

from safetymart.operators.normalize import (
    normalize_fda,
    normalize_fsis,
    normalize_state,
    union_feeds,
)
from safetymart.schemas import UNIFIED_COLUMNS


def test_fda_fields(fda):
    out = normalize_fda(
        fda(
            {
                "recall_number": "F-1",
                "classification": "Class I",
                "reason_for_recall": "glass",
                "recall_initiation_date": "20240105",
                "report_date": "20240231",
                "recalling_firm": "Acme",
                "state": "CA",
                "product_quantity": "5 cases",
            }
        )
    )
    assert tuple(out.columns) == UNIFIED_COLUMNS
    row = out.first()
    assert row["recall_id"] == "F-1" and row["source_agency"] == "FDA"
    assert row["recall_date"] == date(2024, 1, 5) and row["report_date"] is None
    assert row["company"] == "Acme" and row["reason"] == "glass"
    assert row["city"] is None and row["product_quantity"] == "5 cases"


def test_fsis_fields(fsis):
    out = normalize_fsis(
        fsis(
            {
                "field_title": "Ham",
                "field_recall_classification": "Class II",
                "field_recall_date": "2024-01-05",
                "field_establishment": "Acme",
                "field_states": "Texas, Ohio",
            }
        )
    )
    assert tuple(out.columns) == UNIFIED_COLUMNS
    row = out.first()
    assert row["recall_date"] == row["report_date"] == date(2024, 1, 5)
    assert row["state"] == "Texas"
    assert row["city"] == row["distribution_pattern"] == "Texas, Ohio"
    assert row["product_description"] == "Ham" and row["status"] == "Ongoing"
    assert row["voluntary_mandated"] is None and row["product_quantity"] is None


def test_fsis_status(fsis):
    raw = fsis(
        *[{"field_title": t, "field_closed_date": d} for t, d in
          (("a", None), ("b", ""), ("c", "2024-01-01"))]
    )

    def status(df):
        return [r["status"] for r in df.orderBy("product_description").collect()]

    assert status(normalize_fsis(raw)) == ["Ongoing", "Completed", "Completed"]
    strict = normalize_fsis(raw, blank_is_null=True)
    assert status(strict) == ["Ongoing", "Ongoing", "Completed"]


def test_equal_fsis_records_get_equal_ids(fsis):
    record = {"field_title": "Ham", "field_recall_date": "2024-01-05"}
    changed = {**record, "field_closed_date": "2024-02-01"}
    ids = [r["recall_id"] for r in normalize_fsis(fsis(record, record, changed)).collect()]
    assert ids[0] == ids[1] != ids[2]


def test_union_matches_by_name_and_keeps_duplicates(fda, fsis):
    a = normalize_fda(fda({"recall_number": "F-1"}, {"recall_number": "F-1"}))
    b = normalize_fsis(fsis({"field_title": "x"})).select(*reversed(UNIFIED_COLUMNS))
    out = union_feeds(a, b)
    assert out.count() == 3
    assert out.filter("product_description = 'x' AND source_agency = 'FSIS'").count() == 1


def test_state_of_any_column(spark):
    df = spark.createDataFrame([("ohio", 1)], "place string, n int")
    assert normalize_state(df, col="place").first()["place"] == "OH"
    other = normalize_state(df, col="place", codes={"ohio": "X"}).select(F.col("place"))
    assert other.first()["place"] == "X"
