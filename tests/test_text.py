from datetime import date

import pytest
from pyspark.sql import functions as F

from safetymart import rules
from safetymart.functions import text as X


def _values(spark, values, expression):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_bad_dates_become_null(spark):
    texts = ["20240229", "20240230", "", "20240105x", "2024-01-05", " 20240105", None]
    got = _values(spark, texts, lambda c: X.parse_date(c, "yyyyMMdd"))
    assert got == [date(2024, 2, 29), None, None, None, None, None, None]


def test_dashed_dates_need_two_digits(spark):
    texts = ["2024-01-05", "2024-1-5", "2024-02-30", "20240105", None]
    got = _values(spark, texts, lambda c: X.parse_date(c, "yyyy-MM-dd"))
    assert got == [date(2024, 1, 5), None, None, None, None]


def test_blank_is_spaces_but_not_tab(spark):
    got = _values(spark, [None, "", "  ", "\t", " a "], X.is_blank)
    assert got == [True, True, True, False, False]


def test_first_list_item(spark):
    lists = ["Texas, Ohio", " Iowa ,Utah", "CA", "", None, ",Maine", "a;b"]
    got = _values(spark, lists, X.first_list_item)
    assert got == ["Texas", "Iowa", "CA", "", None, "", "a;b"]


@pytest.mark.parametrize(
    "raw, code",
    [
        ("California", "CA"),
        (" texas ", "TX"),
        ("NEW HAMPSHIRE", "NH"),
        ("District of Columbia", "DC"),
        ("ny", "NY"),
        (" wa ", "WA"),
        ("zz", "ZZ"),
        ("Puerto Rico", "PUERTO RICO"),
        ("Ontario", "ONTARIO"),
        ("", ""),
        ("   ", ""),
        ("\tTexas", "\tTEXAS"),
        (None, None),
    ],
)
def test_state_code(spark, raw, code):
    assert _values(spark, [raw], lambda c: X.state_code(c, rules.STATE_CODES)) == [code]


def test_there_are_51_states():
    assert len(rules.STATE_CODES) == len(set(rules.STATE_CODES.values())) == 51


def test_content_key_tells_records_apart(spark):
    records = [
        ("a|b", "c"),
        ("a", "b|c"),
        ("~", "c"),
        (None, "c"),
        ("", "c"),
        (None, None),
        ("a|1:b", ""),
        ("a", "b|"),
    ]
    df = spark.createDataFrame(records, "x string, y string")
    keys = [r[0] for r in df.select(X.content_key("K-", "x", "y")).collect()]
    assert len(set(keys)) == len(records)
    assert all(k.startswith("K-") and len(k) == 34 for k in keys)


def test_content_key_is_the_same_in_any_split(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("x"))
    one = {r[0] for r in df.coalesce(1).select(X.content_key("K-", "x")).collect()}
    many = {r[0] for r in df.repartition(9).select(X.content_key("K-", "x")).collect()}
    assert one == many


def test_surrogate_key_spells_nulls(spark):
    import hashlib

    df = spark.createDataFrame([("A", None), (None, "TX"), ("A", "")], "c string, s string")
    key = X.surrogate_key(
        F.col("c"), F.coalesce("s", F.lit("UNKNOWN")), null_marker=rules.KEY_NULL_MARKER
    )
    expected = ["A-UNKNOWN", f"{rules.KEY_NULL_MARKER}-TX", "A-"]
    got = [r[0] for r in df.select(key).collect()]
    assert got == [hashlib.md5(e.encode()).hexdigest() for e in expected]
