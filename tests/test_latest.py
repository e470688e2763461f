import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from safetymart.operators.latest import keep_latest
from safetymart.operators.normalize import normalize_fda
from safetymart.plans.silver import TIE_BREAKERS, latest_notices
from safetymart.schemas import UNIFIED_COLUMNS
from tests.conftest import plan_of


@pytest.fixture
def versions(spark):
    data = [
        ("a", date(2024, 1, 1), "old"),
        ("a", date(2024, 1, 2), "new"),
        ("a", None, "undated"),
        ("b", None, "only"),
        (None, date(2024, 1, 1), "x"),
        (None, date(2024, 1, 2), "y"),
    ]
    return spark.createDataFrame(data, "id string, day date, note string")


def test_latest_wins_and_undated_loses(versions, rows):
    out = keep_latest(versions, ["id"], ["day"]).select("id", "note")
    assert rows(out) == [("a", "new"), ("b", "only")]


def test_null_keys_on_request(versions, rows):
    out = keep_latest(versions, ["id"], ["day"], keep_null_key=True).select("id", "note")
    assert rows(out) == [("a", "new"), ("b", "only"), (None, "y")]


def test_is_idempotent(versions, rows):
    once = keep_latest(versions, ["id"], ["day"])
    assert rows(keep_latest(once, ["id"], ["day"])) == rows(once)


def test_all_columns_but_key_and_dates_break_ties():
    assert set(TIE_BREAKERS) | {"recall_id", "report_date", "recall_date"} == set(
        UNIFIED_COLUMNS
    )
    assert TIE_BREAKERS[:3] == ("company", "product_description", "reason")


def test_ties_do_not_depend_on_the_order_of_input(spark, fda, rows):
    rng = random.Random(3)
    records = [
        {
            "recall_number": f"F-{i % 7}",
            "report_date": "20240105",
            "recalling_firm": rng.choice(["A", "B", None]),
            "product_description": rng.choice(["p", None]),
            "status": rng.choice(["Ongoing", "Completed", None]),
            "city": rng.choice(["x", "y", None]),
        }
        for i in range(200)
    ]
    results = []
    for parts in (1, 3, 8):
        rng.shuffle(records)
        unified = normalize_fda(fda(*records)).repartition(parts)
        results.append(rows(latest_notices(unified)))
    assert len(results[0]) == 7
    assert results[0] == results[1] == results[2]


def test_a_key_with_most_rows_is_cut_down_before_the_shuffle(spark):
    df = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 1000).alias("version"),
        F.col("id").alias("payload"),
    )
    out = keep_latest(df, ["k"], ["version"])
    plan = plan_of(out)
    before, after = plan.rsplit("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "Partial" in after

    assert out.count() == 60_001
    hot = out.filter("k = 'hot'").first()
    assert (hot["version"], hot["payload"]) == (999, 999)

    # Rows that crossed the shuffle: one per key and map task at most.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counted = keep_latest(df, ["k"], ["version"])
        counted.collect()
        stack, written = [counted._jdf.queryExecution().executedPlan()], []
        while stack:
            node = stack.pop()
            if node.nodeName() == "Exchange":
                written.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            stack += [children.apply(i) for i in range(children.size())]
        assert written == [60_000 + 6]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
