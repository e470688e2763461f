"""What the plans must look like for large inputs."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from safetymart import session
from safetymart.operators import marts, quality
from safetymart.plans.silver import build_silver
from safetymart.schemas import SILVER_COLUMNS
from safetymart.sources.fixtures import fda_raw, fsis_raw
from tests.conftest import plan_of
from verification import roundtrips

SF = "/root/testdata/sf0.001"
LAZY = [
    n for n in entry.queries() if n not in {**entry.roundtrips.QUERIES, **entry.llm_queries()}
]


@pytest.fixture
def static(spark):
    """Plans as they are before adaptive execution rewrites them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    silver = build_silver(fda_raw(spark, SF), fsis_raw(spark, SF))
    silver.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", LAZY)
def test_no_query_leaves_the_engine_or_pairs_rows(spark, static, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for bad in ("Python", "NestedLoopJoin", "CartesianProduct", "CollectLimit"):
        assert bad not in plan


def test_silver_is_one_shuffle(spark, static):
    plan = plan_of(entry.queries()["silver_recalls"](spark, SF))
    assert re.findall(r"Exchange (\w+)\(recall_id", plan) == ["hashpartitioning"]
    assert plan.count("Exchange hashpartitioning") == 1
    top, below = plan.split("Exchange hashpartitioning")
    assert "RLIKE" in top and "RLIKE" not in below


def test_row_wise_queries_do_not_shuffle(spark, static):
    for name in ("normalize_fda", "contam_category", "normalize_state", "dq_flags"):
        assert "Exchange hashpartitioning" not in plan_of(entry.queries()[name](spark, SF))


def test_marts_read_only_their_columns(stored, static):
    reads = {
        marts.agg_recalls_by_year: {"classification", "recall_year", "source_agency"},
        marts.agg_contaminants_by_year: {"recall_year", "contamination_category"},
        marts.agg_recalls_by_state: {"state", "source_agency", "company", "classification"},
        marts.dim_firms: {"company", "state", "recall_date"},
        marts.dim_dates: {"recall_date"},
    }
    for build, columns in reads.items():
        schema = re.search(r"ReadSchema: struct<(.*)>", plan_of(build(stored))).group(1)
        assert {c.split(":")[0] for c in schema.split(",")} == columns


def test_filters_reach_the_scan(stored, static):
    plan = plan_of(marts.agg_class1_by_contaminant(stored))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "EqualTo(classification,Class I)" in pushed
    assert "IsNotNull(recall_year)" in pushed


def test_distinct_count_spreads_a_large_state(stored, static):
    plan = plan_of(marts.agg_recalls_by_state(stored))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert [re.sub(r"#\d+L?", "", k) for k in keys] == [
        "state, source_agency",
        "state, source_agency, company",
    ]


def test_grouped_counts_combine_before_the_shuffle(stored, static):
    for build in (marts.recall_rollup, marts.dim_firms, marts.dim_dates):
        _, below = plan_of(build(stored)).split("Exchange hashpartitioning", 1)
        assert "HashAggregate" in below
    unique = plan_of(quality.unique(stored, "m", "recall_id"))
    assert "HashAggregate" in unique.rsplit("Exchange hashpartitioning", 1)[1]


def test_checks_of_one_table_are_one_scan(stored, static):
    plan = plan_of(quality.not_null(stored, "m", list(SILVER_COLUMNS)))
    assert plan.count("FileScan") == 1
    lists = {"classification": ["a"], "source_agency": ["b"], "status": ["c"]}
    assert plan_of(quality.accepted_values(stored, "m", lists)).count("FileScan") == 1


def test_models_share_the_shuffle_of_the_silver_rows(spark, static):
    plan = plan_of(entry.queries()["dq_not_null"](spark, SF))
    assert plan.count("FileScan") == 3
    assert plan.count("ReusedExchange") >= 3


def test_partitions_follow_the_size_of_the_input():
    tb = 1024**4
    assert session.partitions_for(10, 200) == 200
    assert session.partitions_for(tb, 200) == 4096
    assert session.partitions_for(100 * tb, 200) == 409_600
    assert session.partitions_for(100 * tb, 500_000) == 500_000


def test_shuffles_are_sized_within_the_block_only(spark, stored, monkeypatch):
    monkeypatch.setattr(session, "PARTITION_BYTES", 10_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.sized_shuffles(stored) as partitions:
        assert partitions > int(before)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(partitions)
        assert stored.groupBy("state").count().agg(F.sum("count")).first()[0] == 1537
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert one.startswith(f"{shared}/x-") and one != two


def test_the_gate_joins_its_rows_once(spark, fda, fsis, rows, monkeypatch):
    def notice(number, firm, state):
        return {
            "recall_number": number, "recalling_firm": firm, "state": state,
            "classification": "Class I", "recall_initiation_date": "20200102",
        }

    raw = fda(
        notice("F-1", "A", "UNKNOWN"), notice("F-2", "A", None), notice("F-3", "B", "TX"),
        notice("F-4", None, "UNKNOWN"), notice("F-5", "C", None), notice(None, "B", "TX"),
        {**notice("F-6", "B", "TX"), "classification": None},
    )
    monkeypatch.setattr(roundtrips, "fda_raw", lambda *_: raw)
    monkeypatch.setattr(roundtrips, "fsis_raw", lambda *_: fsis())
    plans, days = [], []
    run_gold, write = roundtrips.run_gold, roundtrips.tables.write_silver

    def recorded(spark, silver, *args, **more):
        plans.append(plan_of(silver))
        return run_gold(spark, silver, *args, **more)

    monkeypatch.setattr(roundtrips, "run_gold", recorded)
    monkeypatch.setattr(
        roundtrips.tables, "write_silver", lambda df, *a: days.append(a) or write(df, *a)
    )
    assert rows(roundtrips.gold_gate(spark, SF)) == [(2020, "Class I", "FDA", 3, 1)]
    # Each build reads its rows several times; none may join or shuffle them anew.
    assert not any("Join" in plan for plan in plans)
    assert len(days) == 1
