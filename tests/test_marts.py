from datetime import date

import pytest
from pyspark.sql import functions as F

from safetymart.operators import marts, reports
from safetymart.operators.aggregates import add_change
from safetymart.plans.gold import ROLLUP_MARTS, build_gold
from safetymart.plans.silver import build_silver
from safetymart.schemas import FACT_COLUMNS, SILVER_COLUMNS
from safetymart.sources.fixtures import fda_raw, fsis_raw

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def silver(spark):
    df = build_silver(fda_raw(spark, SF), fsis_raw(spark, SF)).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def fct(silver):
    return marts.fct_recalls(marts.stg_recalls(silver))


@pytest.fixture
def firms(spark):
    def make(*records):
        schema = "company string, state string, recall_date date"
        return spark.createDataFrame(list(records), schema)

    return make


def test_silver_has_the_known_size_and_columns(silver):
    assert tuple(silver.columns) == SILVER_COLUMNS and len(SILVER_COLUMNS) == 34
    assert silver.count() == 1537
    assert silver.select("recall_id").distinct().count() == 1537
    flagged = {r["flag"]: r["flagged"] for r in reports.dq_flag_counts(silver).collect()}
    assert flagged == {
        "dq_missing_state": 416,
        "dq_missing_reason": 150,
        "dq_missing_classification": 0,
        "dq_missing_recall_date": 24,
    }


def test_silver_does_not_depend_on_the_split(spark, silver):
    again = build_silver(
        fda_raw(spark, SF).repartition(7), fsis_raw(spark, SF).repartition(3)
    )
    assert again.exceptAll(silver).count() == silver.exceptAll(again).count() == 0


def test_a_matched_flag_is_never_other(silver):
    flags = [c for c in silver.columns if c.startswith("contam_")]
    some = F.greatest(*[F.col(c) for c in flags])
    odd = silver.filter(some == (F.col("contamination_category") == "Other"))
    assert odd.count() == 0


def test_staging_drops_rows_without_id(silver):
    no_id = silver.withColumn("recall_id", F.lit(None).cast("string"))
    assert marts.stg_recalls(silver.unionByName(no_id)).count() == silver.count()


def test_fact_columns(fct):
    assert tuple(fct.columns) == FACT_COLUMNS
    assert set(FACT_COLUMNS) == set(SILVER_COLUMNS)


def test_models(silver):
    models = build_gold(marts.stg_recalls(silver))
    assert models["agg_contaminants_by_year"].count() == 107
    assert models["dim_contaminants"].count() == 13
    assert models["dim_dates"].count() == 1199
    assert len(models) == 8


@pytest.mark.parametrize("name", list(ROLLUP_MARTS))
def test_marts_from_counts_equal_marts_from_rows(fct, rows, name):
    rollup = marts.recall_rollup(fct)
    build = ROLLUP_MARTS[name]
    assert rows(build(rollup, weight="recall_count")) == rows(build(fct))


def test_reports_from_counts_equal_reports_from_rows(fct, rows):
    rollup = marts.recall_rollup(fct)
    for build in (
        reports.trend_by_year,
        reports.top_contaminants,
        reports.contaminant_growth,
        reports.class1_totals,
    ):
        assert rows(build(rollup, weight="recall_count")) == rows(build(fct))
    assert rows(marts.dim_contaminants(rollup)) == rows(marts.dim_contaminants(fct))


def test_shares_add_up(fct):
    shares = marts.agg_contaminants_by_year(fct)
    totals = shares.groupBy("recall_year").agg(F.sum("pct_of_year").alias("s")).collect()
    assert all(abs(r["s"] - 100) < 0.1 for r in totals)


def test_yearly_counts_add_up(fct):
    total = marts.agg_recalls_by_year(fct).agg(F.sum("recall_count")).first()[0]
    assert total == fct.filter("recall_year IS NOT NULL").count()


def test_groups_of_categories(spark, rows):
    names = ["Salmonella", "Listeria", "E. coli", "Undeclared Allergen - Soy",
             "Foreign Object", "Mislabeling", "Other", "New"]
    df = spark.createDataFrame([(n,) for n in names * 2], "contamination_category string")
    assert dict(map(tuple, marts.dim_contaminants(df).collect())) == {
        "Salmonella": "Biological",
        "Listeria": "Biological",
        "E. coli": "Biological",
        "Undeclared Allergen - Soy": "Allergen",
        "Foreign Object": "Physical",
        "Mislabeling": "Labeling",
        "Other": "Other",
        "New": "Other",
    }


def test_dates_are_those_that_occur(firms, rows):
    df = firms(("A", "TX", date(2024, 1, 7)), ("B", "TX", date(2024, 1, 7)), ("C", "", None))
    assert rows(marts.dim_dates(df)) == [
        (date(2024, 1, 7), 2024, 1, 1, 1, "January", "Sunday")
    ]


def test_firms(firms, rows):
    df = firms(
        ("A", "TX", date(2024, 1, 7)),
        ("A", "TX", date(2023, 1, 7)),
        ("A", "TX", None),
        ("A", "", None),
        (None, "TX", None),
    )
    out = marts.dim_firms(df).drop("firm_id")
    assert rows(out) == [
        ("A", "", 1, None, None),
        ("A", "TX", 3, date(2023, 1, 7), date(2024, 1, 7)),
    ]


def test_firm_keys_collide_where_the_spelling_does(firms):
    unknown = marts.dim_firms(firms(("A", None, None), ("A", "UNKNOWN", None)))
    hyphen = marts.dim_firms(firms(("A-B", "C", None), ("A", "B-C", None)))
    blank = marts.dim_firms(firms(("A", None, None), ("A", "", None)))
    for df, keys in ((unknown, 1), (hyphen, 1), (blank, 2)):
        assert df.count() == 2
        assert df.select("firm_id").distinct().count() == keys


def test_by_state(spark, rows):
    data = [
        ("TX", "FDA", "A", "Class I"),
        ("TX", "FDA", "A", "Class II"),
        ("TX", "FDA", None, None),
        ("TX", "FSIS", "A", "Class I"),
        ("", "FDA", "A", "Class I"),
        ("  ", "FDA", "B", "Class I"),
        (None, "FDA", "A", "Class I"),
    ]
    schema = "state string, source_agency string, company string, classification string"
    df = spark.createDataFrame(data, schema)
    assert rows(marts.agg_recalls_by_state(df)) == [
        ("  ", "FDA", 1, 1, 1),
        ("TX", "FDA", 3, 1, 1),
        ("TX", "FSIS", 1, 1, 1),
    ]
    assert rows(reports.firms_by_state(df)) == [("  ", 1), ("TX", 1)]


def test_growth_needs_the_year_before(spark, rows):
    data = [("a", 2001, 5), ("a", 2002, 3), ("a", 2004, 9), ("b", 2002, 1)]
    df = spark.createDataFrame(data, "c string, y int, n long")
    assert rows(add_change(df, "c", "y", "n", "growth")) == [
        ("a", 2001, 5, None),
        ("a", 2002, 3, -2),
        ("a", 2004, 9, None),
        ("b", 2002, 1, None),
    ]


def test_top_categories_break_ties_by_name(spark):
    df = spark.createDataFrame(
        [(c,) for c in "bbaacd"], "contamination_category string"
    )
    got = [tuple(r) for r in reports.stats_by_category(df, top=3).collect()]
    assert got == [("a", 2), ("b", 2), ("c", 1)]


def test_year_histogram(spark):
    texts = ["2024-01-01", "2024", "199", "", None, "1999-x"]
    df = spark.createDataFrame([(t,) for t in texts], "field_recall_date string")
    got = [tuple(r) for r in reports.raw_year_histogram(df).collect()]
    assert got == [("2024", 2), ("1999", 1)]


def test_sample_is_repeatable(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "k string, n int")
    for parts in (1, 3):
        got = reports.raw_sample(df.repartition(parts), ["k"], 2).collect()
        assert [r["k"] for r in got] == ["a", "b"]


def test_description_of_columns(spark):
    df = spark.createDataFrame([], "a string, b date, c array<int>")
    assert [tuple(r) for r in reports.describe_columns(df).collect()] == [
        (1, "a", "string"),
        (2, "b", "date"),
        (3, "c", "array<int>"),
    ]


def test_aggregates_are_shown_in_order(spark):
    import __spark_entry__ as entry

    for name, order in marts.REPORT_ORDER.items():
        found = entry.queries()[name](spark, "/root/testdata/sf0.001").collect()

        def place(row, order=order):
            keys = []
            for column in order:
                value = row[column.lstrip("-")]
                keys.append((value is not None, value) if column[0] != "-" else (True, -value))
            return [(there, value if there else 0) for there, value in keys]

        assert len(found) > 1 and found == sorted(found, key=place)


def test_equal_rows_have_equal_fingerprints(spark):
    from safetymart.operators.fingerprint import fingerprint

    rows = [(1, "a", 0.5, True), (1, "a", 0.5, True), (2, None, None, False), (3, "b|1:c", 1e-7, None)]
    table = spark.createDataFrame(rows, "n long, t string, x double, f boolean")
    first = fingerprint(table, "m").collect()
    assert fingerprint(table.select("x", "t", "f", "n").orderBy(F.desc("n")).repartition(3), "m").collect() == first
    for other in (table.distinct(), table.withColumn("t", F.coalesce("t", F.lit("~"))), table.limit(0)):
        assert fingerprint(other, "m").collect() != first
    assert tuple(fingerprint(table.limit(0), "m").first()) == ("m", 0, "0")
