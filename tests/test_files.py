import json
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from safetymart.plans.gold import MODELS, QualityError, gold_views, read_gold, run_gold
from safetymart.plans.silver import FeedError, run_silver
from conftest import plan_of
from safetymart.operators.quality import feed_profile
from safetymart.schemas import CORRUPT, FDA_RAW, FSIS_RAW
from safetymart.session import settings
from safetymart.sources import bronze, layout, tables

DAY = "2024-04-14"


def _write(folder, *lines, name="data.json"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines))


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def _day(base, feed, day=DAY):
    return Path(layout.day_dir(layout.feed_dir(base, feed), day))


# --- Layout --------------------------------------------------------------------


def test_layout_pads_parts():
    folder = layout.day_dir(layout.feed_dir("b/", "fda"), date(2024, 4, 5))
    assert folder == "b/raw/fda/year=2024/month=04/day=05"
    assert layout.day_dir("x", "2024-04-05") == "x/year=2024/month=04/day=05"
    assert layout.as_day(None) == datetime.now(timezone.utc).date()


def test_days_are_found_by_listing(spark, base):
    for day in ("2024-04-14", "2023-12-31", "2024-04-07"):
        _write(_day(base, "fda", day), "{}")
    folder = layout.feed_dir(base, "fda")
    assert layout.list_days(spark, folder) == [
        date(2023, 12, 31),
        date(2024, 4, 7),
        date(2024, 4, 14),
    ]
    assert layout.resolve_day(spark, folder, DAY) == date(2024, 4, 14)
    assert layout.resolve_day(spark, folder, "2024-04-13", as_of=True) == date(2024, 4, 7)
    for day, as_of in (("2024-04-13", False), ("2023-01-01", True)):
        with pytest.raises(layout.MissingFeedError):
            layout.resolve_day(spark, folder, day, as_of)


def test_a_failed_write_leaves_the_old_data(spark, base):
    target = f"{base}/table"
    tables.replace_table(spark.range(3), target)

    def fail(path):
        spark.range(5).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        layout.replace_dir(spark, target, fail)
    assert spark.read.parquet(target).count() == 3
    assert [p.name for p in Path(base).iterdir()] == ["table"]


def test_a_table_can_be_replaced_by_what_was_read_from_it(spark, base):
    target = f"{base}/table"
    tables.replace_table(spark.range(10), target)
    tables.replace_table(spark.read.parquet(target).filter("id < 4"), target)
    assert spark.read.parquet(target).count() == 4


def test_new_content_stands_beside_the_old():
    for path, prefix in (("s3a://b/x/gold/", "s3a://b/x/"), ("/gold", "/"), ("gold", "")):
        fresh, retired = layout.hidden_beside(path)
        assert fresh.startswith(f"{prefix}.gold.new-")
        assert retired.startswith(f"{prefix}.gold.old-")


# --- Bronze --------------------------------------------------------------------


def test_landed_records_come_back(spark, base, fda, rows):
    raw = fda({"recall_number": "F-1", "state": "a\nb"}, {"recall_number": None, "state": ""})
    folder = bronze.land_bronze(raw, base, "fda", DAY)
    assert folder == str(_day(base, "fda"))
    assert rows(bronze.well_formed(bronze.scan_bronze(spark, base, "fda", DAY))) == rows(raw)


def test_landing_again_replaces_that_day_only(spark, base, fda):
    bronze.land_bronze(fda({"recall_number": "F-0"}), base, "fda", "2024-04-07")
    for records in ([{"recall_number": "F-1"}, {"recall_number": "F-2"}], []):
        bronze.land_bronze(fda(*records), base, "fda", DAY)
        scan = bronze.scan_bronze(spark, base, "fda", DAY)
        assert scan.count() == len(records)
    assert bronze.scan_bronze(spark, base, "fda", "2024-04-07").count() == 1


def test_landing_can_sort(spark, base, fda):
    raw = fda(*[{"recall_number": str(i), "report_date": f"202401{30 - i}"} for i in range(9)])
    bronze.land_bronze(raw.coalesce(1), base, "fda", DAY, order_by="report_date")
    lines = [p.read_text().splitlines() for p in _day(base, "fda").glob("part-*")]
    days = [json.loads(line)["report_date"] for line in lines[0]]
    assert len(lines) == 1 and days == sorted(days)
    texts = spark.read.text(str(_day(base, "fda"))).orderBy(F.desc("value")).coalesce(1)
    bronze.land_bronze(texts, base, "fda", "2024-04-15", order_by="report_date")
    lines = [p.read_text().splitlines() for p in _day(base, "fda", "2024-04-15").glob("part-*")]
    assert [json.loads(line)["report_date"] for line in lines[0]] == days


def test_malformed_and_incomplete_lines(spark, base, rows):
    _write(
        _day(base, "fda"),
        '{"recall_number": "F-1", "classification": "Class I"}',
        '{"recall_number": "F-2", "classification"',
        '{"recall_number": "F-3", "extra": {"a": 1}, "state": null}',
    )
    scan = bronze.scan_bronze(spark, base, "fda", DAY)
    assert scan.columns == [*FDA_RAW.fieldNames(), CORRUPT]
    good = bronze.well_formed(scan).select("recall_number", "classification", "city")
    assert rows(good) == [("F-1", "Class I", None), ("F-3", None, None)]
    bad = bronze.malformed(scan).collect()
    assert [r["line"] for r in bad] == ['{"recall_number": "F-2", "classification"']


def test_range_of_days_reads_only_their_folders(spark, base, fda, rows):
    for i, day in enumerate(("2023-12-31", "2024-04-07", "2024-04-14")):
        bronze.land_bronze(fda({"recall_number": f"F-{i}"}), base, "fda", day)
    days = bronze.scan_bronze_days(spark, base, "fda", "2024-01-01", "2024-04-14")
    assert rows(days.select("recall_number", "ingest_date")) == [
        ("F-1", date(2024, 4, 7)),
        ("F-2", date(2024, 4, 14)),
    ]
    assert {f.split("/raw/")[1].rsplit("/", 1)[0] for f in days.inputFiles()} == {
        "fda/year=2024/month=04/day=07",
        "fda/year=2024/month=04/day=14",
    }
    with pytest.raises(layout.MissingFeedError):
        bronze.scan_bronze_days(spark, base, "fda", "2022-01-01", "2022-12-31")


def test_pages(spark, base, rows):
    folder = Path(base) / "pages"
    record = {"recall_number": "F-1", "openfda": {"x": [1, 2]}, "state": None}
    _write(folder, json.dumps({"meta": {}, "results": [record, record]}, indent=1), name="1.json")
    _write(folder, json.dumps({"meta": {}}), name="2.json")
    _write(folder, json.dumps({"results": []}), name="3.json")
    records = bronze.read_pages(spark, str(folder))
    assert [json.loads(r["value"]) for r in records.collect()] == [record, record]
    bronze.land_bronze(records, base, "fda", DAY)
    scan = bronze.well_formed(bronze.scan_bronze(spark, base, "fda", DAY))
    assert rows(scan.select("recall_number", "state")) == [("F-1", None)] * 2


def test_array_feed(spark, base):
    folder = Path(base) / "feed"
    _write(folder, '[\n {"field_title": "a"},\n {"field_title": "b", "n": 1}]', name="1.json")
    _write(folder, "[]", name="2.json")
    records = bronze.read_array_feed(spark, str(folder))
    parsed = bronze.parse_records(records, FSIS_RAW)
    assert sorted(r["field_title"] for r in parsed.collect()) == ["a", "b"]
    assert sorted(r["value"] for r in records.collect())[1] == '{"field_title":"b","n":1}'


@pytest.mark.parametrize("text", ['{"message": "blocked"}', "<html>", " "])
def test_text_that_is_no_array_fails(spark, base, text):
    _write(Path(base) / "feed", text, name="1.json")
    with pytest.raises(Exception, match="expected a JSON array"):
        bronze.read_array_feed(spark, f"{base}/feed").collect()


def test_a_page_that_is_not_json_fails(spark, base):
    _write(Path(base) / "pages", "<html>", name="1.json")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        bronze.read_pages(spark, f"{base}/pages").collect()


def test_raw_table_is_replaced_with_inferred_schema(spark, base):
    _write(_day(base, "x"), '{"a": 1, "b": "t"}', '{"c": null, "a": 2}')
    df = tables.read_inferred(spark, str(_day(base, "x")))
    tables.replace_table(df, f"{base}/raw_table")
    again = spark.read.parquet(f"{base}/raw_table")
    assert dict(again.dtypes) == {"a": "bigint", "b": "string", "c": "string"}
    tables.replace_table(df.filter("a = 1"), f"{base}/raw_table")
    assert spark.read.parquet(f"{base}/raw_table").count() == 1


# --- Silver run ----------------------------------------------------------------


@pytest.fixture
def landed(spark, base, fda, fsis):
    bronze.land_bronze(
        fda(
            {
                "recall_number": "F-1",
                "classification": "Class I",
                "reason_for_recall": "Salmonella",
                "recall_initiation_date": "20240105",
                "report_date": "20240110",
                "recalling_firm": "Acme",
                "state": "texas",
            },
            {
                "recall_number": "F-1",
                "classification": "Class II",
                "recall_initiation_date": "20240105",
                "report_date": "20240111",
                "recalling_firm": "Acme",
                "state": "ohio",
            },
            {"classification": "Class I"},
        ),
        base,
        "fda",
        DAY,
    )
    ham = {
        "field_title": "Ham",
        "field_recall_classification": "Class III",
        "field_recall_date": "2024-02-03",
        "field_recall_reason": "glass",
        "field_states": "Iowa, Utah",
    }
    bronze.land_bronze(fsis(ham, ham), base, "fsis", DAY)
    return base


def test_silver_run(spark, landed):
    run = run_silver(spark, landed, landed, DAY)
    assert run.path == f"{landed}/silver/recalls/year=2024/month=04/day=14"
    silver = run.read(spark).orderBy("recall_id").collect()
    assert run.row_count == len(silver) == 2
    assert silver[0]["recall_id"] == "F-1" and silver[0]["state"] == "OH"
    assert silver[1]["contamination_category"] == "Foreign Object"
    profile = {(r["feed"], r["field"]): r for r in run.feeds}
    assert profile["fda", "recall_number"]["missing"] == 1
    assert profile["fda", "reason_for_recall"]["missing"] == 2
    assert profile["fsis", "field_title"]["row_count"] == 2
    stats = run.summary(spark)
    by_source = {r["source_agency"]: r["row_count"] for r in stats["by_source"].collect()}
    assert by_source == {"FDA": 1, "FSIS": 1}


def test_silver_run_twice_gives_the_same_rows(spark, landed, rows):
    first = rows(run_silver(spark, landed, landed, DAY).read(spark))
    second = rows(run_silver(spark, landed, landed, DAY).read(spark))
    assert first == second


def test_malformed_lines_are_set_aside(spark, landed):
    _write(_day(landed, "fsis"), "not json", name="part-extra.json")
    run = run_silver(spark, landed, landed, DAY, quarantine=f"{landed}/bad")
    assert run.row_count == 2
    assert {r["feed"]: r["malformed"] for r in run.feeds} == {"fda": 0, "fsis": 1}
    assert spark.read.json(f"{landed}/bad/fsis").first()["line"] == "not json"
    assert not Path(f"{landed}/bad/fda").exists()


def test_each_feed_is_read_once(spark, landed, monkeypatch, rows):
    """The raw files are gone once they were staged, and nothing is missing."""
    import shutil

    from safetymart.plans import silver

    expected = rows(run_silver(spark, landed, f"{landed}/a", DAY).read(spark))
    read = silver.stage_feed

    def read_and_remove(scan, folder):
        staged = read(scan, folder)
        shutil.rmtree(_day(landed, folder.rpartition("/")[2]))
        return staged

    monkeypatch.setattr(silver, "stage_feed", read_and_remove)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run = run_silver(spark, landed, f"{landed}/b", DAY, quarantine=f"{landed}/bad")
    assert rows(run.read(spark)) == expected
    assert {r["feed"]: r["malformed"] for r in run.feeds} == {"fda": 0, "fsis": 0}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert not list(Path(f"{landed}/b").glob(".stage*"))


def test_counts_come_from_footers(spark, landed):
    from safetymart.sources.staging import stage_feed

    _write(_day(landed, "fda"), '{"recall_number": null}\nbroken\n\n{"state": 1', name="part-x.json")
    scan = bronze.scan_bronze(spark, landed, "fda", DAY)
    expected = {r["field"]: r for r in feed_profile(scan, "fda", ["recall_number", "state"]).collect()}
    staged = stage_feed(scan, f"{landed}/staged")
    assert {r["field"]: r for r in staged.profile("fda", ["recall_number", "state"])} == expected
    assert expected["state"]["malformed"] == 2
    plan = plan_of(staged.counts(["state"]))
    assert "PushedAggregation: [COUNT(*), COUNT(state)]" in plan, plan
    assert sorted(r["line"] for r in staged.lines().collect()) == ["broken", '{"state": 1']
    assert all(r["source_file"].endswith("part-x.json") for r in staged.lines().collect())
    assert "(kind#" in plan_of(staged.rows()) and "PartitionFilters: [isnotnull(kind" in plan_of(staged.rows())


def test_small_feeds_stop_the_run(spark, landed):
    with pytest.raises(FeedError, match="fsis"):
        run_silver(spark, landed, landed, DAY, min_rows={"fda": 3, "fsis": 3})
    with pytest.raises(FeedError, match="1 rows without recall_number"):
        run_silver(spark, landed, landed, DAY, require_fields=True)
    assert not Path(f"{landed}/silver").exists()


def test_missing_feed_is_named(spark, base, fda):
    bronze.land_bronze(fda({"recall_number": "F-1"}), base, "fda", DAY)
    with pytest.raises(layout.MissingFeedError, match="fsis"):
        run_silver(spark, base, base, DAY)


def test_as_of_takes_the_latest_day_of_each_feed(spark, landed):
    with pytest.raises(layout.MissingFeedError):
        run_silver(spark, landed, landed, "2024-04-20")
    run = run_silver(spark, landed, landed, "2024-04-20", as_of=True)
    assert run.row_count == 2 and run.path.endswith("day=20")


@pytest.mark.parametrize("copy", [True, False])
def test_current_table_holds_the_last_load(spark, landed, copy):
    table, view = f"current_{copy}".lower(), f"stg_{copy}".lower()
    path = run_silver(spark, landed, landed, DAY).path
    versions = f"{landed}/versions"
    assert tables.load_current(spark, path, table, copy, versions) == 2
    shown = tables.staging_view(spark, table, view)
    reading = spark.table(table)  # planned before the next load
    assert shown.count() == reading.count() == 2
    one = spark.read.parquet(path).filter("recall_id = 'F-1'")
    path = tables.write_silver(one, landed, "2024-04-15")
    assert tables.load_current(spark, path, table, copy, versions) == 1
    assert spark.table(view).first()["recall_id"] == "F-1" and spark.table(view).count() == 1
    assert reading.count() == 2  # the version before is still there
    if copy:
        for _ in range(2):
            tables.load_current(spark, path, table, copy, versions)
        assert len(list(Path(versions).glob("version-*"))) == 2
    with pytest.raises(ValueError, match="other columns"):
        other = tables.write_silver(one.drop("state"), landed, "2024-04-16")
        tables.load_current(spark, other, table, copy, versions)
    spark.sql(f"DROP VIEW {view}")
    spark.sql(f"DROP TABLE {table}")


def test_a_managed_table_is_refused(spark, landed):
    path = run_silver(spark, landed, landed, DAY).path
    spark.range(1).write.saveAsTable("managed")
    with pytest.raises(ValueError, match="managed"):
        tables.load_current(spark, path, "managed")
    spark.sql("DROP TABLE managed")


def test_filters_go_through_the_staging_view(spark, landed):
    path = run_silver(spark, landed, landed, DAY).path
    tables.load_current(spark, path, "seen", copy=False)
    tables.staging_view(spark, "seen", "stg_seen")
    plan = plan_of(spark.sql("SELECT city FROM stg_seen WHERE status = 'Ongoing'"))
    assert "ReadSchema: struct<recall_id:string,city:string,status:string>" in plan
    assert "EqualTo(status,Ongoing)" in plan and "IsNotNull(recall_id)" in plan
    spark.sql("DROP VIEW stg_seen")
    spark.sql("DROP TABLE seen")


# --- Gold run ------------------------------------------------------------------


def test_gold_run_publishes_all_models(spark, landed):
    silver = run_silver(spark, landed, landed, DAY).read(spark)
    checks = run_gold(spark, silver, f"{landed}/gold")
    assert len(checks) == 12 and not any(r["failures"] for r in checks)
    folder = Path(layout.published(spark, f"{landed}/gold"))
    assert {p.name for p in folder.iterdir()} == set(MODELS)
    assert set(gold_views(spark, f"{landed}/gold")) == set(MODELS)
    totals = spark.sql(
        """SELECT (SELECT count(*) FROM fct_recalls) AS rows,
            (SELECT sum(recall_count) FROM agg_recalls_by_year) AS by_year,
            (SELECT count(*) FROM dim_dates) AS dates"""
    )
    assert tuple(totals.first()) == (2, 2, 2)
    assert read_gold(spark, f"{landed}/gold")["dim_firms"].count() == 1


def test_failed_checks_publish_nothing(spark, landed):
    gold = f"{landed}/gold"
    with pytest.raises(layout.MissingFeedError):
        read_gold(spark, gold)
    silver = run_silver(spark, landed, landed, DAY).read(spark)
    run_gold(spark, silver, gold)
    first = layout.published(spark, gold)
    reading = read_gold(spark, gold)["fct_recalls"]
    bad = silver.withColumn("classification", F.lit("Class IV"))
    with pytest.raises(QualityError, match="accepted_values"):
        run_gold(spark, bad, gold)
    assert layout.published(spark, gold) == first
    assert [str(p) for p in Path(gold).glob("version-*")] == [first]
    run_gold(spark, bad, gold, on_failure="warn")
    fct = read_gold(spark, gold)["fct_recalls"]
    assert fct.filter("classification = 'Class IV'").count() == 2
    assert reading.filter("classification = 'Class IV'").count() == 0


def test_the_last_publication_counts(spark, base):
    versions = []
    for _ in range(3):
        version, path = layout.new_version(f"{base}/data/")
        spark.range(len(versions)).write.parquet(path)
        layout.publish(spark, f"{base}/data", version)
        versions.append(version)
        assert layout.published(spark, f"{base}/data/") == f"{base}/data/{version}"
    assert {p.name for p in Path(f"{base}/data").glob("version-*")} == set(versions[1:])
    # Someone else took the next number at the same time: this one takes the one after.
    (Path(base) / "data" / layout.PUBLISHED / f"{4:012d}-version-x").touch()
    layout.publish(spark, f"{base}/data", "version-y")
    assert layout.published(spark, f"{base}/data").endswith("version-y")


def test_command_line(spark, base, capsys):
    from safetymart.__main__ import main

    feeds = Path(base) / "saved"
    page = {"results": [{"recall_number": "F-1", "classification": "Class I",
                         "recall_initiation_date": "20240105", "report_date": "20240105"}]}
    _write(feeds / "fda", json.dumps(page))
    _write(feeds / "fsis", '[{"field_title": "x", "field_recall_date": "2024-01-01", '
                           '"field_recall_classification": "Class II"}]')
    for feed, shape in (("fda", "pages"), ("fsis", "array")):
        main(["land", "--feed", feed, "--shape", shape, "--input", str(feeds / feed),
              "--bronze", base, "--date", DAY])
    main(["all", "--bronze", base, "--silver", base, "--gold", f"{base}/gold", "--date", DAY])
    out = capsys.readouterr().out
    assert "2 rows in" in out
    assert read_gold(spark, f"{base}/gold")["agg_recalls_by_year"].count() == 2


# --- Fact layout ---------------------------------------------------------------


@pytest.fixture
def fact(spark, base):
    """6,000 rows: five in six in one month, some undated."""
    day = F.expr(
        "CASE WHEN id % 6 > 0 THEN DATE '2024-03-05' + CAST(id % 20 AS INT) "
        "WHEN id % 12 = 0 THEN DATE '2023-01-01' + CAST(id % 365 AS INT) END"
    )
    df = spark.range(6000).select(
        F.col("id").cast("string").alias("recall_id"),
        day.alias("recall_date"),
        F.concat(F.lit("Class "), F.col("id") % 3).alias("classification"),
        F.concat(F.lit("S"), F.col("id") % 50).alias("state"),
        F.sha2(F.col("id").cast("string"), 512).alias("reason"),
    )
    return df, f"{base}/fact"


def test_fact_is_partitioned_by_month_and_sorted(spark, fact):
    df, path = fact
    tables.write_fact(df, path)
    months = sorted(p.name for p in Path(path).glob("recall_month_start=*"))
    assert len(months) == 14 and months[-1].endswith("__HIVE_DEFAULT_PARTITION__")
    assert "recall_month_start=2024-03-01" in months
    stored = tables.read_fact(spark, path)
    assert stored.drop(tables.FACT_MONTH).exceptAll(df).count() == 0
    assert stored.count() == 6000
    for file in Path(path).glob("*/*.parquet"):
        keys = spark.read.parquet(str(file)).select("classification", "state").collect()
        assert keys == sorted(keys)


def test_a_month_with_most_rows_is_split(spark, fact):
    df, path = fact
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.enabled": "false",
    }
    with settings(spark, small):
        tables.write_fact(df.repartition(8), path)
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    hot = list(Path(path).glob("recall_month_start=2024-03-01/*.parquet"))
    assert len(hot) > 2
    assert tables.read_fact(spark, path).count() == 6000


def test_a_month_is_split_above_two_thousand_shuffle_partitions(spark, fact):
    df, path = fact
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.shuffle.partitions": "2500",
    }
    with settings(spark, small):
        tables.write_fact(df.repartition(8), path)
    assert len(list(Path(path).glob("recall_month_start=2024-03-01/*.parquet"))) > 2
    assert tables.read_fact(spark, path).count() == 6000


def test_a_bronze_day_is_counted(spark, base):
    folder = _day(base, "fda")
    lines = ['{"recall_number": "a", "state": 1.10}', "{broken", '[{"recall_number": "b"}, {}]', ""]
    folder.mkdir(parents=True)
    (folder / "data.json").write_text("\n".join(lines))
    scan = bronze.scan_bronze(spark, base, "fda", DAY)
    assert bronze.well_formed(scan).count() == 3
    assert bronze.malformed(scan).count() == 1
    assert [r["line"] for r in bronze.malformed(scan).select("line").collect()] == ["{broken"]
    states = [r["state"] for r in bronze.well_formed(scan).collect()]
    assert states == ["1.10", None, None]


@pytest.mark.parametrize("text", ["", " \n"])
def test_an_empty_response_fails(spark, base, tmp_path, text):
    response = tmp_path / "response"
    response.mkdir()
    (response / "one.json").write_text(text)
    for read in (bronze.read_pages, bronze.read_array_feed):
        with pytest.raises(Exception, match="(?i)empty|JSON"):
            read(spark, str(response)).collect()


def test_quarantine_is_by_day_and_needs_no_checks(spark, landed):
    _write(_day(landed, "fsis"), "not json", name="part-extra.json")
    for day in (DAY, "2024-04-20"):
        run_silver(spark, landed, landed, day, as_of=True, quarantine=f"{landed}/bad")
    days = sorted(str(p.relative_to(landed)) for p in Path(landed).glob("bad/fsis/*/*/*"))
    assert days == [f"bad/fsis/year=2024/month=04/day={d}" for d in (DAY[-2:], "20")]
    assert spark.read.json(f"{landed}/{days[0]}").count() == 1


def test_date_range_prunes_months(spark, fact):
    df, path = fact
    tables.write_fact(df, path)
    stored = tables.read_fact(spark, path)
    some = tables.fact_between(stored, "2023-02-10", "2023-03-20")
    plain = df.filter("recall_date BETWEEN DATE '2023-02-10' AND DATE '2023-03-20'")
    assert some.count() == plain.count() > 0
    files = {Path(f).parent.name for f in some.inputFiles()}
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "recall_month_start" in filters and "2023-02-01" in plan
    scanned = some.select(F.input_file_name().alias("f")).distinct().collect()
    assert {Path(r["f"]).parent.name for r in scanned} == {
        "recall_month_start=2023-02-01",
        "recall_month_start=2023-03-01",
    }
    assert files
