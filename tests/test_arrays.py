"""One JSON array cut by many tasks, against a JSON parser."""

import json
import random

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from conftest import plan_of
from safetymart.sources import arrays
from verification import roundtrips


def _value(rng, depth=0):
    kind = rng.random()
    if kind < 0.25:
        return rng.choice(["a}", '{"', "\\", '\\"}', "]", "é}{", "", "x" * 50, ",", '"'])
    if kind < 0.4:
        return rng.choice([rng.randint(0, 99), None, True])
    count = rng.randint(0, 4) if depth < 3 else 0
    if kind < 0.75:
        return {rng.choice("abc") + str(i): _value(rng, depth + 1) for i in range(count)}
    return [_value(rng, depth + 1) for _ in range(count)]


def _elements(spark, text):
    """What Spark's own reading of the whole text gives."""
    whole = spark.createDataFrame([(text,)], "v string")
    found = whole.selectExpr("explode(from_json(v, 'array<string>'))").collect()
    return sorted(str(r[0]) for r in found)


@pytest.mark.parametrize("size", [0, 1, 2, 150])
@pytest.mark.parametrize("split", [50, 700, None])
def test_any_array_in_any_splits(spark, tmp_path, size, split):
    rng = random.Random(size)
    for k in range(2):
        array = [_value(rng) for _ in range(size)]
        text = json.dumps(array, indent=[None, 1][k], ensure_ascii=k == 0) + ["", " \n"][k]
        (tmp_path / f"{k}.json").write_text(text, encoding="utf-8")
        got = arrays.array_elements(spark, str(tmp_path / f"{k}.json"), split)
        assert sorted(str(r["value"]) for r in got.collect()) == _elements(spark, text)


def test_one_file_is_cut_by_many_tasks(spark, tmp_path):
    records = [{"id": i, "text": "} " * (i % 3), "list": [{"n": i}] * (i % 2)} for i in range(3000)]
    (tmp_path / "a.json").write_text(json.dumps(records))
    (tmp_path / "b.json").write_text(json.dumps(records[:10]))
    got = arrays.array_elements(spark, str(tmp_path), 4096)
    assert sorted((json.loads(r["value"]) for r in got.collect()), key=lambda r: r["id"]) == sorted(
        records + records[:10], key=lambda r: r["id"]
    )
    pieces = arrays._pieces(spark, str(tmp_path / "a.json"))
    assert pieces.select("split").distinct().count() == 1  # at the session's size
    # An element that is one piece goes from its scan to the parser without a shuffle.
    starts = arrays._starts(pieces)
    plan = plan_of(arrays._cut(spark.createDataFrame([], pieces.schema), starts)[0])
    assert "Exchange hashpartitioning(file" not in plan.split("Join")[0]


@pytest.mark.parametrize(
    "text",
    ['{"results":[{"a":1}]}', '"s"', "  \n", '[{"a":1}', '[{"a":1},]', '[{"a":1} {"a":2}]',
     '[{"a":1}]]', "[1,2", '[{"a":1}][{"b":1}]', '[{"a":"x}]', "nul", '[{"a":1},,{"b":1}]',
     '[{"a":1}]x', '[,{"a":1}]', '[{"a":1}, {"b":}]', '[{"a":[}]'],
)
def test_what_is_no_array_fails(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="expected a JSON array|MALFORMED_RECORD"):
        arrays.array_elements(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("count", [0, 1, 40])
def test_the_saved_response_is_written_without_holding_its_lines(
    spark, fsis, rows, monkeypatch, count
):
    raw = fsis(*[{"field_title": f"t{i}", "field_states": '}],["'} for i in range(count)])
    monkeypatch.setattr(roundtrips, "fsis_raw", lambda *_: raw.repartition(3))
    plans, files, text = [], [], DataFrameWriter.text

    def recorded(writer, path, **more):
        plans.append(plan_of(writer._df))
        files.append(path)
        text(writer, path, **more)

    monkeypatch.setattr(DataFrameWriter, "text", recorded)
    assert rows(roundtrips.array_records(spark, "")) == rows(raw.unionByName(raw))
    assert len(plans) == 1 and "Sort" not in plans[0]
    lines = [r[0] for r in spark.read.text(files[0], wholetext=True).collect()]
    assert len(lines) == 1 and len(json.loads(lines[0])) == 2 * count + 1
