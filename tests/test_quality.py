from safetymart.operators import quality
from safetymart.schemas import CORRUPT


def _frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "c string")


def test_unique_ignores_nulls(spark, rows):
    df = _frame(spark, "a", "a", "a", "b", "b", "c", None, None)
    assert rows(quality.unique(df, "m", "c")) == [("unique", "m", "c", 2)]
    assert rows(quality.unique(_frame(spark, None, None), "m", "c"))[0][3] == 0


def test_not_null_counts_each_column(spark, rows):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    assert rows(quality.not_null(df, "m", ["x", "y"])) == [
        ("not_null", "m", "x", 1),
        ("not_null", "m", "y", 2),
    ]


def test_accepted_values(spark, rows):
    df = spark.createDataFrame(
        [("a", "p"), ("z", "p"), ("z", "q"), ("y", None), (None, "r")], "x string, y string"
    )
    lists = {"x": ["a"], "y": ["p", "q", "r"]}
    assert rows(quality.unaccepted_values(df, lists)) == [("x", "y", 1), ("x", "z", 2)]
    assert rows(quality.accepted_values(df, "m", lists)) == [
        ("accepted_values", "m", "x", 2),
        ("accepted_values", "m", "y", 0),
    ]


def test_declared_checks_number_twelve():
    assert sum(len(c) for c in quality.UNIQUE.values()) == 4
    assert sum(len(c) for c in quality.NOT_NULL.values()) == 6
    assert sum(len(c) for c in quality.ACCEPTED.values()) == 2


def test_feed_profile_leaves_malformed_lines_out(spark, rows):
    df = spark.createDataFrame(
        [("a", None, None), (None, "x", None), (None, None, "{bad")],
        f"k string, v string, {CORRUPT} string",
    )
    assert rows(quality.feed_profile(df, "f", ["k", "v"])) == [
        ("f", "k", 1, 2, 1),
        ("f", "v", 1, 2, 1),
    ]
    clean = df.drop(CORRUPT)
    assert rows(quality.required_fields(clean, "f", ["k"])) == [("f", "k", 2)]


def test_min_rows(spark, rows):
    df = _frame(spark, "a", None, "b")
    assert rows(quality.min_rows(df, "f", 3)) == [("f", 3, 3, True)]
    assert rows(quality.min_rows(df, "f", 4)) == [("f", 4, 3, False)]
