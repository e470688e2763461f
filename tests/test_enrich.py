import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from safetymart import rules as R
from safetymart.functions.matching import first_match, regex_flags
from safetymart.operators import enrich
from safetymart.schemas import CONTAMINATION_COLUMNS
from tests.conftest import plan_of

# Reason -> flags without their prefix, most important first.
REASONS = [
    ("Product may be contaminated with Salmonella.", ["salmonella"]),
    ("Potential LISTERIA contamination", ["listeria"]),
    ("l.  monocytogenes found", ["listeria"]),
    ("lmonocytogenes", []),
    ("possible E. coli O157:H7", ["ecoli"]),
    ("ecoli", ["ecoli"]),
    ("Escherichia found", ["ecoli"]),
    ("may help the colic", ["ecoli"]),
    ("broccoli", []),
    ("Undeclared milk", ["undeclared_milk"]),
    ("milk is undeclared", ["undeclared_milk"]),
    ("contains  milk", ["undeclared_milk"]),
    ("peanut undeclared", ["undeclared_peanut"]),
    ("undeclared soy lecithin", ["undeclared_soy"]),
    ("undeclared veggie mix", ["undeclared_egg"]),
    ("labelled gluten free", ["undeclared_wheat"]),
    ("undeclared cashew", ["undeclared_tree_nuts"]),
    ("cashew undeclared", []),
    ("undeclared tree nuts", ["undeclared_tree_nuts"]),
    ("undeclared tree-nut", ["undeclared_tree_nuts"]),
    ("allergen undeclared", ["undeclared_allergen_other"]),
    ("foreign matter", ["foreign_object"]),
    ("packed in glass jars", ["foreign_object"]),
    ("metal shaving fragment", ["foreign_object"]),
    ("plastic in a piece", ["foreign_object"]),
    ("Misbranded", ["mislabeling"]),
    ("Misbranding", []),
    ("wrong label", ["mislabeling"]),
    ("incorrect back label", ["mislabeling"]),
    (
        "Undeclared allergen: milk; also Salmonella; wrong label",
        ["salmonella", "undeclared_milk", "undeclared_allergen_other", "mislabeling"],
    ),
    ("undeclared\negg", []),
    ("undeclared\regg", []),
    ("", []),
    ("  ", []),
    (None, []),
]


def test_flags_and_category(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(REASONS)], "i int, reason string")
    labels = {name: label for name, label, _ in R.CONTAMINATION_RULES}
    for row in enrich.parse_contamination(df).collect():
        text, expected = REASONS[row["i"]]
        flags = {name: row[R.FLAG_PREFIX + name] for name in labels}
        assert [n for n, v in flags.items() if v] == expected, text
        assert None not in flags.values()
        assert row["contamination_category"] == (
            labels[expected[0]] if expected else "Other"
        )


def _made_up_texts(n, seed):
    rng = random.Random(seed)
    words = (
        "salmonella listeria l. monocytogenes e e. coli escherichia undeclared milk "
        "contains peanut soy egg wheat gluten almond cashew walnut pecan tree nut "
        "pistachio macadamia allergen foreign object material body matter glass metal "
        "fragment plastic piece mislabel misbranded incorrect label wrong the of "
        "undeclared undeclared undeclared"
    ).split()
    gaps = [" ", " ", "  ", "", "-", "\n", "\r", "\t", " İ ", " ß ", " K "]
    cases = [str.lower, str.upper, str.title, str.swapcase]
    return [
        "".join(
            rng.choice(cases)(rng.choice(words)) + rng.choice(gaps)
            for _ in range(rng.randint(1, 9))
        )
        for _ in range(n)
    ]


def test_literals_change_no_flag(spark):
    texts = _made_up_texts(6000, seed=11)
    df = spark.createDataFrame([(t,) for t in texts], "reason string")
    plain = enrich.contamination_flags(df, literals={})
    quick = enrich.contamination_flags(df)
    assert quick.exceptAll(plain).count() == plain.exceptAll(quick).count() == 0
    hits = quick.agg(*[F.count_if(c).alias(c) for c in CONTAMINATION_COLUMNS]).first()
    assert min(hits) > 50


def test_every_rule_has_literals():
    assert list(R.CONTAMINATION_LITERALS) == [name for name, _, _ in R.CONTAMINATION_RULES]


def test_own_rules(spark):
    df = spark.createDataFrame([("a1",), ("b",), (None,)], "note string")
    rules = [("digit", "Digit", r"\d"), ("letter", "Letter", "[a-z]")]
    out = enrich.parse_contamination(df, "note", rules).select(
        "note", "contam_digit", "contam_letter", "contamination_category"
    )
    assert [tuple(r) for r in out.collect()] == [
        ("a1", True, True, "Digit"),
        ("b", False, True, "Letter"),
        (None, False, False, "Other"),
    ]
    flags = regex_flags(df, "note", [], "x_")
    assert flags.columns == ["note"]
    assert df.select(first_match([], "none").alias("c")).first()["c"] == "none"


def test_each_pattern_is_searched_once(spark):
    df = spark.createDataFrame([("x",)], "reason string")
    plan = plan_of(enrich.parse_contamination(df))
    assert plan.count("RLIKE") == 12
    assert plan.count("lower(reason") == 1


def test_time_dimensions(spark):
    df = spark.createDataFrame([(date(2024, 12, 31),), (None,)], "recall_date date")
    got = [tuple(r)[1:] for r in enrich.add_time_dimensions(df).collect()]
    assert got == [(2024, 12, 4), (None, None, None)]


@pytest.mark.parametrize(
    "record, flags",
    [
        (("TX", "glass", "Class I", date(2024, 1, 1)), (False, False, False, False)),
        (("", " ", "", None), (True, True, False, True)),
        ((None, None, None, None), (True, True, True, True)),
        (("\t", "\t", " ", None), (False, False, False, True)),
    ],
)
def test_quality_flags(spark, record, flags):
    schema = "state string, reason string, classification string, recall_date date"
    out = enrich.add_data_quality_flags(spark.createDataFrame([record], schema))
    assert tuple(out.first())[4:] == flags
