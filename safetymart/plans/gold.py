"""Silver to gold: build all tables as a new version, check them, then publish it."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from safetymart.operators import marts
from safetymart.operators.quality import model_checks
from safetymart.session import sized_shuffles
from safetymart.sources.layout import delete_dir, new_version, publish, published
from safetymart.sources.tables import read_fact, write_fact

# Aggregates that follow from the table of counts.
ROLLUP_MARTS = {
    "agg_recalls_by_year": marts.agg_recalls_by_year,
    "agg_contaminants_by_year": marts.agg_contaminants_by_year,
    "agg_class1_by_contaminant": marts.agg_class1_by_contaminant,
}


# Models written at the same time.
WRITERS = 4

MODELS = (
    "fct_recalls",
    "dim_firms",
    "dim_contaminants",
    "dim_dates",
    "agg_recalls_by_state",
    *ROLLUP_MARTS,
    "rollup",
)


class QualityError(ValueError):
    """Checks failed; nothing was published."""


def build_gold(stg: DataFrame) -> dict[str, DataFrame]:
    """All models as lazy DataFrames over the staging view."""
    fct = marts.fct_recalls(stg)
    return {
        "fct_recalls": fct,
        "dim_firms": marts.dim_firms(stg),
        "dim_contaminants": marts.dim_contaminants(stg),
        "dim_dates": marts.dim_dates(stg),
        "agg_recalls_by_state": marts.agg_recalls_by_state(fct),
        **{name: build(fct) for name, build in ROLLUP_MARTS.items()},
    }


def run_gold(
    spark: SparkSession, silver: DataFrame, gold: str, on_failure: str = "raise"
) -> list:
    """Build the models below ``gold``; returns the rows of the checks.

    Order of work: the fact is written first, and everything else reads the
    written columns it needs. The yearly aggregates and the category dimension
    read a table of counts that one scan of the fact gives. No intermediate
    result is held in executor memory: a lost executor costs its own tasks only.

    The models are a version of ``gold`` that no reader sees before its mark is
    written, after the checks: all appear together, on object stores too, and who reads
    the version before goes on with it. ``published`` finds the current one.
    ``on_failure="warn"`` publishes in spite of failed checks.
    """
    if on_failure not in ("raise", "warn"):
        raise ValueError(f"on_failure must be 'raise' or 'warn', not {on_failure!r}")
    version, fresh = new_version(gold)
    try:
        with sized_shuffles(silver):
            checks = _build_aside(spark, marts.stg_recalls(silver), fresh)
        failed = [r.asDict() for r in checks if r["failures"]]
        if failed and on_failure == "raise":
            raise QualityError(f"checks failed: {failed}")
    except BaseException:
        delete_dir(spark, fresh)
        raise
    publish(spark, gold, version)
    return checks


def read_gold(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    """The models that were published last."""
    folder = published(spark, gold)
    return {name: spark.read.parquet(f"{folder}/{name}") for name in MODELS}


def gold_views(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    """The published models, also as temporary views for SQL."""
    models = read_gold(spark, gold)
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    return models


def _build_aside(spark: SparkSession, stg: DataFrame, folder: str) -> list:
    write_fact(marts.fct_recalls(stg), f"{folder}/fct_recalls")
    fct = read_fact(spark, f"{folder}/fct_recalls")

    def store(models: dict[str, DataFrame]) -> None:
        # Writes that do not depend on each other overlap, so that the last tasks
        # of one leave no executor idle.
        with ThreadPoolExecutor(WRITERS) as pool:
            writes = [
                pool.submit(df.write.parquet, f"{folder}/{name}")
                for name, df in models.items()
            ]
        for write in writes:
            write.result()

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    store(
        {
            "dim_firms": marts.dim_firms(fct),
            "dim_dates": marts.dim_dates(fct),
            "agg_recalls_by_state": marts.agg_recalls_by_state(fct),
            "rollup": marts.recall_rollup(fct),
        }
    )
    rollup = stored("rollup")
    store(
        {
            "dim_contaminants": marts.dim_contaminants(rollup),
            **{
                name: build(rollup, weight="recall_count")
                for name, build in ROLLUP_MARTS.items()
            },
        }
    )
    return model_checks(
        {
            "stg_recalls": stg,
            "fct_recalls": fct,
            "dim_firms": stored("dim_firms"),
            "dim_contaminants": stored("dim_contaminants"),
        }
    ).collect()
