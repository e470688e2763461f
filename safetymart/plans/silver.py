"""Bronze to silver."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from safetymart import rules as R
from safetymart.operators import enrich, reports
from safetymart.operators.latest import keep_latest
from safetymart.operators.normalize import (
    normalize_fda,
    normalize_fsis,
    normalize_state,
    union_feeds,
)
from safetymart.schemas import SILVER_COLUMNS, UNIFIED_COLUMNS
from safetymart.session import isolated, sized_shuffles
from safetymart.sources.bronze import scan_bronze
from safetymart.sources.layout import as_day, day_dir, delete_dir, replace_dir
from safetymart.sources.staging import stage_feed
from safetymart.sources.tables import write_silver

# Decides between versions of one notice that have the same dates. All columns
# take part, so that equal inputs give equal outputs in any order.
_FIRST_TIE_BREAKERS = ("company", "product_description", "reason")
TIE_BREAKERS = _FIRST_TIE_BREAKERS + tuple(
    c
    for c in UNIFIED_COLUMNS
    if c not in {"recall_id", "report_date", "recall_date", *_FIRST_TIE_BREAKERS}
)


def unify(fda_raw: DataFrame, fsis_raw: DataFrame) -> DataFrame:
    """Both feeds in the unified columns, duplicates included."""
    return union_feeds(normalize_fda(fda_raw), normalize_fsis(fsis_raw))


def latest_notices(unified: DataFrame) -> DataFrame:
    """The latest version of each notice."""
    return keep_latest(
        unified, ["recall_id"], ["report_date", "recall_date"], TIE_BREAKERS
    )


def enrich_notices(notices: DataFrame) -> DataFrame:
    """States, contamination, calendar and quality columns: the 34 silver columns."""
    return (
        notices.transform(normalize_state)
        .transform(enrich.parse_contamination)
        .transform(enrich.add_time_dimensions)
        .transform(enrich.add_data_quality_flags)
        .select(*SILVER_COLUMNS)
    )


def build_silver(fda_raw: DataFrame, fsis_raw: DataFrame) -> DataFrame:
    """The whole silver plan, lazily: one shuffle, by notice.

    Deduplication comes before the enrichments. They work row by row and leave
    its columns alone, so that the result is the same and the patterns are only
    searched in the rows that stay.
    """
    return enrich_notices(latest_notices(unify(fda_raw, fsis_raw)))


class FeedError(ValueError):
    """A raw feed is too small or lacks required fields."""


@dataclass(frozen=True)
class SilverRun:
    path: str
    row_count: int
    feeds: list  # rows (feed, field, missing, row_count, malformed) of the raw feeds

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def summary(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Statistics of the run, read from the written columns they need."""
        silver = self.read(spark)
        return {
            "by_source": reports.stats_by_source(silver),
            "by_classification": reports.stats_by_classification(silver),
            "by_category": reports.stats_by_category(silver),
            "quality_flags": reports.dq_flag_counts(silver),
        }


def run_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    day: date | str | None = None,
    as_of: bool = False,
    min_rows: dict[str, int] | None = None,
    require_fields: bool = False,
    quarantine: str | None = None,
    max_malformed: int | None = None,
) -> SilverRun:
    """Read one bronze day, write the silver day, report.

    Each feed's JSON is parsed once, into a folder beside the silver days that goes at
    the end. Sizes, nulls in required fields and malformed lines are counted in every
    run, from the footers of what was written there, and are in the result's ``feeds``.
    Feeds below ``min_rows`` stop the run, and with ``require_fields`` so do
    nulls in required fields. Malformed lines are left out of silver and go to
    the day's folder below ``quarantine`` when it is given; more than ``max_malformed``
    of them in a feed (default: any number) stop the run. ``day`` is resolved once, for
    reading and writing. Settings are changed in a session of the run's own.
    """
    own, day = isolated(spark), as_day(day)
    scans = {feed: scan_bronze(own, bronze, feed, day, as_of) for feed in R.MIN_ROWS}
    stage = f"{silver.rstrip('/')}/.stage-{uuid.uuid4().hex}"
    try:
        with ThreadPoolExecutor(len(scans)) as pool:
            feeds = dict(
                zip(scans, pool.map(lambda f: stage_feed(scans[f], f"{stage}/{f}"), scans))
            )
        profile = [
            r for feed, staged in feeds.items() for r in staged.profile(feed, R.REQUIRED_FIELDS[feed])
        ]
        _stop_on_problems(profile, min_rows or {}, require_fields, max_malformed)
        broken = {r["feed"] for r in profile if r["malformed"]}
        for feed in broken if quarantine else ():
            lines = feeds[feed].lines()
            target = day_dir(f"{quarantine.rstrip('/')}/{feed}", day)
            replace_dir(own, target, lambda path, lines=lines: lines.write.json(path))
        unified = unify(feeds["fda"].rows(), feeds["fsis"].rows())
        with sized_shuffles(unified):
            path = write_silver(enrich_notices(latest_notices(unified)), silver, day)
    finally:
        delete_dir(own, stage)
    return SilverRun(path, spark.read.parquet(path).count(), profile)


def _stop_on_problems(
    profile: list, min_rows: dict[str, int], require_fields: bool, max_malformed: int | None
) -> None:
    problems = [
        f"{r['feed']}: {r['row_count']} rows"
        for r in profile
        if r["row_count"] < min_rows.get(r["feed"], 0)
    ] + [
        f"{r['feed']}: {r['missing']} rows without {r['field']}"
        for r in profile
        if require_fields and r["missing"]
    ] + [
        f"{r['feed']}: {r['malformed']} malformed lines"
        for r in profile
        if max_malformed is not None and r["malformed"] > max_malformed
    ]
    if problems:
        raise FeedError("; ".join(sorted(set(problems))))
