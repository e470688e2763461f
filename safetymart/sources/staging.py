"""One pass over a raw feed that sends its rows and its malformed lines apart.

The feed's JSON is parsed once, into Parquet below one folder: ``kind=rows`` and
``kind=lines``. Everything that follows (counts, quarantine, silver) reads that. The
counts come from the footers of the committed files, so that a task that ran twice
counts once, and no data is read for them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safetymart.schemas import CORRUPT
from safetymart.session import isolated

KIND, ROWS, LINES = "kind", "rows", "lines"
SOURCE = "source_file"

# Counts of a Parquet table are taken from its footers by the newer reader only.
_FROM_FOOTERS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
}


@dataclass(frozen=True)
class StagedFeed:
    """A raw feed as Parquet: its rows, its malformed lines and their counts."""

    spark: SparkSession
    folder: str
    schema: T.StructType

    def _all(self, spark: SparkSession) -> DataFrame:
        more = [T.StructField(c, T.StringType()) for c in (CORRUPT, SOURCE, KIND)]
        return spark.read.schema(T.StructType([*self.schema, *more])).parquet(self.folder)

    def rows(self) -> DataFrame:
        """The well-formed records; only their folder is read."""
        whole = self._all(self.spark).filter(F.col(KIND) == ROWS)
        return whole.select(*self.schema.fieldNames())

    def lines(self) -> DataFrame:
        """(line, source_file) of the lines that are not valid JSON."""
        whole = self._all(self.spark).filter(F.col(KIND) == LINES)
        return whole.select(F.col(CORRUPT).alias("line"), SOURCE)

    def counts(self, columns: Sequence[str] = ()) -> DataFrame:
        """Per kind its ``row_count`` and how many have each of ``columns``, from footers."""
        table = self._all(isolated(self.spark, _FROM_FOOTERS))
        present = [F.count(c).alias(c) for c in columns]
        return table.groupBy(KIND).agg(F.count(F.lit(1)).alias("row_count"), *present)

    def profile(self, feed: str, required: Sequence[str]) -> list[Row]:
        """A row for each required field, as ``feed_profile`` gives of a scan."""
        found = {r[KIND]: r.asDict() for r in self.counts(required).collect()}
        rows = found.get(ROWS, {})
        total, malformed = rows.get("row_count", 0), found.get(LINES, {}).get("row_count", 0)
        return [
            Row(
                feed=feed,
                field=field,
                missing=total - rows.get(field, 0),
                row_count=total,
                malformed=malformed,
            )
            for field in required
        ]


def stage_feed(scan: DataFrame, folder: str) -> StagedFeed:
    """Parse a bronze scan once and write it below ``folder``, by kind.

    Nothing else of the raw files is read later; they may change or go.
    """
    fields = T.StructType([f for f in scan.schema if f.name != CORRUPT])
    kind = F.when(F.col(CORRUPT).isNull(), ROWS).otherwise(LINES)
    named = scan.select("*", F.col("_metadata.file_path").alias(SOURCE), kind.alias(KIND))
    # No texts of rows are kept twice: the file's name only matters for a broken line.
    named = named.withColumn(SOURCE, F.when(F.col(KIND) == LINES, F.col(SOURCE)))
    named.write.partitionBy(KIND).parquet(folder)
    return StagedFeed(scan.sparkSession, folder, fields)
