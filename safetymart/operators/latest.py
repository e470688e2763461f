"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
    keep_null_key: bool = False,
) -> DataFrame:
    """One row per key: the greatest by ``latest_by``, nulls last.

    Ties go to the smallest row by ``tie_breakers`` (default: every other
    column), so that the same row wins however the input is split and whichever
    task is run again.

    Rows with a null key are no versions of each other; they are left out
    unless ``keep_null_key``, which treats null as one more key.

    Skew: Spark plans ``row_number() = 1`` as a group limit on both sides of the
    shuffle. Each map task sends at most one row per key, so that a key holding
    a third of all rows costs its reducer one row per map task.
    """
    if tie_breakers is None:
        tie_breakers = [
            f.name
            for f in df.schema.fields
            if f.name not in {*keys, *latest_by}
            and not isinstance(f.dataType, _UNORDERED)
        ]
    if not keep_null_key:
        for key in keys:
            df = df.filter(F.col(key).isNotNull())
    best_first = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in latest_by],
        *[F.col(c).asc_nulls_last() for c in tie_breakers],
    )
    position = "_position_in_key"
    return (
        df.withColumn(position, F.row_number().over(best_first))
        .filter(F.col(position) == 1)
        .drop(position)
    )
