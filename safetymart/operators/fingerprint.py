"""Whether two tables hold the same rows, told by one row for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Digits of a row's digest that are added up: 60 bits, so that no sum overflows.
_DIGITS = 15


def fingerprint(df: DataFrame, model: str) -> DataFrame:
    """(model, row_count, fingerprint): the same for equal rows in any order.

    The fingerprint is the sum of the rows' digests, so that a row that stands twice
    counts twice. A row's text has its columns by name, each as ``length:value`` or
    ``~`` for null; numbers with a fraction have six digits of it. One scan, with
    map-side sums.
    """
    texts = []
    for field in sorted(df.schema, key=lambda f: f.name):
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = value.cast("decimal(38,6)")
        text = value.cast("string")
        texts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("~")))
    digest = F.left(F.md5(F.concat_ws("|", *texts)), F.lit(_DIGITS))
    number = F.conv(digest, 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("fingerprint"),
    ).select(F.lit(model).alias("model"), "row_count", "fingerprint")
