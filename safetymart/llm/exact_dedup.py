"""Exact duplicates by sorting contents, with Spark's own functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from safetymart.llm.common import SPACES, shuffle_partitions, stored

# Characters of the normalised text that lead the sort key; the digest follows them.
HEAD = 32
# A content with more than 1 in 100,000 rows, and 1,000 at least, is spread over
# several ranges. So there are at most 100,000 such contents, 10 MB.
HOT_SHARE, HOT_ROWS = 1e-5, 1_000


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """For every row the row of equal content that stays.

    Contents are texts without ``SPACES``; null counts as empty. Sampled splitters
    cut the order of (first characters, digest) into ranges, one shuffle moves the
    rows there, each task sorts its range on disk where memory is short, and each
    row is compared in full with the row before it: equal contents are adjacent.
    Of equal contents the row with the most code points stays, then the smallest
    id (null last); of rows that agree in these too, one.

    Ranges cannot split equal keys, so a content that many rows share gets a salt
    by id. Every row is compared within its salt, and the runs of all salts, a row
    each, are then put together by digest.

    Columns: id_col, keep_id, group_size, kept, text_sha256; one row per row of
    ``docs``. An empty table gives no rows; other columns do not matter.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id",
        F.translate("text", SPACES, "").alias("content"),
        F.char_length("text").alias("code_points"),
    )
    keyed = rows.withColumn("digest", F.sha2("content", 256))
    counts = keyed.groupBy("digest").count()
    per_salt = max(HOT_ROWS, int(HOT_SHARE * docs.count()))
    hot = counts.filter(F.col("count") > per_salt).select(
        F.col("digest").alias("hot_digest"),
        F.ceil(F.col("count") / per_salt).alias("salts"),
    )
    salted = keyed.join(
        F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left"
    ).select(
        "id",
        "content",
        "code_points",
        "digest",
        F.left("content", F.lit(HEAD)).alias("head"),
        F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))).alias("salt"),
    )
    key = ["head", "digest", "salt"]
    order = ["content", F.desc("code_points"), F.asc_nulls_last("id")]
    ranged = salted.repartitionByRange(shuffle_partitions(docs), *key)
    near = W.partitionBy(*key).orderBy(*order)
    equal = F.col("content").eqNullSafe(F.lag("content").over(near))
    repeat = equal & (
        F.struct("code_points", "id").eqNullSafe(
            F.lag(F.struct("code_points", "id")).over(near)
        )
    )
    compared = (
        ranged.withColumn("new", (~equal).cast("int"))
        .withColumn("repeat", repeat)
        .withColumn("run", F.sum("new").over(near))
        .select("id", "code_points", "digest", "run", "repeat")
    )
    light = stored(compared, "contents")
    # Nulls sort first in a struct; the flag puts them last.
    rank = F.struct((-F.col("code_points")).alias("n"), F.col("id").isNull().alias("z"), "id")
    groups = light.groupBy("digest", "run").agg(
        F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    # Written, so that the join below is between two shuffles and a content with
    # many rows can be split.
    groups = stored(groups, "groups")
    best = rank.eqNullSafe(F.col("best"))
    return light.join(groups, ["digest", "run"]).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (best & ~F.col("repeat")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
