"""Fixity audit of web archives: Merkle trees over ordered offset ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from safetymart.llm.common import stored

RECORDS_PER_ARCHIVE = 1_000
# Bytes of a tree's lowest ranges, and how many ranges the next higher one joins.
RANGE_BYTES, FANOUT = 64 << 10, 8


def warc_records(pages: DataFrame, per_archive: int = RECORDS_PER_ARCHIVE) -> DataFrame:
    """Pages as records of archive files: archive, page, length, record; row by row.

    Pages of ``per_archive`` consecutive ids make an archive; a null id is dealt out by
    its url. Null url or html counts as empty. Repeated rows are a record each.
    ``record_digests`` says where each record stands in its archive.
    """
    url, html = (F.coalesce(F.col(c), F.lit("")) for c in ("url", "html"))
    page = F.coalesce(F.col("page_id"), F.xxhash64(url))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        page.cast("string"),
        F.lit(">\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
        html,
        F.lit("\r\n\r\n"),
    )
    return pages.select(
        F.floor(page / per_archive).cast("long").alias("archive"),
        page.alias("page"),
        F.octet_length(record).cast("long").alias("length"),
        record.alias("record"),
    )


def record_digests(records: DataFrame) -> DataFrame:
    """(archive, offset, length, digest) of records: the leaves of the trees.

    An archive holds its records by page; those of one page stand by length and digest.
    Records are digested where they are read: what the offsets are summed over, and all
    that moves, is a row of fixed size for each record.
    """
    digest = F.sha2(F.encode("record", "UTF-8"), 256)
    rows = records.select("archive", "page", "length", digest.alias("digest"))
    before = W.partitionBy("archive").orderBy("page", "length", "digest")
    before = before.rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    return rows.select("archive", offset.alias("offset"), "length", "digest")


def _ranges(leaves: DataFrame) -> DataFrame:
    """The lowest nodes: all records that start in a range of offsets, in order."""
    node = F.floor(F.col("offset") / RANGE_BYTES).cast("long")
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "digest")))
    joined = F.array_join(
        F.transform(parts, lambda p: F.concat_ws(":", p["offset"], p["length"], p["digest"])), "|"
    )
    return leaves.groupBy("archive", node.alias("node")).agg(F.sha2(joined, 256).alias("digest"))


def _parents(nodes: DataFrame) -> DataFrame:
    node = F.floor(F.col("node") / FANOUT).cast("long")
    parts = F.sort_array(F.collect_list(F.struct("node", "digest")))
    joined = F.array_join(
        F.transform(parts, lambda p: F.concat_ws(":", p["node"], p["digest"])), "|"
    )
    return nodes.groupBy("archive", node.alias("node")).agg(F.sha2(joined, 256).alias("digest"))


def merkle_tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels of every archive's tree, from its ranges up to a single root each."""
    levels = [stored(_ranges(leaves), "ranges")]
    while levels[-1].agg(F.max("node")).first()[0]:
        levels.append(stored(_parents(levels[-1]), "nodes"))
    return levels


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Where two replicas' records (archive, offset, length, digest) differ.

    Both replicas' trees are compared from the roots down; only the children of
    nodes that differ are looked at in the next level, and at the end only the
    records of ranges that differ. A replica's tree may be the lower one: its root
    is then compared with the other's node 0 of that level, and all nodes beyond.

    Columns: archive, offset, length and digest of both sides (null where the
    record is missing), status ``changed``, ``missing`` (on the right) or
    ``added``. A record that stands twice at one offset is compared by all its
    values. Equal replicas and empty tables give no rows.
    """
    trees = [merkle_tree(left), merkle_tree(right)]
    suspects = None
    for level in reversed(range(max(map(len, trees)))):
        one, other = (t[level] if level < len(t) else t[0].limit(0) for t in trees)
        if suspects is not None:
            one, other = (_below(side, suspects, FANOUT, "node") for side in (one, other))
        compared = one.withColumnRenamed("digest", "a").join(
            other.withColumnRenamed("digest", "b"), ["archive", "node"], "full"
        )
        differing = compared.filter(~F.col("a").eqNullSafe(F.col("b")))
        suspects = stored(differing.select("archive", "node"), "suspects")
    sides = []
    for side, records in (("left", left), ("right", right)):
        found = _below(records, suspects, RANGE_BYTES, "offset")
        copies = W.partitionBy("archive", "offset").orderBy("length", "digest")
        found = found.withColumn("copy", F.row_number().over(copies))
        names = {c: f"{side}_{c}" for c in ("length", "digest")}
        sides.append(found.withColumnsRenamed(names))
    joined = sides[0].join(sides[1], ["archive", "offset", "copy"], "full")
    a, b = F.col("left_digest"), F.col("right_digest")
    status = F.when(b.isNull(), "missing").when(a.isNull(), "added").otherwise("changed")
    differs = ~(a.eqNullSafe(b) & F.col("left_length").eqNullSafe(F.col("right_length")))
    return joined.filter(differs).select(
        "archive", "offset", "left_length", "right_length", "left_digest", "right_digest",
        status.alias("status"),
    )


def _below(rows: DataFrame, suspects: DataFrame, width: int, place: str) -> DataFrame:
    above = suspects.select(F.col("archive").alias("_archive"), F.col("node").alias("_node"))
    inside = F.floor(F.col(place) / width).cast("long") == F.col("_node")
    return rows.join(above, (F.col("archive") == F.col("_archive")) & inside, "left_semi")
