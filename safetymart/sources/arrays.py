"""The elements of one large JSON array, cut by many tasks.

A file is read in splits, as pieces that end with a closing brace. What a piece does
to the state of the text before it (within a string or not, how many brackets are
open) is a sum: of its quotes, and of its brackets outside strings. So the state at
the start of every split follows from the sums of the splits before it, and each
split is then cut on its own, after every brace that closes an element.

Running sums in the order of a scan are the one step here that Spark's functions don't
have without a shuffle of the texts; Arrow batches pass through numpy for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from safetymart.session import scratch_dir, settings

_BRACE = "}"
# The place of what follows the last element that ends with a brace.
_END = -1


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pieces with their file, split, place within it, and the state around them.

    A backslash escapes within strings only, so that which quotes count does not
    depend on the state. Of the rest of a piece only quotes and brackets are looked at.
    ``opened_0`` counts the brackets it opens, less those it closes, if it starts outside
    a string, ``opened_1`` if within one.
    """
    plain = F.replace(F.replace("value", F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    marks = F.regexp_replace(F.when(F.contains("value", F.lit("\\")), plain).otherwise(F.col("value")),
                             r'[^"\[\]{]+', "")

    def opened(text: Column) -> Column:
        # What is left of whole strings, up to one that goes on in the next piece.
        outside = F.substring_index(F.regexp_replace(text, '"[^"]*"', ""), '"', 1)
        closed = F.length(F.replace(outside, F.lit("]"), F.lit("")))
        return (2 * closed - F.length(outside)).cast("long")

    quotes = F.length("marks") - F.length(F.replace("marks", F.lit('"'), F.lit("")))
    return (
        spark.read.option("lineSep", _BRACE)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.col("value").alias("text"),
            marks.alias("marks"),
        )
        .select(
            "file",
            "split",
            "text",
            quotes.cast("long").alias("quotes"),
            opened(F.col("marks")).alias("opened_0"),
            opened(F.concat(F.lit('"'), "marks")).alias("opened_1"),
        )
        .mapInArrow(_running, _PIECE)
    )


# The state is told for both that a split may start in: outside a string (0) or within
# one (1). ``odd`` and ``depth_h``: whether an odd number of quotes, and how many
# brackets, were opened since the split's start, the piece and its brace included;
# ``odd_before`` and ``before_h`` without them.
_PIECE = (
    "file string, split bigint, text string, place bigint, odd_before bigint, odd bigint, "
    "before_0 bigint, depth_0 bigint, before_1 bigint, depth_1 bigint"
)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums over the pieces of each split, which come in their order."""
    last, place, odd, depth = None, 0, 0, [0, 0]
    for batch in batches:
        quotes, *opened = (batch.column(i).to_numpy() for i in (3, 4, 5))
        code = batch.column(0).dictionary_encode().indices.to_numpy()
        split = batch.column(1).to_numpy()
        changes = np.flatnonzero((code[1:] != code[:-1]) | (split[1:] != split[:-1])) + 1
        out = np.empty((7, len(batch)), np.int64)
        for a, b in zip([0, *changes.tolist()], [*changes.tolist(), len(batch)]):
            if b == a:
                continue
            own = (batch.column(0)[a].as_py(), int(split[a]))
            if own != last:
                last, place, odd, depth = own, 0, 0, [0, 0]
            out[0, a:b] = np.arange(place, place + b - a)
            out[2, a:b] = (odd + np.cumsum(quotes[a:b])) % 2
            out[1, a:b] = (out[2, a:b] + quotes[a:b]) % 2
            for h in (0, 1):
                moved = np.where(out[1, a:b] == h, opened[0][a:b], opened[1][a:b])
                moved = moved - (out[2, a:b] == h)  # the brace, if it stands outside a string
                out[4 + 2 * h, a:b] = depth[h] + np.cumsum(moved)
                out[3 + 2 * h, a:b] = out[4 + 2 * h, a:b] - moved
                depth[h] = int(out[4 + 2 * h, b - 1])
            place, odd = place + b - a, int(out[2, b - 1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), *map(pa.array, out)],
            names=[f.split()[0] for f in _PIECE.split(", ")],
        )


def _starts(pieces: DataFrame) -> DataFrame:
    """A row for each split: the state it starts in, and where its last element ends.

    ``closing`` is the next split in which an element ends with a brace. The brackets
    of a whole array cancel out; the end of its text counts as one more brace.
    """
    totals = pieces.groupBy("file", "split").agg(
        F.max(F.struct("place", "odd", "depth_0", "depth_1")).alias("end"),
        *[
            F.collect_set(F.when(F.col("odd") == h, F.col(f"depth_{h}"))).alias(f"at_{h}")
            for h in (0, 1)
        ],
    )
    totals = totals.select("file", "split", "end.odd", "at_0", "at_1",
                           F.col("end.depth_0").alias("moved_0"),
                           F.col("end.depth_1").alias("moved_1"))
    in_file = W.partitionBy("file").orderBy("split")
    earlier = in_file.rowsBetween(W.unboundedPreceding, -1)
    later = in_file.rowsBetween(1, W.unboundedFollowing)
    whole = W.partitionBy("file")
    start = F.pmod(F.coalesce(F.sum("odd").over(earlier), F.lit(0)), F.lit(2))
    moved = F.when(F.col("start") == 0, F.col("moved_0")).otherwise(F.col("moved_1"))
    at = F.when(F.col("start") == 0, F.col("at_0")).otherwise(F.col("at_1"))
    known = totals.withColumn("start", start).withColumn("moved", moved)
    broken = (F.sum("moved").over(whole) != -1) | (F.pmod(F.sum("odd").over(whole), F.lit(2)) != 0)
    depth = F.coalesce(F.sum("moved").over(earlier), F.lit(0))
    checked = F.when(
        broken, F.raise_error(F.concat(F.lit("expected a JSON array, not closed or more: "), "file"))
    ).otherwise(depth)
    known = known.withColumn("depth", checked.cast("long"))
    ends = F.array_contains(at, F.lit(1) - F.col("depth"))
    known = known.withColumn("ends", ends)
    closing = F.min(F.when(F.col("ends"), F.col("split"))).over(later)
    return known.select(
        F.col("file").alias("of"),
        F.col("split").alias("at"),
        "start",
        "depth",
        F.coalesce(closing, F.lit(_END)).alias("closing"),
    )


def _cut(pieces: DataFrame, starts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The text between ends of elements: that of one piece, and that of more.

    The second, (file, to, chunk, split, first, text), is cut at the ends of splits too.
    What is open there belongs to chunk 0 of the split that closes it.
    """
    same = (F.col("file") == F.col("of")) & (F.col("split") == F.col("at"))
    rows = pieces.join(starts, same)

    def known(name: str) -> Column:
        return F.col("depth") + F.when(F.col("start") == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1"))

    rows = rows.select(
        "file", "split", "place", "text", "closing",
        ((F.col("split") == 0) & (F.col("place") == 0)).alias("first"),
        ((F.col("odd_before") == F.col("start")) & (known("before") == 1)).alias("clean"),
        ((F.col("odd") == F.col("start")) & (known("depth") == 1)).alias("ends"),
    )
    alone = F.col("clean") & F.col("ends") & ~F.col("first")
    whole, rest = rows.filter(alone), rows.filter(~alone)
    in_split = W.partitionBy("file", "split").orderBy("place")
    earlier = in_split.rowsBetween(W.unboundedPreceding, -1)
    end = F.col("ends").cast("long")
    rest = rest.withColumn("chunk", F.coalesce(F.sum(end).over(earlier), F.lit(0)))
    closed = F.col("chunk") < F.sum(end).over(W.partitionBy("file", "split"))
    rest = rest.withColumn("closed", closed)
    parts = rest.groupBy("file", "split", "chunk", "closed", "closing").agg(
        F.sort_array(F.collect_list(F.struct("place", "text"))).alias("parts"),
        F.max("first").alias("first"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), _BRACE)
    return whole.select("text"), parts.select(
        "file",
        F.when(F.col("closed"), F.col("split")).otherwise(F.col("closing")).alias("to"),
        F.when(F.col("closed"), F.col("chunk")).otherwise(0).alias("chunk"),
        "split",
        "first",
        text.alias("text"),
    )


def _elements(chunks: DataFrame, name: str) -> DataFrame:
    """Rows (first, last, text) of an array's text between ends to its elements."""
    trimmed = F.trim(F.col("text"), F.lit(" \t\r\n"))
    # Trimming is the dearest step here; most texts start with the comma.
    plain = F.startswith(F.col("text"), F.lit(",")) & ~F.col("last")
    text = F.when(plain, F.col("text")).otherwise(trimmed)
    tail = F.when(
        F.col("last"),
        F.when(text.endswith("]"), F.substring(text, F.lit(1), F.length(text) - 1)),
    ).otherwise(F.concat(text, F.lit(_BRACE)))
    # An array's start, or the comma after the element before; nothing else may stand there.
    lead = F.when(F.col("first"), F.lit("[")).otherwise(F.lit(","))
    inner = F.when(F.startswith(tail, lead), F.substring(tail, F.lit(2), F.length(tail)))
    nothing = F.col("last") & (F.trim(F.coalesce(inner, tail), F.lit(" \t\r\n")) == "")
    empty = nothing & F.when(F.col("first"), inner.isNotNull()).otherwise(tail == "")
    array = F.concat(F.lit("["), inner, F.lit("]"))
    parsed = F.from_json(array, "array<string>", {"mode": "FAILFAST"})
    found = F.when(empty, F.array().cast("array<string>")).when(inner.isNotNull() & ~nothing, parsed)
    wrong = F.concat(F.lit("expected a JSON array: "), F.left("text", F.lit(80)))
    found = found.otherwise(F.raise_error(wrong))
    return chunks.select(F.explode(found).alias(name))


def array_elements(
    spark: SparkSession, path: str | list[str], split_bytes: int | None = None, name: str = "value"
) -> DataFrame:
    """The elements of files that hold a JSON array each, one row for each element.

    A file of any size is cut by as many tasks as it has splits (``split_bytes``, or
    what the session has). An element is held by one task, a file or a split never is.
    Texts are shuffled only where an element has several braces. Elements come as JSON text, as ``from_json`` gives them; a
    file that is no array, is not closed or has more behind its array fails the job.
    Elements without braces, such as numbers, are taken together with the next that has.

    The pieces are written to the shared folder first, so that both passes over them
    (the sums, then the cuts) see the same splits whatever executors there are.
    """
    conf = {"spark.sql.files.maxPartitionBytes": str(split_bytes)} if split_bytes else {}
    stored = scratch_dir(spark, "pieces")
    with settings(spark, conf):
        _pieces(spark, path).write.parquet(stored)
    pieces = spark.read.parquet(stored)
    whole, parts = _cut(pieces, _starts(pieces))
    no = F.lit(False)
    whole = whole.select(no.alias("first"), no.alias("last"), "text")
    edges = parts.groupBy("file", "to", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("split", "text"))).alias("parts"),
        F.max("first").alias("first"),
    )
    joined = F.array_join(F.transform("parts", lambda p: p["text"]), _BRACE)
    edges = edges.select("first", (F.col("to") == _END).alias("last"), joined.alias("text"))
    return _elements(whole.unionByName(edges), name)
