"""Ranked lexical search: documents equal to the queries are scored once."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from safetymart.llm.common import LOWER, stored, text_bytes

# The bytes that terms are made of, after lower-casing.
_TERM = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TO_TERMS = bytes(LOWER[b] if LOWER[b] in _TERM else 0x20 for b in range(256))

# Item terms, with repeats, that are broadcast at a time; more take more passes.
BLOCK_TERMS = 100_000
# Bytes of a text that are cut into terms at once, and of a matrix of term weights.
PIECE_BYTES, MATRIX_BYTES = 1 << 20, 1 << 25
_LAST_ID = 2**63 - 1


def term_counts(text: bytes, vocabulary: dict[bytes, int]) -> tuple[int, Counter]:
    """The number of terms of a text, and how often it holds each of the vocabulary."""
    total, counts, start = 0, Counter(), 0
    text = text.translate(_TO_TERMS)
    while start < len(text):
        end = start + PIECE_BYTES
        if end < len(text):  # up to the end of a term
            end = text.find(b" ", end)
        terms = text[start : end if end >= 0 else len(text)].split()
        total += len(terms)
        counts.update(map(vocabulary.get, terms))
        start = end if end >= 0 else len(text)
    del counts[None]
    return total, counts


@dataclass
class Queries:
    """A block of items: its vocabulary, and the terms of each item with repeats."""

    ids: list
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]
    times: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        ids, terms, times = [], [], []
        for item_id, text in rows:
            coded = [vocabulary.setdefault(t, len(vocabulary)) for t in text.translate(_TO_TERMS).split()]
            if coded:
                own, n = np.unique(np.array(coded, np.int64), return_counts=True)
                ids.append(item_id)
                terms.append(own)
                times.append(n)
        return cls(ids, vocabulary, terms, times)


def _bags(shared):
    """Texts to (number of terms, bag): pairs (term, tf) of the vocabulary as int32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value.vocabulary
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            lengths, bags = [], []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                n, counts = term_counts(data[a:b].tobytes(), vocabulary)
                lengths.append(n)
                bags.append(np.array(sorted(counts.items()), "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(bags, pa.binary())],
                names=["doc_id", "n", "bag"],
            )

    return run


def _document_frequencies(size: int):
    """Bags to the number of them that hold each term, a row for each task and term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            data, starts = text_bytes(batch.column(0))
            pairs = data[starts[0] : starts[-1]].view("<i4").reshape(-1, 2)
            total += np.bincount(pairs[:, 0], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(total[at])], names=["term", "df"]
        )

    return run


def _smallest(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, of equal ones those with the smallest ids."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= least)
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _best_classes(shared, weights: np.ndarray, k: int):
    """Classes (class, m, bag) to the ``k`` best of a task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        empty = np.zeros(0, np.int64)
        best = [(empty, empty, empty) for _ in queries.ids]  # score, class, hash
        width = max(1, MATRIX_BYTES // 8 // max(1, len(weights)))
        for batch in batches:
            ids, ms, hashes = (batch.column(i).to_numpy() for i in range(3))
            data, starts = text_bytes(batch.column(3))
            for a in range(0, len(batch), width):
                b = min(a + width, len(batch))
                pairs = data[starts[a] : starts[b]].view("<i4").reshape(-1, 2).astype(np.int64)
                own = np.repeat(np.arange(b - a), np.diff(starts[a : b + 1]) // 8)
                term, tf = pairs[:, 0], pairs[:, 1]
                # All in 64-bit integers, as the definition of the score has it.
                value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * ms[a + own]))
                matrix = np.zeros((len(weights), b - a), np.int64)
                matrix[term, own] = value
                seen = np.zeros(len(weights), bool)
                seen[term] = True
                for i, (terms, times) in enumerate(zip(queries.terms, queries.times)):
                    there = seen[terms]
                    if not there.any():
                        continue
                    score = times[there] @ matrix[terms[there]]
                    held = best[i]
                    least = held[0][-1] if len(held[0]) == k else 1
                    at = np.flatnonzero(score >= least)
                    if len(at):
                        joined = [np.concatenate(x) for x in zip(held, (score[at], ids[a + at], hashes[a + at]))]
                        top = _smallest(joined[0], joined[1], k)
                        best[i] = tuple(x[top] for x in joined)
        n = [len(x[0]) for x in best]
        columns = [np.concatenate([empty, *x]) for x in zip(*best)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(n)), n)), *map(pa.array, columns)],
            names=["item", "score", "class", "hash"],
        )

    return run


def _search_block(docs: DataFrame, queries: Queries, k: int) -> DataFrame:
    """(item, rank, doc_id, score) of a block's items by their places in it."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(queries)
    bags = stored(docs.mapInArrow(_bags(shared), "doc_id bigint, n bigint, bag binary"), "bags")
    filled = bags.filter("n > 0")
    count, length = filled.agg(F.count(F.lit(1)), F.sum("n")).first()
    size = len(queries.vocabulary)
    df = np.zeros(size, np.int64)
    found = bags.select("bag").mapInArrow(_document_frequencies(size), "term bigint, df bigint")
    for row in found.groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    weights = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    # A document's class: its terms of the vocabulary, how often each, and its length's part.
    m = F.expr(f"25L + (75L * n * {count}L) div {length or 1}L").alias("m")
    rows = filled.filter(F.octet_length("bag") > 0).select("doc_id", m, "bag")
    own_id = F.coalesce("doc_id", F.lit(_LAST_ID))
    rows = rows.select(own_id.alias("id"), "doc_id", F.xxhash64("m", "bag").alias("hash"), "m", "bag")
    # Grouped by the whole content: two classes with one hash stay two.
    classes = rows.groupBy("hash", "m", "bag").agg(F.min("id").alias("class"))
    classes = stored(classes.select("class", "m", "hash", "bag"), "classes")
    scored = classes.mapInArrow(
        _best_classes(shared, weights, k), "item bigint, score bigint, class bigint, hash bigint"
    )
    by_score = W.partitionBy("item").orderBy(F.desc("score"), "class")
    top = scored.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= k)
    top = stored(top.drop("place"), "top")
    # At most k hashes for each item of the block, and an item has a term at least.
    wanted = F.broadcast(top.select("hash").distinct())
    contents = classes.join(wanted, "hash", "left_semi")
    members = rows.join(wanted, "hash", "left_semi")
    # A class of any size sends its smallest ids only.
    by_id = W.partitionBy("hash", "m", "bag").orderBy("id")
    members = members.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= k)
    named = contents.join(members.drop("place"), ["hash", "m", "bag"]).select("class", "hash", "id", "doc_id")
    expanded = top.join(named, ["hash", "class"])
    by_both = W.partitionBy("item").orderBy(F.desc("score"), "id")
    ranked = expanded.withColumn("rank", F.row_number().over(by_both)).filter(F.col("rank") <= k)
    return ranked.select("item", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents for each item: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters and digits and of all other characters, only A-Z
    lower-cased. With N documents that hold a term, L terms in them, n in a document,
    df documents with a term and tf times in this one, a term adds
    w * (10**9 * tf div (1000 * tf + 8 * m)), where w = floor(1000 * ln((2N + 2) /
    (2df + 1))) and m = 25 + (75 * n * N) div L; repeats in the item count. Only scores
    above 0 are listed; equal scores by ascending document id, a null id last.

    Null and empty texts have no terms: such documents aren't counted, such items have
    no rows. A repeated document row is a document; a repeated item row is an item of
    its own, and so its rows stand there twice. Empty tables give no rows. Ids are whole
    numbers; other columns are passed over. A text is cut into terms a megabyte at a
    time; beside it only its counts of the items' terms are held.

    Documents are restricted to the items' vocabulary. Those with the same counts of
    its terms and the same m are one class, told apart by hash and then by content. Each
    class is scored once, by items in blocks of about ``BLOCK_TERMS`` terms, for each of
    which the documents are passed once. A task keeps ``k`` classes for each item; these
    hold the best documents, as each class counts at least with its smallest id. The
    winning classes, at most ``k`` for each item, get their ``k`` smallest members.
    """
    spark = docs.sparkSession
    id_type = items.schema[item_id_col].dataType
    texts = items.select(
        F.col(item_id_col).alias("id"),
        F.encode(F.coalesce(F.col(item_text_col), F.lit("")), "UTF-8").alias("text"),
    )
    # A term takes two bytes at least, with what parts it from the next.
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 / BLOCK_TERMS))
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("text", "id"), F.lit(blocks)))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    results = _none(spark, id_type)
    for block in range(blocks):
        rows = dealt.filter(F.col("block") == block).select("id", "text").collect()
        queries = Queries.of([(r["id"], bytes(r["text"])) for r in rows])
        if not queries.ids:
            continue
        found = _search_block(docs, queries, k)
        ids = spark.createDataFrame(list(enumerate(queries.ids)), f"item long, item_id {id_type.simpleString()}")
        named = found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        # Written, so that one block's queries and bags are at work at a time.
        results = results.unionByName(stored(named, "found") if blocks > 1 else named)
    return results


def _none(spark: SparkSession, id_type) -> DataFrame:
    return spark.createDataFrame([], f"item_id {id_type.simpleString()}, rank int, doc_id long, score long")
