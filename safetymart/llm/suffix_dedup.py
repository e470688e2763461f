"""Removal of long repeated strings, found by sorting suffixes column by column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetymart.llm.common import dropped, stored, text_bytes
from safetymart.llm.shingles import mix, powers

# Bytes of a string that counts as repeated, and of the stretch in which each of
# its places has an anchor. All strings of one anchor share the bytes between.
LENGTH, STRETCH = 400, 256
GRAM = 16
SEGMENT_BYTES = 1 << 20
# Strings that one collection holds (about), and of one anchor's contents at most:
# this many, or this share of all if that is more (so few enough to be told to tasks).
COLLECTION, MOST_ALIKE, MOST_SHARE = 4_096, 20_000, 1e-6

_RNG = np.random.default_rng(65_537)
_BASES = [int(b) * 2 + 1 for b in _RNG.integers(1 << 61, 1 << 63, 2)]
_INVERSES = [pow(b, -1, 1 << 64) for b in _BASES]
_OF_BYTE = _RNG.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
_PLACE_BITS = np.uint64(28)
_PLACE_MASK = np.uint64((1 << 28) - 1)


class RollingHashes:
    """Hashes of any substrings of some bytes, by two bases."""

    def __init__(self, data: np.ndarray):
        self.sums = []
        for k in range(2):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_OF_BYTE[k][data] * powers(_BASES[k], len(data)), out=sums[1:])
            self.sums.append(sums)

    def of(self, begin: np.ndarray, end: np.ndarray, k: int = 0) -> np.ndarray:
        back = powers(_INVERSES[k], len(self.sums[k]))[begin]
        return mix((self.sums[k][end] - self.sums[k][begin]) * back)


def least_in_stretch(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbouring values."""
    n = len(values)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = values
    full = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of one text segment: key, context hashes, first and last start, place.

    The anchor of a start is the last of the least grams among the next
    ``STRETCH``; equal strings have theirs at the same place. A row stands for the
    starts that share an anchor. Its key is a hash of the bytes that all strings
    from there on have in common, its context of all bytes of the row's strings.
    Starts of a key in ``hot`` are halved by their distance from the anchor, which
    leaves more common bytes, until no key is hot or one distance is left.
    """
    hashes = RollingHashes(data)
    at = np.arange(len(data) - GRAM + 1)
    value = (hashes.of(at, at + GRAM) >> _PLACE_BITS) << _PLACE_BITS
    least = least_in_stretch(value | (_PLACE_MASK - at.astype(np.uint64)), STRETCH)
    place = (_PLACE_MASK - (least & _PLACE_MASK)).astype(np.int64)[: len(data) - LENGTH + 1]
    edge = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate([[0], edge])
    last = np.concatenate([edge, [len(place)]]) - 1
    place = place[first]
    low, high = np.zeros(len(place), np.int64), np.full(len(place), STRETCH)
    done = []
    while len(place):
        # Distances of these starts from the anchor lie in low .. high - 1.
        key = hashes.of(place - low, place - high + LENGTH + 1)
        key = mix(key ^ mix((low * (STRETCH + 1) + high).astype(np.uint64)))
        split = np.isin(key, hot) & (high - low > 1) if len(hot) else np.zeros(len(key), bool)
        whole = ~split
        done.append([x[whole] for x in (key, first, last, place)])
        place, first, last, low, high = (x[split] for x in (place, first, last, low, high))
        middle = (low + high) // 2
        first = np.concatenate([np.maximum(first, place - middle + 1), first])
        last = np.concatenate([last, np.minimum(last, place - middle)])
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
        place = np.concatenate([place, place])
        real = first <= last
        place, first, last, low, high = (x[real] for x in (place, first, last, low, high))
    key, first, last, place = (np.concatenate(x) for x in zip(*done))
    context = [hashes.of(first, last + LENGTH, k) for k in range(2)]
    return key, context[0], context[1], first, last, place


_ROW = "text_key binary, key bigint, context binary, first bigint, last bigint, place bigint"


def _anchor_batches(hot_keys):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = hot_keys.value
        for batch in batches:
            data, starts = text_bytes(batch.column(1))
            found: list[tuple[int, tuple]] = []
            for i, (s, e) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                # Starts are dealt to segments; a segment has all bytes of its strings.
                for b in range(s, e - LENGTH + 1, SEGMENT_BYTES):
                    rows = anchors(data[b : min(e, b + SEGMENT_BYTES + LENGTH - 1)], hot)
                    found.append((i, (*rows[:3], *(x + (b - s) for x in rows[3:]))))
            if not found:
                continue
            doc = np.repeat([i for i, _ in found], [len(r[0]) for _, r in found])
            key, one, two, first, last, place = (np.concatenate(x) for x in zip(*(r for _, r in found)))
            pairs = np.ascontiguousarray(np.stack([one, two], axis=1))
            fixed = pa.Array.from_buffers(pa.binary(16), len(key), [None, pa.py_buffer(pairs)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc)),
                    pa.array(key.view(np.int64)),
                    fixed.cast(pa.binary()),
                    *map(pa.array, (first, last, place)),
                ],
                names=["text_key", "key", "context", "first", "last", "place"],
            )

    return run


def repeated_starts(texts: list[bytes], anchor: list[int]) -> np.ndarray:
    """Which strings of ``LENGTH`` bytes of a collection stand in it more than once.

    ``anchor`` is each text's anchor, counted from its first byte; equal strings lie
    at the same distance from it. Returned is a row for each text and a column for
    each distance of a string's start before the anchor.

    The collection is put together column by column from the right, one symbol of
    each text a round. ``order`` holds the texts in the order of their suffixes so
    far, ``common`` how many symbols each suffix shares with the one before it. The
    column read next, in that order, is the round's part of the Burrows-Wheeler
    transform; sorting it stably gives the next order, and two suffixes with equal
    new symbols share one more than all suffixes that lay between them did.
    """
    columns = np.zeros((STRETCH - 1 + LENGTH, len(texts)), np.uint16)  # 0: no symbol
    for i, (text, a) in enumerate(zip(texts, anchor)):
        begin = STRETCH - 1 - a
        columns[begin : begin + len(text), i] = np.frombuffer(text, np.uint8)
    for i, (text, a) in enumerate(zip(texts, anchor)):
        columns[STRETCH - 1 - a : STRETCH - 1 - a + len(text), i] += 1
    repeated = np.zeros((len(texts), STRETCH), bool)
    order = np.arange(len(texts))
    common = np.zeros(len(texts) + 1, np.int32)  # one more, for the end
    for c in range(len(columns) - 1, -1, -1):
        transform = columns[c][order]
        moved = np.argsort(transform, kind="stable")
        symbols = transform[moved]
        bounds = np.flatnonzero(np.diff(symbols)) + 1
        new = np.zeros_like(common)
        for b, e in zip(np.concatenate([[0], bounds]), np.concatenate([bounds, [len(moved)]])):
            if symbols[b] and e - b > 1:
                new[b + 1 : e] = np.minimum.reduceat(common, moved[b:e] + 1)[:-1] + 1
        order, common = order[moved], new
        distance = STRETCH - 1 - c
        if distance >= 0:
            long = common >= LENGTH
            repeated[order[long[:-1] | long[1:]], distance] = True
    return repeated


def _collection_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, in collections of whole keys, to the starts that repeat."""
    held: list[tuple] = []

    def ready(rows: list[tuple]) -> pa.RecordBatch:
        marks = repeated_starts([r[2] for r in rows], [r[3] for r in rows])
        bits = [
            # By start, from the row's first one on.
            np.packbits(m[r[3] - np.arange(r[4])]).tobytes()
            for m, r in zip(marks, rows)
        ]
        some = [i for i, m in enumerate(marks) if m.any()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][0] for i in some], pa.int64()),
                pa.array([rows[i][1] for i in some], pa.binary()),
                pa.array([bits[i] for i in some], pa.binary()),
            ],
            names=["key", "context", "bits"],
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if len(held) >= COLLECTION and row[0] != held[-1][0]:
                yield ready(held)
                held = []
            held.append(row)
    if held:
        yield ready(held)


def _of_shared_keys(anchors: DataFrame) -> DataFrame:
    """The rows of the stored ``anchors`` whose key another row has too; those go."""
    shared = anchors.groupBy("key").count().filter("count > 1").select("key")
    shared = stored(shared, "shared")
    rows = stored(anchors.join(shared, "key", "left_semi").select(anchors.columns), "rows")
    for table in (anchors, shared):
        dropped(table)
    return rows


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Texts without the bytes of any ``LENGTH``-byte string that starts twice or more.

    Strings lie within one text each and are judged on the input; every occurrence
    goes, the first too. Columns: id_col, n_bytes, spans (start, end of the removed
    runs), kept (the other bytes). Null is empty; texts shorter than ``LENGTH`` stay
    whole; equal texts and repeated rows remove each other.

    The starts of every text are grouped by anchors that depend on the bytes around
    only, so equal strings have equal keys, and a row whose key stands nowhere else
    is done with. Of rows with equal keys and equal contexts one is taken, with
    their number. Keys with several contexts make the collections: their strings
    are fetched and sorted column by column (``repeated_starts``), many keys to a
    collection, each whole in one. A key with too many contexts is split first, by
    a new pass over the texts. Stored tables go when nothing reads them any more.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(
        F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("text_key"), text.alias("text")
    )
    hot = np.zeros(0, np.uint64)
    while True:
        shared = spark.sparkContext.broadcast(hot)
        long = texts.filter(F.octet_length("text") >= LENGTH).select("text_key", "text")
        rows = _of_shared_keys(stored(long.mapInArrow(_anchor_batches(shared), _ROW), "anchors"))
        one = F.min(F.struct("text_key", "first", "last", "place")).alias("one")
        contents = rows.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), one)
        contents = stored(contents, "contents")
        keys = contents.groupBy("key").agg(
            F.count(F.lit(1)).alias("contexts"),
            F.max(F.col("one.last") - F.col("one.first")).alias("width"),
        )
        keys = stored(keys.filter("contexts > 1"), "keys")
        most = max(MOST_ALIKE, int(MOST_SHARE * contents.count()))
        large = keys.filter((F.col("contexts") > most) & (F.col("width") > 0)).select("key")
        found = np.array([r["key"] for r in large.collect()], np.int64).view(np.uint64)
        if not len(np.setdiff1d(found, hot)):
            break
        hot = np.union1d(hot, found)
        for table in (rows, contents, keys):
            dropped(table)
    members = contents.join(keys.select("key"), "key").select(
        "key", "context", "one.text_key", "one.first", "one.last", "one.place"
    )
    wanted = members.groupBy("text_key").agg(
        F.collect_list(F.struct("key", "context", "first", "last", "place")).alias("rows")
    )
    single = texts.groupBy("text_key").agg(F.first("text").alias("text"))
    fetched = single.join(wanted, "text_key").select(
        F.encode("text", "UTF-8").alias("raw"), F.explode("rows").alias("r")
    )
    strings = fetched.select(
        "r.key",
        "r.context",
        F.substring("raw", (F.col("r.first") + 1).cast("int"),
                    (F.col("r.last") - F.col("r.first") + LENGTH).cast("int")).alias("string"),
        (F.col("r.place") - F.col("r.first")).cast("int").alias("anchor"),
        (F.col("r.last") - F.col("r.first") + 1).cast("int").alias("starts"),
    )
    collections = strings.repartition("key").sortWithinPartitions("key")
    partly = collections.mapInArrow(
        _collection_batches, "key bigint, context binary, bits binary"
    )
    # Null bits: all starts.
    wholly = contents.filter("n > 1").select("key", "context", F.lit(None).cast("binary").alias("bits"))
    known = wholly.unionByName(partly.join(wholly.select("key", "context"), ["key", "context"], "left_anti"))
    repeats = stored(known, "repeats")
    for table in (contents, keys):
        dropped(table)
    marks = rows.join(repeats, ["key", "context"]).groupBy("text_key").agg(
        F.collect_set(F.struct("first", "last", "bits")).alias("marks")
    )
    marks = stored(marks, "marks")
    for table in (rows, repeats):
        dropped(table)
    joined = texts.join(marks, "text_key", "left").select("id", "text", "marks")
    return joined.mapInArrow(
        _cut_batches, "id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    ).withColumnRenamed("id", id_col)


def removed_runs(size: int, marks: list[dict]) -> np.ndarray:
    """Starts and ends, a row each, of the runs that the marked strings cover."""
    change = np.zeros(size + 1, np.int32)
    for mark in marks:
        starts = np.arange(mark["first"], mark["last"] + 1)
        if mark["bits"] is not None:
            bits = np.unpackbits(np.frombuffer(mark["bits"], np.uint8), count=len(starts))
            starts = starts[bits.astype(bool)]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + LENGTH, -1)
    covered = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).view(np.int8), [0]])
    return np.flatnonzero(np.diff(covered)).reshape(-1, 2)


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        data, starts = text_bytes(batch.column(1))
        all_spans, kept = [], []
        for i, marks in enumerate(batch.column(2)):
            raw = data[starts[i] : starts[i + 1]].tobytes()
            runs = removed_runs(len(raw), marks.as_py()) if marks.is_valid else ()
            all_spans.append([{"start": int(a), "end": int(b)} for a, b in runs])
            ends = [0, *(int(b) for _, b in runs)]
            begins = [*(int(a) for a, _ in runs), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(ends, begins)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.diff(starts)),
                pa.array(all_spans, pa.list_(span)),
                pa.array(kept, pa.binary()),
            ],
            names=["id", "n_bytes", "spans", "kept"],
        )
