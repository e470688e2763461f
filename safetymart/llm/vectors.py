"""Near-equal vectors by product quantisation: inverted lists, table lookups, exact cosines."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetymart.llm.common import stored, text_bytes
from safetymart.llm.components import components

# The index is fitted on so many distinct vectors, or fewer of a larger dimension.
SAMPLE_ROWS, SAMPLE_BYTES = 16_384, 64 << 20
MAX_LISTS = 1_024
PART_DIMENSIONS, CODEWORDS, ROUNDS = 8, 256, 6
# A link is missed if its noise between two lists is so many standard deviations.
SIGMAS = 4.5
# Queries and postings of one list that a task compares at a time.
BLOCK_QUERIES, BLOCK_POSTINGS = 1_024, 4_096
# More than the rounding of single precision in a distance between unit vectors.
SLACK = 1e-3

_PAIR = "a bigint, b bigint, n bigint"


def _k_means(rows: np.ndarray, k: int, rng: np.random.Generator, unit: bool) -> np.ndarray:
    """``k`` centres of ``rows`` at most, of length 1 if ``unit``."""
    centres = rows[rng.permutation(len(rows))[:k]].copy()
    for _ in range(ROUNDS):
        near = _nearest(rows, centres)
        order = np.argsort(near, kind="stable")
        used, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(rows[order], first)
        sizes = np.diff(np.append(first, len(rows)))[:, None]
        centres[used] = sums / sizes
        if unit:
            length = np.linalg.norm(centres, axis=1, keepdims=True)
            centres = np.where(length > 0, centres / np.where(length > 0, length, 1), centres)
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = np.einsum("ij,ij->i", centres, centres) / 2
    out = [(r @ centres.T - half).argmax(axis=1) for r in np.array_split(rows, len(rows) // 4096 + 1)]
    return np.concatenate(out)


@dataclass
class Index:
    """Coarse centres, and codewords of each part of what is left after them."""

    centres: np.ndarray
    parts: list[np.ndarray]  # the dimensions of each part
    words: list[np.ndarray]  # codewords by dimensions of the part
    margin: float

    @classmethod
    def fit(cls, sample: np.ndarray, n_lists: int, cosine: float) -> Index:
        rng = np.random.default_rng(31)
        centres = _k_means(sample, n_lists, rng, unit=True)
        rest = sample - centres[_nearest(sample, centres)]
        dimensions = sample.shape[1]
        parts = np.array_split(np.arange(dimensions), max(1, dimensions // PART_DIMENSIONS))
        words = [_k_means(np.ascontiguousarray(rest[:, p]), CODEWORDS, rng, unit=False) for p in parts]
        # How far a random direction between two vectors moves the order of two lists.
        z = sample[rng.permutation(len(sample))[:2048]] - sample[rng.permutation(len(sample))[:2048]]
        length = np.linalg.norm(z, axis=1)
        z = z[length > 0] / length[length > 0, None]
        spread = float((z @ centres.T).std() * math.sqrt(2)) if len(z) else 0.0
        noise = math.sqrt(max(0.0, 1 - cosine**2)) * spread
        return cls(centres, parts, words, SIGMAS * noise / (1 + cosine))

    def encode(self, rows: np.ndarray):
        """Each row's list, the lists it is posted in, its code, error and coded length."""
        score = rows @ self.centres.T
        own = score.argmax(axis=1)
        posted = score >= score.max(axis=1, keepdims=True) - self.margin
        rest = rows - self.centres[own]
        code = np.empty((len(rows), len(self.parts)), np.uint8)
        coded = self.centres[own]
        for k, (part, words) in enumerate(zip(self.parts, self.words)):
            code[:, k] = _nearest(rest[:, part], words)
            coded[:, part] += words[code[:, k]]
        error = np.linalg.norm(rows - coded, axis=1)
        return own, posted, code, error, np.einsum("ij,ij->i", coded, coded)

    def distances(self, queries: np.ndarray, own: np.ndarray, code: np.ndarray, norm: np.ndarray):
        """Squared distances of queries to coded rows, by a table for each query and part."""
        lists, place = np.unique(own, return_inverse=True)
        product = (queries @ self.centres[lists].T).astype(np.float32)[:, place]
        for k, (part, words) in enumerate(zip(self.parts, self.words)):
            table = (queries[:, part] @ words.T).astype(np.float32)
            product += table[:, code[:, k]]
        return 1 - 2 * product + norm[None, :]


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector) to (id, size, unit vector as doubles, its digest); null if there is none."""
    for batch in batches:
        sizes, units, keys = [], [], []
        column = batch.column(1).cast(pa.list_(pa.float64()))
        values = column.values
        numbers = values.to_numpy(zero_copy_only=False)  # null components become NaN
        starts = column.offsets.to_numpy()
        there = column.is_valid().to_numpy(zero_copy_only=False)
        for a, b, valid in zip(starts[:-1].tolist(), starts[1:].tolist(), there.tolist()):
            v = numbers[a:b] if valid else numbers[:0]
            most = np.abs(v).max(initial=0.0)
            if not most > 0 or not np.isfinite(v).all():  # NaN is not above 0 either
                sizes.append(None)
                units.append(None)
                keys.append(None)
                continue
            v = v / most
            data = (v / np.linalg.norm(v) + 0.0).tobytes()  # one zero, not two
            sizes.append(b - a)
            units.append(data)
            keys.append(hashlib.blake2b(data, digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int32()), pa.array(units, pa.binary()), pa.array(keys, pa.binary())],
            names=["id", "size", "unit", "key"],
        )


def _rows(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """A binary column of rows of one length, as an array of rows."""
    data, starts = text_bytes(column)
    return data[starts[0] : starts[-1]].view(dtype).reshape(len(column), -1)


def _encoded(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for at in range(0, len(batch), 2048):
                some = batch.slice(at, 2048)
                rows = _rows(some.column("unit"))
                own, posted, code, error, norm = index.encode(rows)
                lists = np.nonzero(posted)
                ends = np.concatenate([[0], np.cumsum(posted.sum(axis=1))])
                posts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lists[1], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(some.column(c) for c in ("node", "copies", "unit")),
                        pa.array(own, pa.int32()),
                        posts,
                        pa.array([c.tobytes() for c in code], pa.binary()),
                        pa.array(error, pa.float64()),
                        pa.array(norm, pa.float64()),
                    ],
                    names=["node", "copies", "unit", "own", "posts", "code", "error", "norm"],
                )

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Sorted rows as one table for each value of the first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        changes = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        for a, b in zip([0, *changes.tolist()], [*changes.tolist(), len(batch)]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _candidates(shared, reach: float):
    """Groups of queries and postings to those of them that table lookups can't part.

    A query within ``reach`` of a vector is within ``reach`` and the vector's error
    of its coded form, so that no link is lost here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for group in _groups(batches, 3):
            asks = group.column("asks").to_numpy()
            queries, postings = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
            if not len(queries) or not len(postings):
                continue
            own = postings.column("own").to_numpy()
            code = _rows(postings.column("data"), np.uint8)
            error, norm = (postings.column(c).to_numpy() for c in ("error", "norm"))
            rows = _rows(queries.column("data"))
            near = index.distances(rows, own, code, norm.astype(np.float32))
            near = near <= ((reach + error + SLACK) ** 2).astype(np.float32)[None, :]
            nodes = queries.column("node").to_numpy(), postings.column("node").to_numpy()
            near &= nodes[0][:, None] != nodes[1][None, :]
            hit = near.any(axis=1), near.any(axis=0)
            found = np.concatenate([nodes[0][hit[0]], nodes[1][hit[1]]])
            if len(found):
                key = [pa.array(np.full(len(found), group.column(i)[0].as_py()), pa.int32()) for i in range(3)]
                kind = np.arange(len(found)) < hit[0].sum()
                yield pa.RecordBatch.from_arrays(
                    [*key, pa.array(found), pa.array(kind)], names=["list", "qb", "pb", "node", "asks"]
                )

    return run


def _forest(links: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links (row, column) enough to reach everything that all links reach."""
    rows_left = links.any(axis=1)
    columns_left = links.any(axis=0)
    while rows_left.any():
        start = int(rows_left.argmax())
        rows_left[start] = False
        front = np.array([start])
        while len(front):
            reached = links[front]
            new = np.flatnonzero(reached.any(axis=0) & columns_left)
            columns_left[new] = False
            yield from zip(front[reached[:, new].argmax(axis=0)].tolist(), new.tolist())
            reached = links[:, new]
            front = np.flatnonzero(reached.any(axis=1) & rows_left) if len(new) else new
            rows_left[front] = False
            if len(front):
                yield from zip(front.tolist(), new[reached[front].argmax(axis=1)].tolist())


def _linked(cosine: float):
    """Groups of vectors to links: a count for each node, and enough pairs to connect them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            asks = group.column("asks").to_numpy()
            queries, postings = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
            if not len(queries) or not len(postings):
                continue
            links = _rows(queries.column("unit")) @ _rows(postings.column("unit")).T >= cosine
            x, y = queries.column("node").to_numpy(), postings.column("node").to_numpy()
            links &= x[:, None] != y[None, :]
            # The pair comes up in the other's list too if the query is posted there.
            posts = queries.column("posts").combine_chunks()
            own = postings.column("own").to_numpy()
            places, lists = np.unique(own, return_inverse=True)
            flat = posts.values.to_numpy()[posts.offsets[0].as_py() : posts.offsets[-1].as_py()]
            row = np.repeat(np.arange(len(x)), np.diff(posts.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(places, flat), len(places) - 1)
            twice = np.zeros((len(x), len(places)), bool)
            twice[row[places[at] == flat], at[places[at] == flat]] = True
            once = links & ~twice[:, lists]
            n_x = links @ postings.column("copies").to_numpy()
            n_y = queries.column("copies").to_numpy() @ once
            pairs = list(_forest(links))
            a = [x[n_x > 0], y[n_y > 0], x[[p for p, _ in pairs]] if pairs else x[:0]]
            b = y[[q for _, q in pairs]] if pairs else y[:0]
            n = [n_x[n_x > 0], n_y[n_y > 0]]
            counts = len(n[0]) + len(n[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(a)),
                    pa.concat_arrays([pa.nulls(counts, pa.int64()), pa.array(b)]),
                    pa.concat_arrays([pa.array(np.concatenate(n)), pa.nulls(len(b), pa.int64())]),
                ],
                names=["a", "b", "n"],
            )

    return run


def _links(classes: DataFrame, n_classes: int, size: int, cosine: float) -> DataFrame:
    """Rows (a, null, n): links of node a found; rows (a, b, null): links that connect."""
    spark = classes.sparkSession
    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    sample = classes.select("unit").orderBy(F.xxhash64("key"), "key").limit(wanted).collect()
    sample = np.frombuffer(b"".join(bytes(r["unit"]) for r in sample)).reshape(-1, size)
    n_lists = max(1, min(MAX_LISTS, 2 * math.isqrt(n_classes), len(sample) // 8))
    shared = spark.sparkContext.broadcast(Index.fit(sample, n_lists, cosine))
    encoded = classes.select("node", "copies", "unit").mapInArrow(
        _encoded(shared),
        "node bigint, copies bigint, unit binary, own int, posts array<int>, code binary, "
        "error double, norm double",
    )
    encoded = stored(encoded, "encoded")
    postings = encoded.select(F.explode("posts").alias("list"), "node", "own", "code", "error", "norm")
    # One row for each list; these are at most MAX_LISTS.
    asked = encoded.groupBy(F.col("own").alias("list")).agg(F.count(F.lit(1)).alias("nq"))
    given = postings.groupBy("list").agg(F.count(F.lit(1)).alias("np"))
    blocks = F.broadcast(
        asked.join(given, "list").select(
            "list",
            F.ceil(F.col("nq") / BLOCK_QUERIES).cast("int").alias("nq"),
            F.ceil(F.col("np") / BLOCK_POSTINGS).cast("int").alias("np"),
        )
    )

    def block(n: str) -> F.Column:
        return F.pmod(F.xxhash64("node"), n).cast("int")

    def each(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    none = F.lit(None)
    queries = encoded.withColumnRenamed("own", "list").join(blocks, "list").select(
        "list", block("nq").alias("qb"), each("np").alias("pb"), "node", F.lit(True).alias("asks"),
        none.cast("int").alias("own"), F.col("unit").alias("data"),
        none.cast("double").alias("error"), none.cast("double").alias("norm"),
    )
    postings = postings.join(blocks, "list").select(
        "list", each("nq").alias("qb"), block("np").alias("pb"), "node", F.lit(False).alias("asks"),
        "own", F.col("code").alias("data"), "error", "norm",
    )
    group = ["list", "qb", "pb"]
    rows = queries.unionByName(postings).repartition(*group).sortWithinPartitions(*group)
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    found = rows.mapInArrow(
        _candidates(shared, reach), "list int, qb int, pb int, node bigint, asks boolean"
    )
    found = stored(found, "candidates")
    named = found.join(encoded.select("node", "copies", "unit", "own", "posts"), "node")
    named = named.select(*group, "node", "asks", "copies", "unit", "own", "posts")
    exact = named.repartition(*group).sortWithinPartitions(*group).mapInArrow(_linked(cosine), _PAIR)
    return stored(exact, "links")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.95,
) -> DataFrame:
    """Links and the component of every vector in the graph of near-equal vectors.

    Vectors are linked if their cosine, in double precision, is ``cosine`` (above 0) or
    more. Columns: id_col, n_links (other rows linked directly), component_id (the
    smallest id reachable), kept (the id is the component's). Vectors that are null, empty
    or zero, or hold a null or non-finite component, are linked with nothing. Rows
    with equal vectors, repeated rows too, are linked. A null id is never the smallest
    unless a component has no other; ids are whole numbers. Vectors of two lengths stop
    the job. An empty table gives no rows; other columns are passed over.

    Rows with one direction are a class from the start, of any number of rows. The index
    is fitted on ``SAMPLE_ROWS`` classes with the smallest hashes: coarse centres, and
    codewords for parts of what is left. Every class has a code and is posted in the list
    of its nearest centre and in those nearly as near: ``SIGMAS`` times the noise that
    two linked vectors have between two lists, by the sample's spread. Each class asks
    its own list. Table lookups give the distance to each coded vector; with the coding
    error kept beside the code, they part only what is surely not linked. What is left
    is compared by full vectors. So a link is missed only if neither of the two is
    posted in the other's list, and none is false.

    No pair leaves a task but what connects its rows, their number at most; links are
    counted there. Lists are cut into blocks of bounded size on both sides, so that a
    list with a third of all vectors is spread over tasks. The work grows with the square
    of a list, which is a part of about 1 in ``MAX_LISTS`` of a large table.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    rows = stored(rows.mapInArrow(_unit, "id bigint, size int, unit binary, key binary"), "units")
    valid = rows.filter("key IS NOT NULL")
    classes = valid.groupBy("key", "unit").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    sizes = valid.agg(F.min("size"), F.max("size")).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of {sizes[0]} and of {sizes[1]} components")
    n_classes = classes.count()
    if not n_classes:
        own = F.col("id")
        return rows.select(
            own.alias(id_col), F.lit(0).cast("long").alias("n_links"), own.alias("component_id"), F.lit(True).alias("kept")
        )
    links = _links(classes, n_classes, sizes[0], cosine)
    named = classes.select("key", "node", "copies", "id")
    counts = links.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    named = named.join(counts, "node", "left")
    edges = links.filter("b IS NOT NULL").select("a", "b")
    if edges.isEmpty():
        named = named.withColumn("component", F.col("node"))
    else:
        labels = components(edges).withColumnRenamed("id", "node")
        named = named.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(least, "component").select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    # Written, so that the join is between two shuffles and a large class can be split.
    joined = rows.join(stored(named, "named"), "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
