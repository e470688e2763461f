"""Near-equal vectors against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from safetymart.llm import vectors as v

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, cosine):
    """(id, links, component, kept) of each row, by comparing all of them."""
    valid, units = [], []
    for i, (_, x) in enumerate(rows):
        x = np.array([np.nan if c is None else np.float32(c) for c in x or []], float)
        if len(x) and np.isfinite(x).all() and x.any():
            x = x / np.abs(x).max()
            valid.append(i)
            units.append(x / np.linalg.norm(x))
    label = list(range(len(rows)))
    links = [0] * len(rows)
    near = np.array(units) @ np.array(units).T >= cosine if valid else np.zeros((0, 0), bool)
    for a, b in zip(*np.nonzero(near)):
        if a != b:
            links[valid[a]] += 1
    done = False
    while not done:
        done = True
        for a, b in zip(*np.nonzero(near)):
            a, b = valid[a], valid[b]
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                done = False
    members = {}
    for i, (vec_id, _) in enumerate(rows):
        members.setdefault(label[i], []).append(vec_id)
    least = {k: min((m for m in ms if m is not None), default=None) for k, ms in members.items()}
    return [(r[0], links[i], least[label[i]], r[0] == least[label[i]]) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(17)
    base = rng.normal(size=(300, 20))
    near = np.repeat(base[:25], 8, axis=0) + rng.normal(size=(200, 20)) * 0.2
    one = base[40] + rng.normal(size=(150, 20)) * rng.choice([0.01, 0.25, 0.4], 150)[:, None]
    rows = [x.astype(np.float32).tolist() for x in np.concatenate([base, near, one])]
    rows += [rows[7]] * 60 + [(np.float32(4) * np.array(rows[9], np.float32)).tolist()]
    rows += [None, [], [0.0] * 20, [None, *rows[3][1:]], [float("nan"), *rows[3][1:]], [float("inf"), *rows[3][1:]]]
    rows += [[1e-42] + [0.0] * 19, [1e38] * 20, [-0.0] * 19 + [1.0], [0.0] * 19 + [1.0]]
    ids = rng.permutation(len(rows)).tolist()
    out = [(i + 5, r) for i, r in zip(ids, rows)]
    return out + [out[0], (None, rows[7]), (None, rows[1]), (None, None)]


@pytest.mark.parametrize(("queries", "postings", "lists"), [(1024, 4096, 1024), (16, 24, 3)])
def test_all_pairs(spark, data, rows, monkeypatch, queries, postings, lists):
    monkeypatch.setattr(v, "BLOCK_QUERIES", queries)
    monkeypatch.setattr(v, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(v, "MAX_LISTS", lists)
    table = spark.createDataFrame(data, SCHEMA)
    table = table.withColumns({"key": F.lit(1), "node": F.lit("x"), "id": F.lit(2)})
    got, expected = rows(v.near_vectors(table)), sorted(plain(data, 0.95), key=repr)
    recall = sum(r[1] for r in got) / sum(r[1] for r in expected)
    assert recall > 0.99 and all(a[1] <= b[1] for a, b in zip(got, expected))
    if recall == 1:
        assert got == expected


def test_same_links_in_any_order(spark, data, rows):
    table = spark.createDataFrame(data, SCHEMA)
    assert rows(v.near_vectors(table)) == rows(v.near_vectors(table.orderBy(F.rand(1)).repartition(7)))


def test_components_by_few_links():
    rng = np.random.default_rng(2)
    for n, m, p in ((1, 1, 1), (7, 5, 0.2), (40, 60, 0.02), (30, 30, 0.5), (5, 5, 0)):
        links = rng.random((n, m)) < p
        few = list(v._forest(links))
        assert all(links[a, b] for a, b in few) and len(few) <= n + m

        def parts(pairs, n=n, m=m):
            label = list(range(n + m))
            for _ in range(n + m):
                for a, b in pairs:
                    label[a] = label[n + b] = min(label[a], label[n + b])
            return label

        assert parts(few) == parts(list(zip(*np.nonzero(links))))


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert v.near_vectors(none).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [0.0])], SCHEMA)
    assert sorted(map(tuple, v.near_vectors(nulls).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    single = spark.createDataFrame([(3, [1.0]), (2, [2.0]), (1, [-1.0])], SCHEMA)
    got = sorted(map(tuple, v.near_vectors(single).collect()))
    assert got == [(1, 0, 1, True), (2, 1, 2, True), (3, 1, 2, False)]
    with pytest.raises(ValueError, match="components"):
        v.near_vectors(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA))
