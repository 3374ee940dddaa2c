"""Near-duplicate vectors and nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import rows_of
from shelfcast.llm import ann, embedding_dups

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=0, n=400, size=16):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, size))
    for k in range(0, 120, 6):
        for j in range(1, 6):
            x[k + j] = x[k] + r.standard_normal(size) * 0.12 * j
    x[130:150] = x[129]
    return x.astype(np.float32)


def edge_rows(x):
    nan, inf = float("nan"), float("inf")
    size = x.shape[1]
    odd = [None, [], [0.0] * size, [nan] + [1.0] * (size - 1), [inf] + [1.0] * (size - 1), [None] + [1.0] * (size - 1)]
    rows = [(int(i), [float(v) for v in row], i % 3) for i, row in enumerate(x)]
    rows += [(1000 + i, v, None) for i, v in enumerate(odd)]
    rows.append((2000, [2 * v for v in rows[0][1]], None))
    rows.append(rows[5])
    return rows


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(embedding_dups, "TILE", 8)
    rows = edge_rows(vectors())
    ids = [r[0] for r in rows]
    good = [i for i, r in enumerate(rows) if r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    x = np.array([rows[i][1] for i in good], dtype=np.float64)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.arange(len(good))
    for _ in good:
        label = np.minimum(label, np.where(linked, label[None], len(good)).min(axis=1, initial=len(good)))
    least = {}
    for k, i in enumerate(good):
        least[label[k]] = min(least.get(label[k], ids[i]), ids[i])
    want = {i: (0, ids[i]) for i in range(len(rows))}
    want |= {i: (int(linked[k].sum()), least[label[k]]) for k, i in enumerate(good)}
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("x")).withColumn("key", F.lit(1))
    found = sorted(rows_of(embedding_dups.near_duplicates(df, 0.9)))
    want = sorted((ids[i], n, c) for i, (n, c) in want.items())
    assert [r[0] for r in found] == [w[0] for w in want]
    # no link that is none; a pair at the very threshold may be missed
    assert all(r[1] <= w[1] and r[3] == (r[0] == r[2]) for r, w in zip(found, want))
    assert sum(r[1] for r in found) >= 0.97 * sum(w[1] for w in want)
    assert sum(r[2] == w[2] for r, w in zip(found, want)) >= 0.97 * len(want)
    assert rows_of(embedding_dups.near_duplicates(spark.createDataFrame([], SCHEMA), 0.9)) == []


def test_links_of_a_chain_are_one_component():
    """In one bucket, each vector tells of one root: a link between two vectors that have smaller neighbours must not be lost."""
    i, j = np.array([0, 1, 2]), np.array([2, 3, 3])
    assert embedding_dups._roots(5, i, j).tolist() == [0, 0, 0, 0, 4]
    r = np.random.default_rng(2)
    a, b = r.integers(0, 300, 250), r.integers(0, 300, 250)
    label = np.arange(300)
    for _ in range(300):
        for x, y in zip(a, b):
            label[x] = label[y] = min(label[x], label[y])
    assert (embedding_dups._roots(300, a, b) == label).all()


@pytest.mark.parametrize("small", [0, 5, 1000])
def test_all_links_of_buckets_are_found(small, monkeypatch):
    """Offsets and matrix products give the same pairs, with and without tiles."""
    monkeypatch.setattr(embedding_dups, "SMALL", small)
    monkeypatch.setattr(embedding_dups, "PAIRS", 7)
    unit = embedding_dups.units(vectors(3, 200))
    starts = np.array([0, 1, 4, 30, 31, 100, 190])
    ends = np.append(starts[1:], 200)
    sides = np.arange(200) % 2
    for tiles in (None, sides):
        found = {(int(x), int(y)) for i, j in embedding_dups._links(unit, starts, ends, tiles, 0.9) for x, y in zip(i, j)}
        want = {
            (x, y) for a, b in zip(starts, ends) for x in range(a, b) for y in range(x + 1, b)
            if unit[x] @ unit[y] >= 0.9 and (tiles is None or sides[x] != sides[y])
        }
        assert found == want and found


def test_query_with_links_equals_sql(spark, tmp_path):
    from compare import difference

    from shelfcast.llm.queries import NEAR_DUPS_SQL, op4_embedding_near_dups

    rows = edge_rows(vectors())
    rows = [r for r in rows if r[0] != 5]  # SQL knows a vector by its id
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("*.parquet")
    part.rename(tmp_path / "embeddings.parquet")
    found = difference(op4_embedding_near_dups(spark, str(tmp_path)), NEAR_DUPS_SQL, str(tmp_path))
    assert found is None, found


def test_null_ids_take_part(spark):
    rows = [(None, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)]
    found = rows_of(embedding_dups.near_duplicates(spark.createDataFrame(rows, SCHEMA), 0.9))
    assert sorted(found, key=str) == sorted([(None, 1, 7, False), (7, 1, 7, True), (None, 0, None, True)], key=str)


@pytest.mark.parametrize("distance", [0.2, 0.447, 1.0])
def test_step_probability(distance):
    r = np.random.default_rng(4)
    shift = r.uniform(0, embedding_dups.WIDTH, 200_000)
    apart = shift + r.standard_normal(200_000) * distance
    same = (np.floor(shift / embedding_dups.WIDTH) == np.floor(apart / embedding_dups.WIDTH)).mean()
    assert same == pytest.approx(embedding_dups.same_step(distance), abs=0.01)


def test_nearest(spark):
    x = vectors(1, 900)
    rows = edge_rows(x) + [(None, [float(v) for v in x[0]], 1), (3000, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("x")).withColumn("query", F.lit(1))
    found = {}
    for q, rank, v, score in rows_of(ann.nearest(df, F.col("vec_id") % 50 == 0, k=10)):
        found.setdefault(q, {})[rank] = (v, score)
    points = {r[0]: np.array(r[1], dtype=np.float64) for r in rows if r[0] is not None and r[0] < 1000 or r[0] == 2000}
    ids = np.array(sorted(points))
    matrix = np.array([points[i] for i in ids])
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        d = np.sqrt(((matrix - points[q]) ** 2).sum(axis=1))
        near = [ids[i] for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        got = [found[q][r] for r in range(1, 11)]
        assert got == sorted(got, key=lambda p: (p[1], p[0]))
        assert all(s == pytest.approx(float(np.linalg.norm(points[v] - points[q])), abs=1e-12) for v, s in got)
        hits += len({v for v, _ in got} & set(near))
        total += 10
    assert hits / total >= 0.9
    assert set(found) == set(ids[ids % 50 == 0].tolist())


def clustered(n=6000, size=64, clusters=120):
    r = np.random.default_rng(9)
    x = r.standard_normal((clusters, size))[r.integers(0, clusters, n)] + 0.15 * r.standard_normal((n, size))
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


@pytest.mark.parametrize("data", ["sf0.01", "sf0.1", "clustered"])
def test_recall(spark, data):
    if data == "clustered":
        df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(clustered())], SCHEMA)
    else:
        df = spark.read.parquet(f"/root/testdata/{data}/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    found = {}
    for q, _, v, _ in rows_of(ann.nearest(df, F.col("vec_id") % 10 == 0, k=10)):
        found.setdefault(q, set()).add(v)
    hits = 0
    for q in found:
        d = ((x - x[ids == q][0]) ** 2).sum(axis=1)
        hits += len(found[q] & set([int(ids[i]) for i in np.lexsort((ids, d)) if ids[i] != q][:10]))
    assert len(found) == int((ids % 10 == 0).sum()) and hits / (10 * len(found)) >= 0.95


def test_queries_among_clusters_read_few_leaves():
    x = clustered()
    forest = ann.Forest([ann.Tree(x, 1000 + t) for t in range(ann.TREES)], x.astype(np.float64), 10)
    read = []
    for q in x[:60].astype(np.float64):
        leaves = forest.search(q, forest.sides(q[None])[0])
        read.append(len(np.unique(np.concatenate([forest.rows[leaf] for leaf in leaves]))) / len(x))
    assert np.mean(read) < 0.2


def test_nearest_with_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (2, [0.0, 1.0], 1)], SCHEMA)
    found = rows_of(ann.nearest(df, F.col("vec_id") == 0, k=10))
    assert sorted((q, r, v) for q, r, v, _ in found) == [(0, 1, 1), (0, 2, 2)]
    assert rows_of(ann.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") == 0, k=10)) == []
    assert rows_of(ann.nearest(df, F.col("vec_id") == 9, k=10)) == []


def test_pairs_at_the_threshold_are_found():
    r = np.random.default_rng(4)
    a, b = (embedding_dups.units(r.standard_normal((20_000, 32))) for _ in range(2))
    b = embedding_dups.units(b - (a * b).sum(axis=1, keepdims=True) * a)
    b = 0.9 * a + np.sqrt(1 - 0.81) * b
    tables = embedding_dups.Tables(32, 10_000, 0.9)
    assert (tables.keys(a) == tables.keys(b)).any(axis=1).mean() >= 0.998
