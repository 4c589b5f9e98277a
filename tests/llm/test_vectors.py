"""Vector operators against brute force, and the registered queries' columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cadastra.llm import neighbours, top_k
from cadastra.llm.common import table

NAN = float("nan")
ODD = [
    (1, [1.0, 0.5, -0.25]), (2, None), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 0.0]), (5, [NAN, 1.0, 0.0]), (6, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
    (100, [0.1, 0.2, 0.3]), (200, [0.1, 0.2, 0.3]), (7, [0.1, 0.2, 0.3]), (8, [0.5, 0.25, 0.125]), (9, [-1.0, -0.5, 0.25]),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "s", 0.0) for i, v in rows], "vec_id long, embedding array<float>, label int, node string, score double")


def usable(rows, zero):
    return {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))}


def best(vectors, queries, k, score):
    out = []
    for q in queries:
        rows = sorted((-score(vectors[q], v), i) for i, v in vectors.items() if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(rows)]
    return out


def units(a, b):
    return int((np.floor(1024 * a).astype(np.int64) * np.floor(1024 * b).astype(np.int64)).sum())


def test_exact_top_k(spark, sf_dir):
    given = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    ties = [(k, [float(k % 3), 1.0]) for k in range(400)]
    for rows in (given, ODD, ties):
        vectors = usable(rows, True)
        want = best(vectors, [i for i in vectors if i % 100 == 0], 10, units)
        got = top_k.search(top_k.integer_vectors(frame(spark, rows)), F.col("vec_id") % 100 == 0)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert top_k.search(top_k.integer_vectors(frame(spark, [])), F.col("vec_id") % 100 == 0).count() == 0
    large = [(k, [float(1 << 18), float(k)]) for k in range(0, 300, 50)]  # beyond the exact range of doubles
    vectors = usable(large, True)
    got = top_k.search(top_k.integer_vectors(frame(spark, large)), F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(best(vectors, [0, 100, 200], 10, units))


def test_exact_top_k_of_very_large_components(spark):
    rng = np.random.default_rng(8)
    rows = [(k, [float(x) for x in rng.normal(size=4)]) for k in range(300)]
    rows += [(1000 + k, [float(s * 10.0**e), 0.0, 0.5, -0.25]) for k, (s, e) in enumerate((s, e) for s in (1, -1) for e in range(6, 16))]
    rows += [(2000 + k, [1e12 + k, -1e12, 1.0, float(k)]) for k in range(5)] + [(3000, [1e20, 0.0, 0.0, 0.0]), (3100, [1e308, -1e308, 0.0, 1.0])]
    whole = {i: [max(min(int(np.floor(1024 * x)) if abs(x) < 1e17 else int(np.sign(x)) * (2**63 - 1024), 2**63 - 1024), 1024 - 2**63) for x in np.array(v)] for i, v in rows}

    def score(a, b):
        return max(min(sum(x * y for x, y in zip(a, b, strict=True)), 2**63 - 1), 1 - 2**63)

    want = best(whole, [i for i in whole if i % 100 == 0], 10, score)
    for parts in (1, 7):  # however the rows are batched
        got = top_k.search(top_k.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)), F.col("vec_id") % 100 == 0)
        assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)


def test_neighbours(spark, sf_dir):
    given = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    copies = [(k, [1.0, 2.0, 3.0] if k % 3 else [float(k), 1.0, -float(k % 7)]) for k in range(1, 200)]
    for rows in (given, ODD, copies):
        vectors = usable(rows, False)
        want = best(vectors, [i for i in vectors if i % 20 == 0], 20, lambda a, b: float(a @ b))
        got = sorted(map(tuple, neighbours.search(neighbours.usable(frame(spark, rows)), F.col("vec_id") % 20 == 0).collect()))
        assert [r[:2] for r in got] == [r[:2] for r in sorted(want)]
        for g in got:
            assert g[3] == pytest.approx(float(vectors[g[0]] @ vectors[g[2]]), rel=1e-9, abs=1e-12)
        have, need = {(g[0], g[2]) for g in got}, {(w[0], w[2]) for w in want}
        assert len(have & need) >= 0.95 * len(need)
    assert neighbours.search(neighbours.usable(frame(spark, [])), F.col("vec_id") % 20 == 0).count() == 0


def test_graph_joins_improve_recall(spark):
    rng = np.random.default_rng(4)
    points = rng.standard_normal((3_000, 16))
    points /= np.linalg.norm(points, axis=1)[:, None]
    df = neighbours.usable(frame(spark, [(k, [float(x) for x in v]) for k, v in enumerate(points)]))
    what = neighbours.Graph(projections=2, block=200, neighbours=24)
    exact = np.argsort(-(points @ points.T), axis=1)[:, 1:21]

    def recall(rounds):
        weak = neighbours.Graph(**{**what.__dict__, "rounds": rounds, "steps": 3})
        rows = neighbours.search(df, F.col("vec_id") % 20 == 0, what=weak).collect()
        found = {}
        for r in rows:
            found.setdefault(r["query_id"], set()).add(r["vec_id"])
        return np.mean([len(found[q] & set(exact[q].tolist())) / 20 for q in found])

    low, high = recall(0), recall(3)
    assert high >= 0.9 and high > low


def test_neighbours_of_vectors_of_mixed_norms(spark):
    rng = np.random.default_rng(9)
    points = rng.standard_normal((4_000, 24))
    points *= (np.exp(1.2 * rng.standard_normal(4_000)) / np.linalg.norm(points, axis=1))[:, None]
    points[::40] *= 1e-6  # some queries are far below half precision beside the longest vector
    points = points.astype(np.float32).astype(float)
    df = neighbours.usable(frame(spark, [(k, [float(x) for x in v]) for k, v in enumerate(points)]))
    rows = neighbours.search(df, F.col("vec_id") % 20 == 0, what=neighbours.Graph(block=500)).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    score = points[::20] @ points.T
    score[np.arange(200), np.arange(0, 4_000, 20)] = -np.inf
    exact = np.argsort(-score, axis=1)[:, :20]
    recall = np.mean([len(found[20 * k] & set(exact[k].tolist())) / 20 for k in range(200)])
    print("recall", recall)
    assert recall >= 0.95


def test_registered_queries(spark, sf_dir):
    queries = entry.queries()
    names = {n.split("_")[0] for n in queries if n.startswith("op") and n[2].isdigit()}
    assert names == {f"op{k}" for k in range(1, 11)} and "pipeline" in queries
