import math

import numpy as np
import pytest

from streamkit.llm import impacts, partitions

SF = "/root/testdata/sf0.01"


def load(spark, path):
    rows = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()
    return [(r.vec_id, r.embedding) for r in rows]


def usable(rows, zero):
    return [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))]


def products(rows, k=10):
    rows = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in usable(rows, True)]
    out = []
    for q in sorted({i for i, _ in rows if i % 100 == 0}):
        mine = next(v for i, v in rows if i == q)
        best = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in rows if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def distances(rows, k=10):
    rows = usable(rows, False)
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for q in sorted({i for i, _ in rows if i % 100 == 0}):
        d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


@pytest.fixture()
def odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(1, 350)]
    rows += [(i, [0.5, 0.5, 0.25, -1.0]) for i in range(350, 500)]  # many copies
    rows += [(500, [0.5, 0.5, 0.25, -1.0]), (600, None), (700, []), (800, [0.0] * 4), (900, [1.0, None, 0.0, 0.0]), (1000, [1.0, float("nan"), 0.0, 0.0]),
             (1100, [float("inf"), 0.0, 0.0, 0.0]), (1200, [1.0, 2.0]), (None, [1.0] * 4), (-100, [-3.0, 1e-9, 40.0, -40.0]), (0, rng.normal(size=4).tolist())]
    return rows, spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, x string")


def test_impact_search_query(spark):
    got = [tuple(r) for r in impacts.op7_impact_search(spark, SF).orderBy("query_id", "rank").collect()]
    assert got == products(load(spark, SF))


def test_impact_search_odd_rows(spark, odd_vectors, as_table, monkeypatch):
    rows, df = odd_vectors
    path = as_table(df, "embeddings")
    want = products([(i, v) for i, v in rows if i != 1200])
    assert [tuple(r) for r in impacts.op7_impact_search(spark, path).orderBy("query_id", "rank").collect()] == want
    monkeypatch.setattr(impacts, "ROWS", 40)
    monkeypatch.setattr("streamkit.llm.vectors.QUERIES", 2)
    assert [tuple(r) for r in impacts.op7_impact_search(spark, path).orderBy("query_id", "rank").collect()] == want
    assert impacts.op7_impact_search(spark, as_table(df.limit(0), "embeddings", "none")).count() == 0


def test_impact_index_stops_on_proof():
    """Few possible members are left, and the true ones are among them."""
    rng = np.random.default_rng(8)
    x = (rng.normal(size=(4000, 32)) ** 3 * 300).astype(np.int64)
    q, own = x[:20], np.zeros((4000, 20), bool)
    own[np.arange(20), np.arange(20)] = True
    for i, rows in enumerate(impacts.ImpactIndex(x).top(q, own, 10)):
        score = x @ q[i]
        score[i] = -(2 ** 62)
        assert set(np.argsort(-score, kind="stable")[:10]) <= set(rows.tolist()) and len(rows) < 2000


def test_learned_partitions_recall(spark, tmp_path):
    """Measured against brute force, on a larger table than the oracle's."""
    for path in (SF, "/root/testdata/sf0.1"):
        got: dict = {}
        for r in partitions.op3_learned_partitions(spark, path).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        want = distances(load(spark, path))
        assert set(got) == set(want)
        hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
        assert hits >= 0.9 * sum(map(len, want.values()))
        for q in got:
            assert got[q] == sorted(got[q], key=lambda x: (x[1], x[0])) and len(got[q]) == 10


def test_learned_partitions_odd_rows(spark, odd_vectors, as_table, monkeypatch):
    rows, df = odd_vectors
    monkeypatch.setattr(partitions, "ROWS", 30)
    path = as_table(df, "embeddings")
    want = distances([(i, v) for i, v in rows if i != 1200])
    got: dict = {}
    for r in partitions.op3_learned_partitions(spark, path).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want)
    assert [i for i, _ in got[500]] == list(range(350, 360)) and got[500][0][1] == 0.0  # ties to the smaller id
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert partitions.op3_learned_partitions(spark, as_table(df.limit(0), "embeddings", "none")).count() == 0


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1024, 8)) + 6 * rng.normal(size=(16, 8))[rng.integers(0, 16, 1024)]
    graph = partitions.neighbour_graph(x, 10)
    part = partitions.balanced_parts(graph, 16)
    assert set(np.bincount(part, minlength=16)) == {64}
    cut = (part[:, None] != part[graph]).mean()
    assert cut < 0.4 < (rng.permutation(part)[:, None] != part[graph]).mean()
