import math

import numpy as np
import pytest
from pyspark.errors import PySparkException

from streamkit.llm import covertree as C


def brute(rows, moved=True):
    """Python integers over all pairs; ``rows``: (vec_id, label, vector)."""
    use = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, (label + 1) % 10 if moved and i % 7 == 0 else label, [math.floor(256 * float(x)) for x in v]))
    out = []
    for anchor in sorted({i for i, _, _ in use if i % 100 == 0}):
        _, label, len_, mine = min((i, l, len(v), np.array(v, "<i8").tobytes()) for i, l, v in use if i == anchor)
        mine = np.frombuffer(mine, "<i8").tolist()
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i, l) for i, l, v in use if i != anchor and len(v) == len_)
        positives = [(-s, i) for s, i, l in scored if l == label][:5]
        for score, i in positives:
            window = [(-s, j) for s, j, l in scored if l != label and 80 * score <= 100 * -s <= 100 * score][:5]
            out += [(anchor, i, n + 1, j, score, s) for n, (s, j) in enumerate(window)]
    return sorted(out)


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 5))
    rows = [(i, int(i % 3), (centres[i % 6] + 0.2 * rng.normal(size=5)).tolist()) for i in range(1, 420)]
    rows += [(i, i % 2, [0.5, 0.5, 0.25, -1.0, 1.0]) for i in range(420, 700)]  # copies: a third of the rows
    rows += [(700, 0, [0.5, 0.5, 0.25, -1.0, 1.0]), (800, None, [1.0] * 5), (900, 1, None), (1000, 1, [1.0, None, 0.0, 0.0, 0.0]), (1100, 1, [float("nan")] * 5),
             (1200, 2, [0.0] * 5), (1300, 1, [1.0, 2.0]), (1301, 1, [2.0, 2.0]), (1302, 0, [2.0, 1.5]), (1400, 1, []), (1401, 1, []), (1402, 2, []),
             (1500, 9, [3.0] * 5), (None, 1, [1.0] * 5), (-100, 1, [-3.0, 1e-9, 40.0, -40.0, 2e5]), (1600, 7, [1.0, float("inf"), 0.0, 0.0, 0.0]), (0, 1, rng.normal(size=5).tolist())]
    return rows + [rows[5], rows[5], (300, 1, rows[10][2])]


def table(spark, rows):
    return spark.createDataFrame([(i, label, v, 1, "r", [1]) for i, label, v in rows], "vec_id long, label int, embedding array<double>, block int, row string, x array<int>")


def result(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_odd_rows(spark, odd, as_table):
    assert result(C.op12_hard_negatives(spark, as_table(table(spark, odd), "embeddings"))) == brute(odd)
    assert C.op12_hard_negatives(spark, as_table(table(spark, odd).limit(0), "embeddings", "none")).count() == 0


def test_small_blocks_and_groups_give_the_same(spark, odd, as_table, monkeypatch):
    monkeypatch.setattr(C, "ROWS", 64)
    monkeypatch.setattr(C, "TOGETHER", 2)
    monkeypatch.setattr(C, "LEAF", 3)
    assert C.plant(C.usable(table(spark, odd)).selectExpr("*", "monotonically_increasing_id() as row")).count() > 8
    assert result(C.op12_hard_negatives(spark, as_table(table(spark, odd), "embeddings"))) == brute(odd)


def test_products_that_may_not_fit_are_refused(spark):
    fits = [(i, i % 2, [2.0 ** 20 * (1 + i % 5), -1.0]) for i in range(90, 120)]
    assert result(C.hard_negatives(C.usable(table(spark, fits)))) == brute(fits, moved=False) != []
    with pytest.raises(PySparkException, match="may not fit in 64 bits"):
        C.hard_negatives(C.usable(table(spark, [*fits, (7, 1, [1e30, 0.0])]))).collect()


@pytest.mark.parametrize("scale", [1, 2 ** 20])
def test_tree_bounds_hold_and_skip_rows(scale):
    rng = np.random.default_rng(3)
    x = ((8 * rng.normal(size=(40, 16)))[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16))).round().astype(np.int64) * scale
    order, nodes = C.build(x)
    assert sorted(order.tolist()) == list(range(3000))
    place = np.argsort(order)
    tree = C.CoverTree(np.arange(3000)[order], np.zeros(3000, np.int64), x[order], nodes | {"centre": place[nodes["centre"]]})
    scored = 0
    for q in x[:40]:
        least, most = tree.bounds(q)
        score = x[order] @ q
        for n in range(len(nodes["lo"])):
            part = score[nodes["lo"][n]:nodes["hi"][n]]
            assert least[n] <= part.min() and part.max() <= most[n]
        high = np.array([np.sort(score)[-20], np.sort(score)[-5]])
        found, n = tree.search(q, np.ones(3000, bool), -(-80 * high // 100), high, 5)
        scored += n
        for (s, ids), top in zip(found, high):
            want = sorted((-v, i) for v, i in zip(score.tolist(), order.tolist()) if 80 * top <= 100 * v <= 100 * top)[:5]
            assert [(-a, b) for a, b in zip(s.tolist(), ids.tolist())] == want
    assert scored < 0.2 * 40 * 3000


def test_copies_are_one_leaf():
    _, nodes = C.build(np.ones((5000, 4), np.int64))
    assert len(nodes["lo"]) == 1
