import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streamkit.llm import graph
from streamkit.llm import jaccard as J

SF = "/root/testdata/sf0.01"


def sets_of(texts, k):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute(texts, k, percent):
    """(size, root position) of each text."""
    sets = sets_of(texts, k)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders: dict = {}
    for i, s in enumerate(sets):
        shared: dict[int, int] = {}
        for x in s:
            for j in holders.setdefault(x, []):
                shared[j] = shared.get(j, 0) + 1
            holders[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_links_equal_brute_force(spark, k, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    ids = [d.doc_id for d in docs]
    want = {i: (n, ids[r]) for i, (n, r) in zip(ids, brute([d.text for d in docs], k, percent))}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.links(spark.read.parquet(f"{SF}/documents.parquet"), k, percent).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(want)


def test_chains_of_near_copies(spark, as_table):
    """Copies that drift apart are linked only through each other, in one
    large family with many exact copies."""
    rng = np.random.default_rng(9)
    base, rows = [f"w{i}" for i in range(120)], []
    for i in range(150):
        if i % 3:
            base = list(base)
            base[rng.integers(120)] = f"n{i}"
        rows.append((1000 - i, " ".join(base)))
    rows += [(2000 + i, rows[7][1]) for i in range(40)]
    path = as_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), "documents")
    want = brute([t for _, t in rows], 3, 90)
    groups: dict[int, list[int]] = {}
    for (i, _), (_, r) in zip(rows, want):
        groups.setdefault(r, []).append(i)
    least = {i: min(g) for g in groups.values() for i in g}
    got = {r.doc_id: r.component_id for r in J.op8_jaccard_join(spark, path).collect()}
    assert got == least and len(groups) < 60


def test_odd_rows(spark, odd_docs, no_docs, as_table):
    rows = J.links(odd_docs, 3, 90).collect()
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.first) for r in rows)
    assert [x[:3] for x in got if x[0] not in (4,)] == [(0, 1, 0), (1, 1, 1), (2, 0, 2), (3, 0, 3), (5, 1, 1), (5, 1, 1), (6, 1, 6), (6, 1, 6), (7, 0, 7), (8, 4, 8)]
    assert sum(x[3] for x in got) == len(got) - 2  # the two rows of document 5 are linked with 1
    assert J.links(no_docs, 3, 90).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.sampled_from([80, 90]), st.integers(0, 2 ** 31))
def test_linked_sets_share_a_key(common, only_a, only_b, percent, seed):
    rng = np.random.default_rng(seed)
    h = np.unique(rng.integers(0, 2 ** 63, common + only_a + only_b, dtype=np.uint64) * np.uint64(2))
    rng.shuffle(h)
    a, b = np.sort(h[:common + only_a]), np.sort(np.concatenate([h[:common], h[common + only_a:]]))
    both, total = len(np.intersect1d(a, b)), len(np.union1d(a, b))
    if len(a) and len(b) and 100 * both >= percent * total and both < total:
        assert len(np.intersect1d(J.part_keys(a, percent), J.part_keys(b, percent)))
    if len(a) and len(b):
        apart = sum(int(x).bit_count() for x in (J.sketch(a) ^ J.sketch(b)).view(np.uint64))
        assert apart <= total - both


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(60)] + [tuple(map(int, x)) for x in rng.integers(100, 200, (60, 2))] + [(300, 300), (500, 400), (400, 500)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(len(edges)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if x != r}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_pairs_remain_of_a_large_group_of_near_copies(spark, as_table, monkeypatch):
    """The members that come first are like none of the others, which are alike."""
    rng = np.random.default_rng(3)
    texts = []
    for i in range(400):
        copy = [f"w{j}" for j in range(300)]
        for at in rng.choice(300, 10 if i < 20 else 3, replace=False):
            copy[at] = f"x{i}-{at}"
        texts.append(" ".join(copy))
    pairs, stage = {}, J.stage_table

    def counted(df, name):
        out = stage(df, name)
        pairs[name] = out.count()
        return out

    monkeypatch.setattr(J, "stage_table", counted)
    folder = as_table(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), "documents")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.links(spark.read.parquet(f"{folder}/documents.parquet"), 5, 80).collect()}
    assert got == dict(enumerate(brute(texts, 5, 80)))
    assert pairs["across"] < len(texts)
