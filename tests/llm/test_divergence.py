import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamkit.llm import divergence as V

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
AZ = {i: i + 32 for i in range(65, 91)}


def brute(docs, documents=10, top=10):
    """(lang, source, part, item, value, rank) with Python's integers."""
    n, seen = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        lang, source, terms = lang or "", source or "", TERM.findall((text or "").translate(AZ))
        n[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in seen:
        kept = sorted(t for t, c in seen[lang].items() if c >= documents)
        sources = sorted((s for g, s in n if g == lang), key=str.encode)
        whole = Counter()
        for s in sources:
            whole.update({t: n[lang, s][t] for t in kept})

        def p(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        q, ps = p(whole), {s: p(n[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((ps[s][t] - ps[o][t]) ** 2 // (ps[s][t] + ps[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [((ps[s][t] - q[t]) ** 2 // (ps[s][t] + q[t]), t) for t in kept if n[lang, s][t] and ps[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture()
def docs():
    rng = np.random.default_rng(5)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)] + ["Größe", "größe", "ÉTÉ", "x1y"]
    out = []
    for i in range(600):
        source = "hot" if i % 3 else f"s{i % 21}"
        lang = ("en", "de", None, "")[int(rng.integers(0, 4))]
        text = " ".join(rng.choice(words, size=int(rng.integers(0, 40)), p=np.linspace(2, 0.1, len(words)) / np.linspace(2, 0.1, len(words)).sum()))
        out.append((lang, source, text.upper() if i % 5 == 0 else text))
    out += [("en", None, "wab"), ("en", "", None), ("fr", "alone", "few words"), ("it", "a", "none kept"), ("it", "b", None), ("en", "long", "waa wab " * 40_000),
            ("en", "ascii", "123 -- \x00"), ("en", "\U0001f642", "waa"), ("en", "￿", "waa")] + [("nl", "same", "equal text")] * 12 + [("nl", "copy", "equal text")] * 12
    return out


@pytest.fixture()
def table(spark, docs):
    return spark.createDataFrame([(i, t, lang, s, 1, "x", 2) for i, (lang, s, t) in enumerate(docs)],
                                 "doc_id long, text string, lang string, source string, n int, term string, p long")


def test_equals_brute_force(spark, docs, table, as_table):
    assert rows(V.op13_divergence_audit(spark, as_table(table, "documents"))) == brute(docs)


def test_many_small_cells_and_flushes_give_the_same(docs, table, monkeypatch):
    monkeypatch.setattr(V, "GROUPS", 3)
    monkeypatch.setattr(V, "TERMS", 10)
    monkeypatch.setattr(V, "HELD", 20)
    monkeypatch.setattr(V, "AT_ONCE", 500)
    groups, terms = V.shares(table.repartition(5))
    plan = V.pair_divergences(groups, terms)._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert rows(V.audit(table.repartition(5))) == brute(docs)


def test_empty_table(table):
    assert V.audit(table.limit(0)).collect() == []
    assert V.audit(table.where("lang = 'it'")).where("value != 0 or part != 'pair'").count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(10 ** 15 + 7, 10 ** 16 + 3, 12345), (0, 9 * 10 ** 17, 10 ** 6), (9 * 10 ** 17, 9 * 10 ** 17, 1), (0, 0, 1)]
    df = spark.createDataFrame(cases, "n long, total long, kept long").select("n", "total", "kept", V.share(F.col("n"), F.col("total"), F.col("kept")).alias("p"))
    for r in df.collect():
        assert r.p == 1 + 10 ** 9 * (r.n + 2) // (r.total + 2 * r.kept)
    far = spark.createDataFrame([(10 ** 9 + 1, 1), (5, 5)], "p long, q long").select(V.gap(F.col("p"), F.col("q")).alias("f")).collect()
    assert [r.f for r in far] == [10 ** 18 // (10 ** 9 + 2), 0]
