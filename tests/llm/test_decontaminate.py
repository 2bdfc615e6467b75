import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streamkit.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = {i: i + 32 for i in range(65, 91)}


def spans_of(text, items, n=10):
    """Brute force: words, hit word positions, ids of the items with a hit."""
    words, hit, ids = WORD.findall((text or "").translate(AZ)), set(), set()
    for item, its in items:
        mine = WORD.findall((its or "").translate(AZ))
        windows = [mine[i:i + n] for i in range(max(len(mine) - n + 1, 1))] if mine else []
        for w in windows:
            for i in range(len(words) - len(w) + 1):
                if words[i:i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    ids.add(item)
    return words, hit, sorted(str(i) for i in ids - {None})


def expected(docs, items):
    out = []
    for i, t in docs:
        words, hit, ids = spans_of(t, items)
        out.append((i, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def removed(text, items):
    """Brute force of ``decontaminate``: each hit word goes with the gap behind it."""
    _, hit, _ = spans_of(text, items)
    units = list(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", text))
    return text[:units[0].start()] + "".join(u.group() for j, u in enumerate(units) if j not in hit) if units else text


PASSAGE = "One two, THREE four five-six seven eight nine ten eleven twelve"
ITEMS = [(1, PASSAGE), (10, "Größe ÄRGER"), (2, "x9"), (2, "unrelated words here"), (3, None), (4, ""), (5, " .,!"), (None, "nameless thing"),
         (7, PASSAGE), (7, PASSAGE), (8, " ".join(f"w{i}" for i in range(25)))]
TEXTS = [(1, "..." + PASSAGE.lower().replace(" ", "\n") + "!"), (2, None), (3, ""), (4, ",;"), (5, "größe ärger"), (5, "größe Ärger"), (5, "größe Ärger"),
         (None, "A nameless-thing"), (6, "X9"), (7, " ".join(f"w{i}" for i in range(3, 19)) + " w3"), (8, PASSAGE + " " + PASSAGE), (9, "one two three four five six seven eight nine"),
         (11, "Ünïcode 🙂 x9 \x00 🙂x9"), (12, ("filler words " * 30_000) + PASSAGE + " tail"), (13, "w0")]


@pytest.fixture()
def odd(spark):
    docs = spark.createDataFrame([(i, t, 1, "a", [1], 0.5) for i, t in TEXTS], "doc_id long, text string, len int, win string, list array<int>, h double")
    bench = spark.createDataFrame([(i, t, "b") for i, t in ITEMS], "item_id long, text string, items string")
    return docs, bench


def test_odd_rows(spark, odd, as_table):
    docs, bench = odd
    as_table(bench, "benchmark")
    got = [tuple(r) for r in D.op11_decontamination(spark, as_table(docs, "documents")).collect()]
    assert sorted(got, key=repr) == expected(TEXTS, ITEMS)


def test_sets_too_large_to_broadcast_give_the_same(spark, odd, as_table, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_BYTES", 0)
    test_odd_rows(spark, odd, as_table)


def test_empty_tables(spark, odd, as_table):
    docs, bench = odd
    path = as_table(docs, "documents", "a")
    as_table(bench.limit(0), "benchmark", "a")
    assert {(r.n_hit, r.n_items, r.contaminated) for r in D.op11_decontamination(spark, path).collect()} == {(0, 0, False)}
    path = as_table(docs.limit(0), "documents", "b")
    as_table(bench, "benchmark", "b")
    assert D.op11_decontamination(spark, path).count() == 0


def test_removal(spark, odd):
    docs, bench = odd
    spans = D.decontaminate(docs, bench)
    assert spans.schema.names == docs.schema.names
    got = sorted((tuple(r) for r in spans.collect()), key=repr)
    assert got == sorted(((i, t if t is None else removed(t, ITEMS), 1, "a", [1], 0.5) for i, t in TEXTS), key=repr)
    whole = sorted((tuple(r) for r in D.decontaminate(docs, bench, remove="documents").collect()), key=repr)
    assert whole == sorted(((i, t, 1, "a", [1], 0.5) for i, t in TEXTS if not spans_of(t, ITEMS)[1]), key=repr)
    with pytest.raises(ValueError):
        D.decontaminate(docs, bench, remove="lines")


def test_main_path_runs_no_python(spark, odd):
    docs, bench = odd
    plan = D.scan(docs, bench)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and not re.search("Python|Pandas|Arrow|ExternalRDD.*Map", plan.replace("LogicalRDD", ""))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c".split()), max_size=30), min_size=1, max_size=5), st.lists(st.lists(st.sampled_from("A b c".split()), max_size=14), min_size=1, max_size=3))
def test_equals_brute_force(spark, docs, items):
    docs, items = [(i, " ".join(d)) for i, d in enumerate(docs)], [(i, "-".join(t)) for i, t in enumerate(items)]
    rows = D.scan(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    for r in rows:
        words, hit, ids = spans_of(docs[r.doc_id][1], items)
        assert (r.n_words, r.n_hit, r["items"]) == (len(words), len(hit), ids)
    assert len(rows) == len(docs)
