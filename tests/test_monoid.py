"""Mergeable user aggregates against one walk over each group."""

import datetime as dt
import pickle

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streamkit.operators import monoid as M
from streamkit.operators.monoid import Monoid

# joining texts: associative, not commutative; the state keeps its first and a count too
JOIN = Monoid({"text": "", "n": 0}, lambda a, r: {"text": a["text"] + (r["v"] or "-"), "n": a["n"] + 1},
              lambda a, b: {"text": a["text"] + b["text"], "n": a["n"] + b["n"]}, "text string, n long",
              "joined string, n long", lambda a: {"joined": a["text"][::-1], "n": a["n"]})

ROWS = [(None if i % 7 == 0 else "hot" if i % 3 else f"k{i % 11}", i, None if i % 5 == 0 else chr(97 + i % 26)) for i in range(300)]


def walked(rows, key=0):
    out, running = {}, []
    for r in rows:
        out[r[key]] = out.get(r[key], "") + (r[2] or "-")
        running.append((*r, out[r[key]][::-1], len(out[r[key]])))
    return out, running


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(ROWS, "k string, o long, v string").repartition(5)


@pytest.mark.parametrize("blocks", [1, 9])
def test_reduce_and_rolling(table, blocks):
    whole, running = walked(ROWS)
    got = {r.k: (r.joined, r.n) for r in M.reduce_monoid(table, ["k"], ["o"], JOIN, blocks).collect()}
    assert got == {k: (t[::-1], len(t)) for k, t in whole.items()}
    out = M.rolling_monoid(table, "k", "o", JOIN, blocks)
    assert out.columns == ["k", "o", "v", "joined", "n"]
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[1]) == running


def test_hot_key_is_split_over_blocks(table):
    rows = M._blocked(table, ["k"], ["o"], 9)
    states = M._block_states(rows, ["o"], JOIN)
    hot = [r for r in states.collect() if r[M.KEY].k == "hot"]
    assert len(hot) >= 8 and max(r[M._STATE].n for r in hot) < 0.2 * sum(r[M._STATE].n for r in hot)


def test_selector_keys_no_key_and_empty_table(table):
    _, running = walked([(r[1] % 2, *r[1:]) for r in ROWS])
    out = M.rolling_monoid(table, lambda d: d["o"] % 2, "o", JOIN, 6)
    assert sorted((r.o, r.joined) for r in out.collect()) == [(r[1], r[3]) for r in running]
    whole, _ = walked([(None, *r[1:]) for r in ROWS])
    assert [r.joined for r in M.reduce_monoid(table, [], ["o"], JOIN, 6).collect()] == [whole[None][::-1]]
    assert M.rolling_monoid(table.limit(0), "k", "o", JOIN).count() == 0
    assert M.reduce_monoid(table.limit(0), ["k"], ["o"], JOIN).count() == 0


def test_any_state_as_binary(table):
    """A set, pickled: the number of different values so far."""
    load, dump = pickle.loads, pickle.dumps
    distinct = Monoid({"s": dump(frozenset())}, lambda a, r: {"s": dump(load(a["s"]) | {r["v"]})}, lambda a, b: {"s": dump(load(a["s"]) | load(b["s"]))},
                      "s binary", "distinct long", lambda a: {"distinct": len(load(a["s"]))})
    seen: dict = {}
    want = {}
    for k, o, v in ROWS:
        seen.setdefault(k, set()).add(v)
        want[o] = len(seen[k])
    assert {r.o: r.distinct for r in M.rolling_monoid(table, "k", "o", distinct, 7).collect()} == want


@pytest.mark.parametrize("size, slide", [(60, None), (60, 25), (20, 60)])
def test_time_windows(spark, size, slide):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, t0 + dt.timedelta(seconds=7 * o), o, v) for k, o, v in ROWS] + [("hot", None, 999, "x")]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, o long, v string").repartition(4)
    out = M.time_window_monoid(df, "k", "ts", f"{size} seconds", ["ts", "o"], JOIN, f"{slide} seconds" if slide else None, blocks=5)
    step, want = slide or size, {}
    for k, ts, _, v in rows[:-1]:
        at = int(ts.replace(tzinfo=dt.timezone.utc).timestamp())
        for w in range((at - size) // step + 1, at // step + 1):
            want[k, w * step] = want.get((k, w * step), "") + (v or "-")
    got = {(r.k, int(r.window_start.replace(tzinfo=dt.timezone.utc).timestamp())): r.joined[::-1] for r in out.collect()}
    assert got == want
    with pytest.raises(ValueError):
        M.time_window_monoid(df, "k", "ts", "60 seconds", ["o"], JOIN, "20 seconds")


def test_count_windows(table):
    out = M.count_window_monoid(table, "k", "o", 20, JOIN, blocks=6)
    whole, _ = walked(ROWS)
    want = {(k, e): t[e - 20:e] for k, t in whole.items() for e in range(20, len(t) + 1, 20)}
    assert {(r.k, r.window_end_count): r.joined[::-1] for r in out.collect()} == want


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-50, 50), st.text("xyz", min_size=1, max_size=1)), max_size=40), st.integers(1, 8))
def test_rolling_equals_one_walk(spark, rows, blocks):
    rows = sorted({(k, o): (k, o, v) for k, o, v in rows}.values(), key=lambda r: r[1])
    _, running = walked(rows)
    out = M.rolling_monoid(spark.createDataFrame(rows, "k string, o long, v string"), "k", "o", JOIN, blocks)
    assert sorted((str(r.k), r.o, r.joined, r.n) for r in out.select("k", "o", "joined", "n").collect()) == sorted((str(r[0]), r[1], r[3], r[4]) for r in running)
