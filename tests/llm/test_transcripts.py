import numpy as np
import pytest
from pyspark.sql import functions as F

from streamkit.llm import transcripts as T

SF = "/root/testdata/sf0.1"


def recovered(written, parsed):
    states = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "states"))), lambda x: x["states"]))
    got = parsed.groupBy("conv_id", "part").agg(states.alias("got")).withColumnsRenamed({"conv_id": "c", "part": "p"})
    both = written.join(got, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return [(s, g) for r in both.collect() for s, g in zip(r.states, r.got, strict=True)]


def test_roles_of_unseen_conversations(spark):
    """Fitted on one half of the conversations, measured on the other."""
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    half = F.crc32(F.col("conv_id").cast("string")) % 2 == 0
    model = T.fit(T.transcripts(table.where(half)))
    written = T.transcripts(table.where(~half)).cache()
    pairs = recovered(written, T.parse(written, model))
    assert np.mean([s == g for s, g in pairs]) > 0.97
    assert np.mean([s // 2 == g // 2 for s, g in pairs]) > 0.98


def test_unmarked_turns_are_many(spark):
    """The task is not just reading markers."""
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = T.transcripts(table).collect()
    heads = [(bool(T.MARKER.match(x)), s) for r in rows for x, s in zip([y for y in r.lines if y.strip()], r.states)]
    bare = sum(not m for m, s in heads if s % 2 == 0)
    assert 0.1 < bare / sum(s % 2 == 0 for _, s in heads) < 0.2


def test_viterbi_equals_brute_force():
    import itertools

    rng = np.random.default_rng(1)
    step, see = np.log(rng.dirichlet(np.ones(T.STATES + 1), T.STATES + 1)), np.log(rng.dirichlet(np.ones(T.CODES), T.STATES + 1))
    step[:, T.STATES] = -np.inf
    model = T.Model(step, see)
    for _ in range(10):
        codes = rng.integers(0, T.CODES, 4).tolist()

        def score(path, entry=T.STATES):
            return sum(step[a, b] + see[b, c] for a, b, c in zip((entry, *path), path, codes))

        best = max(itertools.product(range(T.STATES), repeat=4), key=score)
        assert tuple(model.path(codes, T.STATES, None)) == best
        m = model.matrix(codes)
        assert np.isclose(m[T.STATES].max(), score(best))
        first, second = model.matrix(codes[:2]), model.matrix(codes[2:])
        assert np.allclose((first[:, :, None] + second[None]).max(axis=1), m)


@pytest.mark.parametrize("turns", [1, 2, 256])
def test_parts_give_the_best_whole_path(spark, monkeypatch, turns):
    """The best path of a conversation has the same score however it is cut."""
    monkeypatch.setattr(T, "TURNS", turns)
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    written = T.transcripts(table).cache()
    model = T.fit(written)
    parsed = T.parse(written, model).collect()
    lines, states = {}, {}
    for r in sorted(written.collect(), key=lambda r: r.part):
        lines.setdefault(r.conv_id, []).extend([c for c in T.observe(r.lines)[0]])
    for r in sorted(parsed, key=lambda r: (r.part, r.piece)):
        states.setdefault(r.conv_id, []).extend(r.states)
    for name, codes in lines.items():
        path = (T.STATES, *states[name])
        score = sum(model.step[a, b] + model.see[b, c] for a, b, c in zip(path, path[1:], codes))
        assert np.isclose(score, model.matrix(codes)[T.STATES].max())


def test_rendering(spark):
    rows = [(1, 0, "user", "hi\nthere?"), (1, 1, "assistant", "yes"), (1, 1, "assistant", "yes")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    model = T.fit(T.transcripts(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")))
    out = T.parse(T.transcripts(table), model).orderBy("piece").collect()
    assert "".join(r.rendered for r in out) == "<|im_start|>user\nhi\nthere?<|im_end|>\n<|im_start|>assistant\nyes"


def test_odd_rows(spark, as_table):
    rows = [(1, 0, "user", None), (1, None, "tool", "x"), (None, 3, None, "y"), (None, 3, None, "y"), (2, 5, "assistant", ""), (3, 1, "user", "z " * 100_000),
            (3, 1, "user", "other"), (4, 700, "system", "late"), (4, -300, "user", "early")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    out = T.op9_transcript_roles(spark, as_table(table, "conversations")).collect()
    assert {r.conv_id for r in out} == {"1", "2", None, "3", "4"} and all(r.role in T.ROLES for r in out)
    assert sorted(r.part for r in out if r.conv_id == "4") == [-2, 2]
    assert T.op9_transcript_roles(spark, as_table(table.limit(0), "conversations", "none")).count() == 0


def test_repeated_turn_numbers_are_cut(spark, monkeypatch):
    """One conversation that repeats its turn numbers: no group of rows or matrices is larger than its bound, and the path is the best."""
    model = T.fit(T.transcripts(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")))
    monkeypatch.setattr(T, "TURNS", 4)
    monkeypatch.setattr(T, "FAN", 3)
    rows = [(None, i % 3, ("user", "assistant")[i % 2], f"text {i}?"[:7 + i % 3]) for i in range(120)] + [("a", i, "user", f"t{i}") for i in range(5)]
    table = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    cuts = T.parts(table).collect()
    assert sorted(t.text for r in cuts for t in r.turns) == sorted({r[1:] + r[:1]: r[3] for r in rows}.values())
    assert max(len(r.turns) for r in cuts) == 4 and sum(r.first for r in cuts) == 2
    written = T.transcripts(table).cache()
    states, parsed = {}, T.parse(written, model).collect()
    for r in sorted(parsed, key=lambda r: (r.part, r.cut, r.piece)):
        states.setdefault(r.conv_id, []).extend(r.states)
    for name in (None, "a"):
        codes = [c for r in sorted(written.collect(), key=lambda r: (r.part, r.cut)) if r.conv_id == name for c in T.observe(r.lines)[0]]
        path = (T.STATES, *states[name])
        assert len(path) == len(codes) + 1
        assert np.isclose(sum(model.step[a, b] + model.see[b, c] for a, b, c in zip(path, path[1:], codes)), model.matrix(codes)[T.STATES].max())
