import gc
import re
import time
from pathlib import Path

import numpy as np
import pytest
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from streamkit.llm import packing, suffixes, toxicity
from streamkit.llm import common
from streamkit.llm.common import SHUFFLE_CLEANUP, map_texts, shared_dir, stage_table
from tests.llm.test_jaccard import brute as linked
from tests.llm.test_secrets import brute as secrets_of
from tests.llm.test_suffixes import S

SF = "/root/testdata/sf0.01"


def without_repeats(texts):
    """Bytes of strings of 400 bytes, or of 51 whole words, that also start anywhere else go."""
    strings, seen = [], {}
    for t in texts:
        data, words = t.encode(), [m.span() for m in re.finditer(r"\S+", t)]
        at = [0, *np.cumsum([len(c.encode()) for c in t]).tolist()]  # bytes before each character
        passages = [(at[a], at[b]) for (a, _), (_, b) in zip(words, words[C.PASSAGE - 1:])]
        strings.append((data, [(i, i + S.LENGTH) for i in range(len(data) - S.LENGTH + 1)], passages))
        for kind in (1, 2):
            for a, b in strings[-1][kind]:
                seen[kind, data[a:b]] = seen.get((kind, data[a:b]), 0) + 1
    out = []
    for data, *both in strings:
        gone = np.zeros(len(data), bool)
        for kind in (1, 2):
            for a, b in both[kind - 1]:
                if seen[kind, data[a:b]] > 1:
                    gone[a:b] = True
        ends = [0, *(x for _, x in ((a, z + 1) for a, z in S.runs(gone)))]
        parts = [data[a:z] for a, z in zip(ends, [*(a for a, _ in S.runs(gone)), len(data)])]
        out.append("".join(p.decode("utf-8", "ignore") for p in parts))
    return out


def test_stages_equal_brute_force(spark):
    """Each stage on what its predecessor kept."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {}
    for name, stage in C.STAGES:
        before, columns = {r.doc_id: r.text or "" for r in table.collect()}, table.columns
        table = stage_table(stage(spark, table, SF), name)
        if name != "packing":
            assert table.columns == columns and all(r.n_chars == len(r.text or "") for r in table.collect())
        docs[name] = (before, {r.doc_id: r.text or "" for r in table.collect()} if name != "packing" else table.collect())

    before, after = docs["toxicity"]
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert after == {i: t for i, t in before.items() if model.score(t)[0] < toxicity.THRESHOLD} and 0 < len(after) < len(before)
    before, after = docs["near_duplicates"]
    ids = sorted(before)
    roots = [r for _, r in linked([before[i] for i in ids], 5, 80)]
    assert after == {ids[r]: before[ids[r]] for r in set(roots)} and len(after) < len(before)
    before, after = docs["repeated_bytes"]
    assert after == dict(zip(before, without_repeats(before.values()))) and after != before
    before, after = docs["secrets"]
    found = [i for i, t in before.items() if secrets_of(t)[-1]]
    assert found and all((after[i] == t) == (i not in found) for i, t in before.items())
    assert not any(secrets_of(t)[-1] for t in after.values())
    before, rows = docs["packing"]
    word = Tokenizer.from_file(P.path(packing.TOKENIZER))
    assert sum(r.length for r in rows) == sum(len(word.encode(t, add_special_tokens=False).ids) + 1 for t in before.values())
    assert C.run(spark, SF).count() == len(rows)


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_odd_rows(spark, odd_docs, no_docs, as_table, name, stage):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1)], "doc_id long, toxic int")
    path = as_table(labels, "labels")
    assert stage(spark, no_docs, path).count() == 0
    out = stage(spark, odd_docs, path)
    rows = out.collect()
    if name == "packing":
        assert len(rows) >= odd_docs.count()
        return
    assert out.columns == odd_docs.columns
    assert len(rows) == (odd_docs.count() - 2 if name == "near_duplicates" else odd_docs.count())


@pytest.mark.parametrize("name,stage", C.STAGES[:-1])
def test_columns_named_like_helpers_keep_their_values(spark, as_table, name, stage):
    words = " ".join(f"word{i}" for i in range(60))
    texts = [words, words, "password = hunter2hunter2", None, "a quiet text"]
    names = ["fa", "fb", "h", "blob", "found", "spans", "one", "all", "maybe", "row", "_at", "_chunk", "first", "a b"]
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    labels = spark.createDataFrame([(1, 0), (4, 0)], "doc_id long, toxic int")
    out = stage(spark, docs, as_table(labels, "labels"))
    assert out.columns == docs.columns
    got = {r.doc_id: tuple(r)[2:] for r in out.collect()}
    assert got == {i: r[2:] for i, r in enumerate(rows) if i in got} and len(got) == (4 if name == "near_duplicates" else 5)


def test_repeated_passages_of_over_50_words_go(spark):
    """Also those of far fewer than 400 bytes; 50 words stay, and so does a string that repeats in parts only."""
    rng = np.random.default_rng(4)
    words = lambda n, size=6: " ".join("".join(rng.choice(list("abcdefghé"), rng.integers(1, size))) for _ in range(n))
    least, usual, short = " ".join(rng.choice(list("abcdefgh"), 51)), words(51), words(50)
    own = [words(80) for _ in range(12)]
    assert len(least) == 101 and len(usual.encode()) < S.LENGTH
    rows = {i: f"{own[2 * i]} {p} {own[2 * i + 1]}" for i, p in enumerate((least, least, usual, usual, short, short))}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in C.repeated_bytes_stage(spark, docs, SF).collect()}
    for i, passage in enumerate((least, least, usual, usual)):
        assert passage not in got[i] and got[i].startswith(own[2 * i]) and got[i].endswith(own[2 * i + 1])
    assert got[4] == rows[4] and got[5] == rows[5]


def test_word_places():
    for text in ("", " ", "a", "über alles, 字 ok", " lead  und\ttrail\n", "wide\u3000blanks\xa0here x", "\x85", "one\x1ftwo", "ab ab b ab"):
        hashes, begin, end = S.word_places(text)
        words = [text.encode()[a:b].decode() for a, b in zip(begin, end)]
        assert words == text.split()
        assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


@pytest.mark.parametrize("seed", range(3))
def test_repeated_words_equal_brute_force(spark, seed):
    """Few words, so that many passages share their owners' hashes; rows stored twice."""
    rng = np.random.default_rng(seed)
    phrases = [" ".join(rng.choice(list("abcde"), 70)) for _ in range(6)]
    own = lambda n: " ".join("".join(rng.choice(list("fghé"), 6)) for _ in range(n))
    rows = []
    for i in range(40):
        text = own(int(rng.integers(0, 60)))
        for _ in range(int(rng.integers(0, 4))):
            p, a = phrases[rng.integers(0, 6)].split(), int(rng.integers(0, 25))
            text += "\n\u2003"[int(rng.integers(0, 2))] + " ".join(p[a:a + int(rng.integers(30, 70))]) + " " + own(int(rng.integers(1, 30)))
        rows.append((i, text))
    rows += [rows[3], rows[3], (50, None), (51, "")]
    got = sorted((r.doc_id, r.text or "") for r in C.repeated_bytes_stage(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), SF).collect())
    want = sorted(zip((i for i, _ in rows), without_repeats([t or "" for _, t in rows])))
    assert got == want and got != sorted((i, t or "") for i, t in rows)


def test_stage_tables_leave_no_shuffle_files(spark):
    numbers = spark.range(20_000).select((F.col("id") % 5_000).alias("k"), F.rand(1).alias("x"))
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {f for d in local for f in Path(str(d)).rglob("shuffle_*")}
    before = files()
    held = stage_table(numbers.groupBy("k").agg(F.sum("x").alias("s")).join(numbers.withColumnRenamed("x", "y"), "k"), "joined")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and held.count() == 20_000
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_tables_on_the_way_to_a_result_go(spark):
    texts = [f"{'x' * 500} w{i % 3} " + " ".join(f"v{(i * j) % 40}" for j in range(60)) for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    top = Path(shared_dir(spark).removeprefix("file:")) / "streamkit-llm" / spark.sparkContext.applicationId
    before = set(top.glob("*"))
    found = suffixes.repeated_passages(docs, C.PASSAGE)
    assert [p.name.split("-")[0] for p in set(top.glob("*")) - before] == ["spans"] and found.count() == 6
    before = set(top.glob("*"))
    C.near_duplicates_stage(spark, docs, SF)
    assert [p.name.split("-")[0] for p in set(top.glob("*")) - before] == ["goes"]


def test_workers_get_texts_in_bounded_batches(spark):
    texts = spark.range(0, 9_000, 1, 1).select("id", F.repeat(F.lit("x"), 2_000).alias("text"))

    def make():
        return lambda rows: {"n": [sum(map(len, rows["text"]))]}

    sizes = [r.n for r in map_texts(texts, make, "n long").collect()]
    assert sum(sizes) == 18_000_000 and max(sizes) <= 5 << 20
    assert int(spark.conf.get(common.BATCH_BYTES).rstrip("b")) <= common.BATCH


def test_a_bound_of_the_session_stays(spark):
    own = spark.newSession()
    own.conf.set(common.BATCH_BYTES, "1000000")
    common.bound_batches(own)
    assert own.conf.get(common.BATCH_BYTES).rstrip("b") == "1000000"


def test_a_worker_drops_models_that_its_task_does_not_load():
    loads = []
    model = common.task_model(lambda name: loads.append(name) or name)
    for _ in range(2):
        common._made(lambda: model("a"))
    assert loads == ["a"]
    common._made(lambda: None)
    common._made(lambda: model("a"))
    assert loads == ["a", "a"]


def test_unused_heap_is_given_back(spark):
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    held = spark._jvm.java.nio.ByteBuffer.allocate(runtime.maxMemory() // 4)
    grown = runtime.totalMemory()
    del held
    gc.collect()
    common.release_heap(spark)
    assert runtime.totalMemory() < grown


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_a_stage_begins_with_the_heap_given_back(spark, no_docs, monkeypatch, name, stage):
    def released(session):
        raise InterruptedError(session)

    monkeypatch.setattr(C, "release_heap", released)
    with pytest.raises(InterruptedError):
        stage(spark, no_docs, SF)
