import numpy as np
from pyspark.sql import functions as F

from streamkit.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """On rows whose labels were never seen, and with a score for every row."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = X.op6_toxicity(spark, SF).cache()
    assert out.count() == docs.count() and out.where("score < 0 or score > 1 or score is null").count() == 0
    held = out.where("held_out").join(labels.where("toxic is not null").select("doc_id", "toxic"), "doc_id").collect()
    caught = sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held)
    wrong = sum(r.predicted for r in held if not r.toxic) / sum(not r.toxic for r in held)
    assert caught > 0.85 and wrong < 0.01
    # calibrated: the mean score is near the rate
    assert abs(np.mean([r.score for r in held]) - np.mean([r.toxic for r in held])) < 0.02
    out.unpersist()


def test_nearest_equal_brute_force():
    """The block-max index against all cosines."""
    rng = np.random.default_rng(5)
    counts = [{int(t): int(rng.integers(1, 5)) for t in rng.choice(60, rng.integers(0, 9), replace=False)} for _ in range(700)]
    labels = rng.integers(0, 2, 700)
    index = X.Index(rng.uniform(1, 5, 60), list(range(700)), labels, counts, {0: 1.0, 1: 1.0})
    dense = np.zeros((len(index.ids), 60))
    for row, i in enumerate(index.ids):
        terms, values = index.vector(counts[i])
        dense[row, terms] = values
    for _ in range(60):
        c = {int(t): int(rng.integers(1, 5)) for t in rng.choice(60, rng.integers(1, 9), replace=False)}
        vector = index.vector(c)
        q = np.zeros(60)
        q[vector[0]] = vector[1]
        every = dense @ q
        want = sorted((-round(s, 12), e) for e, s in enumerate(every) if s > 0)[:X.NEIGHBOURS]
        got = index.nearest(vector)
        assert [round(s, 9) for s, _ in got] == [round(-s, 9) for s, _ in want]
        assert [every[e] for _, e in got] == sorted((every[e] for _, e in got), reverse=True) or np.allclose([every[e] for _, e in got], [s for s, _ in got])


def test_labels_and_ids_are_no_inputs(spark):
    """A document's own label and id don't change its score."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = X.fit(docs, labels)
    held = docs.where(X.held_out(F.col("doc_id"))).select("doc_id", "text")
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = X.fit(docs, flipped)
    texts = [r.text for r in held.limit(200).collect()]
    assert [model.score(t)[0] for t in texts] == [again.score(t)[0] for t in texts]


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        for docs in (odd_docs, no_docs):
            scores = X.score(docs, X.fit(docs, some)).collect()
            assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    kept = X.accepted(odd_docs, labels)
    assert kept.columns == odd_docs.columns
