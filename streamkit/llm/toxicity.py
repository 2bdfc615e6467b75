"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

``fit`` takes a bounded sample of labelled documents (``TOXIC`` and ``CLEAN``
at most, by the order of a hash of their ids), chooses the ``TERMS`` words and
word beginnings that speak most for the toxic class, and counts their document
frequencies over all documents.  The examples' vectors form an inverted index
whose postings are cut into blocks of examples, with the largest weight of
each term in each block.

``score`` is a plain map over the documents.  The block maxima bound the
cosine of every example in a block; blocks are scored exactly in descending
order of that bound until no other can hold one of the ``NEIGHBOURS`` nearest.
Their votes, weighted by nearness and by how many labelled documents an
example stands for, are calibrated on the examples themselves, each left out
in turn, and returned with the evidence.

The label of a document, its language, its source and its id are no inputs of
a score.  The model is bounded by these parameters, so it may travel with the
tasks.  Defined results: a null or empty text, and one without any term, gets
the rate of such examples; without labelled examples of both classes nothing
is learnt and every score is 0; null labels count as no label, and a document that is labelled several times has its largest label;
a row stored twice returns twice; further columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.llm.common import id_type, map_texts, may_hold, read_table, stage_table, text_rows

#: Bounds of the fitted sample, and the terms chosen from it.
TOXIC, CLEAN, TERMS = 2000, 4000, 400
#: Word beginnings that are terms too; the least examples that hold a term.
BEGINNINGS, LEAST = (4, 5, 6), 5
#: How often a term stands in a text, as terms of their own.
TIMES = (1, 2, 3, 5)
#: The least log likelihood ratio of a term: weaker ones are as often chance.
STRENGTH = 12.0
NEIGHBOURS, BLOCK, THRESHOLD = 15, 64, 0.7
WORDS = re.compile(r"\w+")
#: Words whose terms are kept per task.
KEPT = 300_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def bases_of(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


def terms_of(text: str) -> set[str]:
    """All terms of a text: words and word beginnings, and each again as
    ``term^k`` where it stands there ``k`` times or more."""
    n: Counter = Counter()
    for w, c in Counter(WORDS.findall(text.lower())).items():
        for t in bases_of(w):
            n[t] += c
    return {f"{t}^{k}" if k > 1 else t for t, c in n.items() for k in TIMES if c >= k}


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The bounded sample (doc_id, toxic, text) outside the held-out part,
    and the number of labelled documents of each class there."""
    marked = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marked.where("toxic = 1").orderBy(*order).limit(TOXIC).unionByName(marked.where("toxic = 0").orderBy(*order).limit(CLEAN))
    chosen = stage_table(chosen.withColumn("h", F.xxhash64("doc_id")), "chosen")
    texts = may_hold(text_rows(docs).withColumn("h", F.xxhash64("doc_id")), "h", chosen)
    one = texts.join(chosen.select("doc_id", "toxic"), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return stage_table(one, "examples"), counts


def choose_terms(examples: DataFrame) -> list[str]:
    """The terms that speak most for the toxic class: those at least three
    times as frequent there, by likelihood ratio."""

    def make():
        def count(rows: dict) -> dict:
            n = (Counter(), Counter())
            for y, text in zip(rows["toxic"], rows["text"]):
                n[y].update(terms_of(text))
            every = list(n[0] | n[1])
            return {"term": every, "clean": [n[0][t] for t in every], "toxic": [n[1][t] for t in every]}

        return count

    sizes = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return []
    counted = map_texts(examples.select("toxic", "text"), make, "term string, clean long, toxic long")
    counted = counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("clean") + F.col("toxic") >= LEAST)
    p, q = (F.col("toxic") + 0.5) / (sizes[1] + 1), (F.col("clean") + 0.5) / (sizes[0] + 1)
    strength = F.col("toxic") * F.log(p / q) - sizes[1] * (p - q)
    best = counted.where((p > 3 * q) & (strength >= STRENGTH)).select("term", strength.alias("s")).orderBy(F.desc("s"), "term").limit(TERMS)
    return sorted(r["term"] for r in best.collect())


@dataclass
class Vectors:
    """Texts as counts of the chosen terms."""

    terms: list[str]
    kept: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __post_init__(self):
        split = [t.rpartition("^") if "^" in t else (t, "", "1") for t in self.terms]
        self.bases = {t: i for i, t in enumerate(dict.fromkeys(b for b, _, _ in split))}
        self.times: list[list[tuple[int, int]]] = [[] for _ in self.bases]
        for i, (b, _, k) in enumerate(split):
            self.times[self.bases[b]].append((int(k), i))

    def counts(self, text: str) -> dict[int, int]:
        """The chosen terms of a text with how often they count: a term as
        often as it stands there, ``term^k`` once."""
        kept, bases, n = self.kept, self.bases, {}
        if len(kept) > KEPT:
            kept.clear()
        for w, c in Counter(WORDS.findall(text.lower())).items():
            ids = kept.get(w)
            if ids is None:
                ids = kept[w] = tuple(bases[t] for t in bases_of(w) if t in bases)
            for i in ids:
                n[i] = n.get(i, 0) + c
        return {t: c if k == 1 else 1 for i, c in n.items() for k, t in self.times[i] if c >= k}


def document_frequencies(docs: DataFrame, terms: list[str]) -> tuple[np.ndarray, int]:
    """Of each term over all documents, and the number of documents."""

    def make():
        vectors = Vectors(terms)

        def count(rows: dict) -> dict:
            n = Counter({-1: len(rows["text"])})
            for text in rows["text"]:
                n.update(vectors.counts(text).keys())
            return {"term": list(n), "n": list(n.values())}

        return count

    total = map_texts(docs.select("text"), make, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(terms))
    for r in total:
        if r["term"] >= 0:
            out[r["term"]] = r["n"]
    return out, next((r["n"] for r in total if r["term"] == -1), 0)


class Index:
    """Block-max inverted index over unit vectors, and the votes."""

    def __init__(self, idf: np.ndarray, ids: list, labels: np.ndarray, counts: list[dict[int, int]], weight: dict[int, float]):
        self.idf, self.default = idf, 0.0
        mass = np.array([weight[int(y)] for y in labels])
        bare = np.array([not c for c in counts], bool)
        if 0 < labels.sum() < len(labels):
            rate = float((mass * labels).sum() / mass.sum())
            self.default = float(((mass * labels)[bare].sum() + rate) / (mass[bare].sum() + 1))
        keep = [i for i in np.flatnonzero(~bare)]
        keep.sort(key=lambda i: (max(counts[i], key=lambda t: (self.weight_of(t, counts[i][t]), t)), len(counts[i]), i))
        self.ids, self.labels, self.mass = [ids[i] for i in keep], labels[keep], mass[keep]
        self.blocks = -(-len(keep) // BLOCK)
        vectors = [self.vector(counts[i]) for i in keep]
        postings: list[list[tuple[int, float]]] = [[] for _ in idf]
        for e, (terms, values) in enumerate(vectors):
            for t, v in zip(terms, values):
                postings[t].append((e, v))
        self.at = np.concatenate(([0], np.cumsum([len(p) for p in postings]))).astype(int)
        self.example = np.array([e for p in postings for e, _ in p], int)
        self.value = np.array([v for p in postings for _, v in p])
        edges = np.arange(self.blocks + 1) * BLOCK
        self.cut = np.array([lo + np.searchsorted(self.example[lo:hi], edges) for lo, hi in zip(self.at, self.at[1:])], int).reshape(len(idf), self.blocks + 1)
        self.most = np.zeros((len(idf), self.blocks))
        for t, p in enumerate(postings):
            for e, v in p:
                self.most[t, e // BLOCK] = max(self.most[t, e // BLOCK], v)
        self.slope, self.shift = 1.0, 0.0
        if 0 < labels.sum() < len(labels) and keep:
            left_out = [self.votes(self.nearest(v, without=e)) for e, v in enumerate(vectors)]
            self.calibrate(np.array(left_out), self.labels, self.mass)

    def weight_of(self, term: int, n: int) -> float:
        return (1 + np.log(n)) * self.idf[term]

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array(sorted(counts), int)
        values = np.array([self.weight_of(t, counts[t]) for t in terms])
        return terms, values / np.sqrt((values ** 2).sum())

    def nearest(self, vector: tuple[np.ndarray, np.ndarray], without: int = -1) -> list[tuple[float, int]]:
        """(cosine, example) of the nearest examples, nearest first, ties to
        the smaller position; blocks by descending bound until none can add."""
        terms, values = vector
        bound = values @ self.most[terms]
        found: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(found) == NEIGHBOURS and bound[b] < -found[-1][0] - 1e-9:
                break
            score = np.zeros(BLOCK)
            for t, v in zip(terms.tolist(), values.tolist()):
                lo, hi = self.cut[t, b], self.cut[t, b + 1]
                score[self.example[lo:hi] - b * BLOCK] += v * self.value[lo:hi]
            found += [(-s, b * BLOCK + i) for i, s in enumerate(score.tolist()) if s > 0 and b * BLOCK + i != without]
            found = sorted(found)[:NEIGHBOURS]
        return [(-s, e) for s, e in found]

    def votes(self, near: list[tuple[float, int]]) -> float:
        weights = [self.mass[e] / (0.02 + max(0.0, 1 - s)) for s, e in near]
        return (sum(w * self.labels[e] for w, (_, e) in zip(weights, near)) + 0.5 * self.default) / (sum(weights) + 0.5)

    def calibrate(self, votes: np.ndarray, labels: np.ndarray, mass: np.ndarray) -> None:
        """Logistic regression of the label on the votes' log odds, with a
        small penalty, by Newton steps."""
        x = np.stack([self.odds(votes), np.ones(len(votes))])
        w = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            gradient = x @ (mass * (p - labels)) + 0.1 * (w - [1.0, 0.0])
            hessian = (x * (mass * p * (1 - p))) @ x.T + 0.1 * np.eye(2)
            step = np.linalg.solve(hessian, gradient)
            w = w - np.clip(step, -1, 1)
        if w[0] > 0:
            self.slope, self.shift = map(float, w)

    @staticmethod
    def odds(p):
        p = np.clip(p, 1e-6, 1 - 1e-6)
        return np.log(p / (1 - p))

    def score(self, counts: dict[int, int]) -> tuple[float, list[dict]]:
        if not counts or not len(self.labels):
            return self.default, []
        near = self.nearest(self.vector(counts))
        if not near:
            return self.default, []
        z = float(self.slope * self.odds(self.votes(near)) + self.shift)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), [{"doc_id": self.ids[e], "toxic": int(self.labels[e]), "cosine": float(s)} for s, e in near]


@dataclass
class Model:
    vectors: Vectors
    index: Index
    id_type: str

    def score(self, text: str) -> tuple[float, list[dict]]:
        return self.index.score(self.vectors.counts(text))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    docs = text_rows(docs)
    examples, counts = labelled(docs, labels)
    terms = choose_terms(examples)
    df, n = document_frequencies(docs, terms)

    def make():
        vectors = Vectors(terms)

        def one(rows: dict) -> dict:
            each = [vectors.counts(t) for t in rows["text"]]
            return {"doc_id": rows["doc_id"], "toxic": rows["toxic"], "term": [list(c) for c in each], "n": [list(c.values()) for c in each]}

        return one

    rows = map_texts(examples, make, f"doc_id {id_type(examples)}, toxic int, term array<int>, n array<int>").collect()  # TOXIC + CLEAN rows at most
    rows.sort(key=lambda r: r["doc_id"])
    labels_of = np.array([r["toxic"] for r in rows], int)
    taken = Counter(labels_of.tolist())
    weight = {y: counts[y] / taken[y] for y in taken}
    index = Index(np.log((n + 1) / (df + 1)) + 1, [r["doc_id"] for r in rows], labels_of, [dict(zip(r["term"], r["n"])) for r in rows], weight)
    return Model(Vectors(terms), index, id_type(examples))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, evidence) of every document: the nearest examples with
    label and cosine."""

    def make():
        def all_scores(rows: dict) -> dict:
            scored = [model.score(t) for t in rows["text"]]
            return {"doc_id": rows["doc_id"], "score": [s for s, _ in scored], "evidence": [e for _, e in scored]}

        return all_scores

    rows = text_rows(docs)
    return map_texts(rows, make, f"doc_id {id_type(rows)}, score double, evidence array<struct<doc_id:{model.id_type},toxic:int,cosine:double>>")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, whose score is below the
    threshold."""
    model = fit(docs, labels)

    def make():
        def keep(rows: dict) -> dict:
            good = [model.score(t or "")[0] < THRESHOLD for t in rows["text"]]
            return {n: [v for v, g in zip(values, good) if g] for n, values in rows.items()}

        return keep

    return map_texts(docs, make, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
