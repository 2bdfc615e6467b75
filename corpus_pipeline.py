"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next one's ``docs``; all but the last return the
columns of ``documents``.

1. toxicity            documents that score as toxic go
2. near_duplicates     one document of each linked group stays (5-word
                       shingles, similarity 0.8 or more)
3. repeated_bytes      bytes covered by a 400-byte string, or by a passage of
                       over 50 words, that also starts elsewhere go; a
                       character that loses some of its bytes goes whole
4. secrets             the found secrets are blanked out in the text
5. packing             documents are packed into sequences

Extra columns pass unchanged, whatever their names: a stage keeps the row as one
struct beside its helper columns.  A null text stays null unless bytes of it go.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.llm import jaccard, packing, secrets, suffixes, toxicity
from streamkit.llm.common import ROW, fingerprint, left_join_held, map_texts, nested, read_table, release_heap, stage_table, staged_result, unnested


#: Words of the shortest passage that may not repeat.
PASSAGE = 51


def _fresh(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, begun with executors that gave back what the one before left."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_heap(spark)
        return stage(spark, docs, sf_dir)

    return run


def _like(docs: DataFrame, out: DataFrame) -> DataFrame:
    """The columns of ``docs`` from (ROW, text), with ``n_chars`` of the present text."""
    out = unnested(out, docs.columns, "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


@_fresh
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, read_table(spark, sf_dir, "labels"))


@staged_result("goes")
def _linked_rows(docs: DataFrame) -> DataFrame:
    linked = stage_table(jaccard.links(docs, k=5, percent=80).select("fa", "fb", "first"), "linked")
    # a row stored twice is in one group with itself: of such rows one may stay
    return linked.groupBy("fa", "fb").agg(F.max("first").alias("one"), F.min("first").alias("all")).where("not all").select("fa", "fb", "one")


@_fresh
def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = nested(docs, *fingerprint("doc_id", F.coalesce("text", F.lit(""))))
    both = left_join_held(keyed, _linked_rows(docs), ["fa", "fb"], "fa")
    twice = both.where("one").dropDuplicates(["fa", "fb"])
    return unnested(both.where("one is null").unionByName(twice), docs.columns)


@_fresh
def repeated_bytes_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    keyed = nested(docs, *fingerprint("doc_id", text), apart="text")
    both = left_join_held(keyed, suffixes.repeated_passages(docs, PASSAGE), ["fa", "fb"], "fa").select(ROW, "text", "spans")

    def make():
        def cut(rows: dict) -> dict:
            out = []
            for text, spans in zip(rows["text"], rows["spans"]):
                if spans:
                    data = text.encode()
                    gone = suffixes.merged(spans)
                    ends = [0, *(b for _, b in gone)]
                    kept = [data[a:b] for a, b in zip(ends, [*(a for a, _ in gone), len(data)])]
                    text = "".join(x.decode("utf-8", "ignore") for x in kept)
                out.append(text)
            return {ROW: rows[ROW], "text": out}

        return cut

    return _like(docs, map_texts(both, make, both.select(ROW, "text").schema))


@_fresh
def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    addressed = secrets.content_address(docs)
    found = secrets.findings(addressed, secrets.scan_new(addressed)).where(F.size("found") > 0).groupBy("blob").agg(F.first("found").alias("found"))
    found = stage_table(found.withColumn("h", F.xxhash64("blob")), "secrets")
    blob = F.sha2(F.coalesce("text", F.lit("")), 256)
    keyed = nested(docs, blob.alias("blob"), F.xxhash64(blob).alias("h"), apart="text")
    both = left_join_held(keyed, found, ["blob", "h"], "h").select(ROW, "text", "found")

    def make():
        def blank(rows: dict) -> dict:
            out = []
            for text, found in zip(rows["text"], rows["found"]):
                if found:
                    spans, at, parts = suffixes.merged([{"begin": x["start"], "end": x["end"]} for x in found]), 0, []
                    for a, b in spans:
                        parts += [text[at:a], "[secret]"]
                        at = b
                    text = "".join(parts) + text[at:]
                out.append(text)
            return {ROW: rows[ROW], "text": out}

        return blank

    return _like(docs, map_texts(both, make, both.select(ROW, "text").schema))


@_fresh
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("repeated_bytes", repeated_bytes_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: No SQL: similarity components, suffix arrays and tokenizers are outside it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
