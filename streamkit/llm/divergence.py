"""Audit of how far the term distributions of a language's sources diverge.

Groups are (lang, source); each language keeps the terms of enough of its
documents.  A group gives every kept term ``p``, an integer in parts of
``SCALE`` with two added counts a term; the divergence of two groups is the sum
over all kept terms of ``floor((p-q)^2 / (p+q))``.

1. **Counts.**  A pass over the texts counts terms and documents per group and
   term; each task keeps a bounded number of entries, so a source that holds a
   third of all rows is summed before it moves.
2. **Cube.**  For the pairs, groups are dealt over group blocks and kept terms
   over term blocks, per language.  A task owns cells (group block, group block,
   term block): it gets the slices (group block, term block) of both blocks,
   replicated along the third axis, and adds up the partial divergences of all
   its pairs.  Slices hold only terms that occur in a group; where neither
   group has a term the two share one constant ``f0``, so a cell sums
   ``f - f0`` over the terms that either has.
3. **Reduce.**  Partial sums are added along the term axis, and ``V * f0``.

A cell's slices are bounded by ``GROUPS`` and ``TERMS`` whatever the number of
documents, sources and terms.  The pairs themselves are the result and grow with the
square of a language's sources.  All arithmetic is on integers: products that may
pass 64 bits are decimals or are divided first.

Defined results.  Null text, lang and source are ''.  A group whose documents have no
kept term has p = 1 + floor(SCALE * 2 / (2 * V)) for all.  A language without
kept terms (V = 0) has pairs of value 0 and no term rows; one with a single
source has no pairs.  Ties rank by the item's UTF-8 bytes.  Rows stored several
times count each time.  An empty table gives an empty result; further columns
play no part, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamkit.llm.common import read_table, stage_table

#: Documents of its language that a kept term occurs in, and the parts that probabilities count in.
DOCUMENTS, SCALE = 10, 1_000_000_000
#: Ranks of the ``term`` part.
TOP = 10
#: Groups in a group block and terms in a term block, on average.
GROUPS, TERMS = 32, 8192
#: (group, term) entries that a counting task holds at most, and bytes of text that it cuts at once.
HELD, AT_ONCE = 400_000, 8 << 20

#: Bytes of terms, A-Z as a-z; all others, below 0x80, become blanks.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs) of every group and term of it; a group also has one row
    with a null term, so that groups without terms stay known."""
    named = {"lang": lang_col, "source": source_col, "text": text_col}
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in named.items()])
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, seen) in counts.items():
                terms = [None, *(t.decode() for t in n)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.string()),
                                                  pa.array([0, *n.values()], pa.int64()), pa.array([0, *(seen[t] for t in n)], pa.int64())], schema=schema)
            counts.clear()

        for batch in batches:
            # the least batches a cut by bytes gives: very long texts are not all cut at once
            step = max(1, int(batch.num_rows * AT_ONCE // max(batch.nbytes, 1)))
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                texts: dict[tuple[str, str], list[list[bytes]]] = {}
                for lang, source, text in zip(*(c.to_pylist() for c in part.columns)):
                    texts.setdefault((lang, source), []).append(text.encode().translate(_BYTES).split())
                for group, cut in texts.items():
                    n, seen = counts.setdefault(group, (Counter(), Counter()))
                    n.update(chain.from_iterable(cut))
                    seen.update(chain.from_iterable(map(set, cut)))
                if sum(len(n) + 1 for n, _ in counts.values()) > HELD:
                    yield from emit()
        yield from emit()

    found = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """p of a term: ``1 + floor(SCALE * (n + 2) / (total + 2 * kept))``, exactly."""
    top = F.lit(SCALE).cast("decimal(19,0)") * (n + 2).cast("decimal(19,0)")
    return F.call_function("div", top, (total + 2 * kept).cast("decimal(19,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p-q)^2 / (p+q)): at most (SCALE + 1)^2, within 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(docs: DataFrame, documents: int = DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """``groups`` (lang, source, kept, p0: the share of a kept term that the
    group lacks) and ``terms`` (lang, source, term, p, q: of the group and of
    its language), of the kept terms that the group has."""
    counts = stage_table(term_counts(docs), "counts")
    of_lang = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= documents)
    of_lang = stage_table(of_lang.select("lang", "term", "lang_n"), "kept")
    langs = of_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    kept = counts.join(of_lang, ["lang", "term"])
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.where("term is null").select("lang", "source").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("kept", "lang_total", "total")]))
    groups = groups.withColumn("p0", F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))).otherwise(0))
    groups = stage_table(groups, "groups")
    terms = (kept.join(groups, ["lang", "source"])
             .select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")))
    return groups.select("lang", "source", "kept", "p0"), stage_table(terms, "terms")


def cell_sums(cell: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of a cell: of each pair of groups, one from either side,
    ``f - f0`` over the terms that either has.  Rows of a null term name a
    group and its ``p0``."""
    heads, rows = cell[cell["term"].isna()], cell[cell["term"].notna()]
    code, _ = pd.factorize(rows["term"])
    width = int(code.max()) + 1 if len(code) else 0
    sides = []
    for side in (0, 1):
        mine, held = heads[heads["side"] == side].sort_values("source"), rows["side"].to_numpy() == side
        at = {s: i for i, s in enumerate(mine["source"])}
        p0 = mine["p"].to_numpy(np.int64)
        p = np.repeat(p0[:, None], width, axis=1)
        group = rows["source"][held].map(at).to_numpy(np.int64)
        p[group, code[held]] = rows["p"][held].to_numpy(np.int64)
        sides.append((mine["source"].to_numpy(), p0, p))
    # a diagonal cell has one slice, which is both sides
    diagonal = bool(cell["a"].iloc[0] == cell["b"].iloc[0])
    left, right = sides[0], sides[0] if diagonal else sides[1]
    names, others, sums = [], [], []
    for i, (name, p0, p) in enumerate(zip(*left)):
        q_names, q0, q = (x[i + 1:] for x in right) if diagonal else right
        if len(q_names):
            f, f0 = (p - q) ** 2 // (p + q), (p0 - q0) ** 2 // np.maximum(p0 + q0, 1)
            names += [name] * len(q_names)
            others += list(q_names)
            sums.append(f.sum(axis=1) - width * f0)
    text = {"lang": [cell["lang"].iloc[0]] * len(names), "source": names, "item": others}
    return pd.DataFrame({k: np.array(v, object) for k, v in text.items()} | {"part": np.concatenate(sums) if sums else np.zeros(0, np.int64)}, dtype=object).astype({"part": np.int64})


def pair_divergences(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language."""
    cuts = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("v")).where("n > 1").select(
        "lang", F.ceil(F.col("n") / GROUPS).cast("int").alias("group_blocks"), F.greatest(F.ceil(F.col("v") / TERMS), F.lit(1)).cast("int").alias("term_blocks"))
    block = F.pmod(F.xxhash64("lang", "source"), F.col("group_blocks")).cast("int").alias("mine")
    all_of = [F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("t")]
    heads = groups.join(cuts, "lang").select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), block, "group_blocks", *all_of)
    slices = terms.join(cuts, "lang").select("lang", "source", "term", "p", block, "group_blocks", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("t"))
    other = F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)).alias("other")
    cells = heads.unionByName(slices).select("*", other).select(
        "lang", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "t", (F.col("mine") > F.col("other")).cast("int").alias("side"), "source", "term", "p")
    parts = cells.groupBy("lang", "a", "b", "t").applyInPandas(cell_sums, "lang string, source string, item string, part long")
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("part").alias("part"))
    sides = [groups.select("lang", F.col("source").alias(n), F.col("p0").alias(f"{n}_p0"), "kept").drop(*drop) for n, drop in (("source", []), ("item", ["kept"]))]
    both = sums.join(sides[0], ["lang", "source"]).join(sides[1], ["lang", "item"])
    f0 = F.when(F.col("kept") > 0, gap(F.col("source_p0"), F.col("item_p0")) * F.col("kept")).otherwise(0)
    one = both.select("lang", "source", "item", (F.col("part") + f0).alias("value"))
    return one.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x"), "value").select("lang", "x.source", "x.item", "value")


def audit(docs: DataFrame, documents: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair``, how far each source is
    from each other one, and ``term``, what most sets it apart from its language."""
    groups, terms = shares(docs, documents)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_divergences(groups, terms).withColumn("rank", F.row_number().over(order))
    apart = terms.where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    apart = apart.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        apart.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), tf AS (
        SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL
    ), kept AS (
        SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM tf GROUP BY lang, term HAVING count(*) >= 10
    ), langs AS (
        SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
    ), groups AS (SELECT DISTINCT lang, source FROM d), cell AS (
        SELECT g.lang, g.source, k.term, CAST(coalesce(sum(tf.n), 0) AS HUGEINT) AS n
        FROM groups g JOIN kept k USING (lang) LEFT JOIN tf ON tf.lang = g.lang AND tf.source = g.source AND tf.term = k.term GROUP BY ALL
    ), totals AS (SELECT lang, source, sum(n) AS total FROM cell GROUP BY ALL), p AS (
        SELECT c.lang, c.source, c.term, c.n, 1 + (1000000000 * (c.n + 2)) // (t.total + 2 * l.v) AS p, 1 + (1000000000 * (k.n + 2)) // (l.total + 2 * l.v) AS q
        FROM cell c JOIN totals t USING (lang, source) JOIN langs l USING (lang) JOIN kept k USING (lang, term)
    ), pair AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
                   FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
          ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    ), term AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
    both_parts AS (
        SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
        UNION ALL
        SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM both_parts WHERE part = 'pair' OR rank <= 10
"""
