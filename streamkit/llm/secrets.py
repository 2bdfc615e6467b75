"""Secret scans over an incremental blob ledger.

Every historical version of a path is content-addressed by the SHA-256 of its
text.  A ledger remembers which (blob, rule version) pairs are scanned; a run
scans only the unseen pairs, each blob once however many paths or versions
hold it, and joins the findings back to all of them.

* ``content_address``  versions -> (version_id, blob, text)
* ``scan_new``         the ledger rows of the pairs that the ledger lacks
* ``findings``         the ledger's spans joined back to every version

Shuffles: the (blob, version) pairs, aggregated per task before they move, and
each text once by (blob, version), so copies of one blob spread over all
tasks.  Defined results: a null text is the empty text; an empty text holds no
secret; a version stored twice, or without id, returns once per row; an empty
table gives an empty result; further columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.llm.common import map_texts, read_table, stage_table, text_rows


@dataclass(frozen=True)
class Rule:
    """A secret's pattern.  Matches run leftmost and non-overlapping; one
    whose ``group`` is shorter than ``least`` code points is dropped after it
    has used up its text."""

    kind: str
    pattern: str
    least: int
    group: int = 0

    @property
    def version(self) -> str:
        text = f"{self.kind}\0{self.pattern}\0{self.least}\0{self.group}"
        return f"{self.kind}@{hashlib.sha256(text.encode()).hexdigest()[:16]}"

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)

    def spans(self, text: str, compiled: re.Pattern) -> list[tuple[int, int]]:
        return [m.span() for m in compiled.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


#: The base rules.  The runs of the last two are maximal, so their least
#: length may stand in the pattern: a shorter run holds no longer one.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)

LEDGER = "blob string, rule string, spans array<struct<start:long,end:long>>"


def content_address(versions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per version: its id, the blob that it holds, the text."""
    return text_rows(versions, id_col, text_col).select(F.col("doc_id").alias("version_id"), F.sha2("text", 256).alias("blob"), "text")


def scan_new(addressed: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """The ledger rows (blob, rule version, spans) of all pairs that
    ``ledger`` does not hold yet.  A pair without findings has a row too."""
    blobs = addressed.groupBy("blob").agg(F.min("version_id").alias("holder"))
    wanted = F.array(*[F.lit(r.version) for r in rules])
    if ledger is None:
        blobs = blobs.withColumn("rules", wanted)
    else:
        pairs = blobs.withColumn("rule", F.explode(wanted)).join(ledger.select("blob", "rule"), ["blob", "rule"], "left_anti")
        blobs = pairs.groupBy("blob").agg(F.min("holder").alias("holder"), F.collect_set("rule").alias("rules"))
    holder = blobs.select(F.col("blob").alias("h_blob"), "holder", "rules").hint("shuffle_hash")
    pending = addressed.join(holder, (F.col("blob") == F.col("h_blob")) & F.col("version_id").eqNullSafe(F.col("holder")))

    def make():
        by_version = {r.version: (r, r.compiled()) for r in rules}

        def scan(rows: dict) -> dict:
            out: dict[str, list] = {"blob": [], "rule": [], "spans": []}
            for blob, text, versions in zip(rows["blob"], rows["text"], rows["rules"]):
                for v in versions:
                    rule, compiled = by_version[v]
                    out["blob"].append(blob)
                    out["rule"].append(v)
                    out["spans"].append([{"start": a, "end": b} for a, b in rule.spans(text, compiled)])
            return out

        return scan

    return map_texts(pending.select("blob", "text", "rules"), make, LEDGER)


def findings(addressed: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Every version with its spans, ``array<struct<start, rank, kind, end>>``
    by start, then by the rules' order; empty where nothing was found."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.version), F.lit(i))])
    kind = F.array(*[F.lit(r.kind) for r in rules])
    found = (ledger.where(F.size("spans") > 0).where(F.col("rule").isin([r.version for r in rules]))
             .groupBy("blob").agg(F.collect_set(F.struct("rule", "spans")).alias("by_rule")))
    one = lambda x: F.transform(x["spans"], lambda s: F.struct(s["start"].alias("start"), rank[x["rule"]].alias("rank"), kind[rank[x["rule"]]].alias("kind"), s["end"].alias("end")))
    # a table of its own, so that a blob with very many versions can be split in the join
    found = stage_table(found.select("blob", F.array_sort(F.flatten(F.transform("by_rule", one))).alias("found")), "findings")
    none = F.expr("cast(array() as array<struct<start:bigint,rank:int,kind:string,end:bigint>>)")
    return addressed.select("version_id", "blob").join(found, "blob", "left").select("version_id", "blob", F.coalesce("found", none).alias("found"))


def secret_columns(found: DataFrame) -> DataFrame:
    """The digest columns of ``findings`` under the base rules."""
    written = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(F.col("version_id").alias("doc_id"), count("assign"), count("access"), count("hex"),
                        F.sha2(written, 256).alias("base_sha256"), written.alias("spans"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; the ledger starts empty."""
    addressed = content_address(read_table(spark, sf_dir, "documents"))
    return secret_columns(findings(addressed, scan_new(addressed)))
