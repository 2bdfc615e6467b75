"""The queries of this subpackage, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamkit.llm import covertree, decontaminate, divergence
from streamkit.llm.bpe import op2_byte_bpe
from streamkit.llm.covertree import op12_hard_negatives
from streamkit.llm.decontaminate import op11_decontamination
from streamkit.llm.divergence import op13_divergence_audit
from streamkit.llm.impacts import op7_impact_search
from streamkit.llm.jaccard import op8_jaccard_join
from streamkit.llm.packing import op4_best_fit_packing
from streamkit.llm.partitions import op3_learned_partitions
from streamkit.llm.secrets import op1_secret_scan
from streamkit.llm.suffixes import op5_suffix_dedup
from streamkit.llm.toxicity import op6_toxicity
from streamkit.llm.transcripts import op9_transcript_roles
from streamkit.llm.transducer import op10_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scan, op2_byte_bpe, op3_learned_partitions, op4_best_fit_packing, op5_suffix_dedup,
                            op6_toxicity, op7_impact_search, op8_jaccard_join, op9_transcript_roles, op10_token_counts, op11_decontamination,
                            op12_hard_negatives, op13_divergence_audit)
}

#: DuckDB SQL where it can express the operator.
ORACLE: dict[str, str] = {
    "op11_decontamination": decontaminate.ORACLE_SQL,
    "op12_hard_negatives": covertree.ORACLE_SQL,
    "op13_divergence_audit": divergence.ORACLE_SQL,
    "op7_impact_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
}
