"""From raw documents to token ids: quality rules, near duplicates, benchmark passages, personal data, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnweave.llm import queries
from turnweave.llm.common import discard, materialize, scratch, table

STAGES = [
    ("quality_rules", queries.stage_quality),
    ("jaccard_join", queries.stage_jaccard),
    ("decontamination", queries.stage_decontamination),
    ("pii", queries.stage_pii),
    ("byte_bpe", queries.stage_byte_bpe),
]

#: SQL can't express the Feistel network and the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next reads them, and deleted after that."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as keep:
        for name, stage in STAGES[:-1]:
            with scratch(spark) as hold:
                after = hold(materialize(stage(spark, docs, sf_dir), f"stage-{name}"))
            discard(docs)
            docs = after
        return STAGES[-1][1](spark, keep(docs), sf_dir)
