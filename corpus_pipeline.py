"""A corpus pipeline: each stage is one operator over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymatch.llm import exact_dedup, minhash, packing, quality_rules, toxicity
from tallymatch.llm.common import fresh_folder, stored, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("quality_rules", quality_rules.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_dedup", minhash.stage),
    ("packing", packing.stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    folder, docs = fresh_folder(spark), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{k}_{name}")
    return docs


#: The stages score, hash and pack with models and tokenizers that SQL does not have.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
