"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

``run`` needs a shared folder (``spark.checkpoint.dir``) for what the stages write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import stages
from strata.llm.common import materialize, table

STAGES = [
    ("toxicity", stages.toxicity),
    ("line_dedup", stages.line_dedup),
    ("near_dedup", stages.near_dedup),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

#: SQL cannot express the learned and pseudorandom stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
