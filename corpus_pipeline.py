"""From documents to packed training sequences: five stages, each one operator of ``homeload.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from homeload.llm import stages
from homeload.llm.common import written
from homeload.queries.tables import table

STAGES = [
    ("quality rules", stages.quality_rules),
    ("SimHash near-dedup", stages.near_dedup),
    ("substring dedup", stages.substring_dedup),
    ("benchmark decontamination", stages.benchmark_decontamination),
    ("best-fit packing", stages.pack),
]

#: SimHash components, chunk digests and token ids are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
