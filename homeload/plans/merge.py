"""Merging the outputs of several runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from homeload.operators import merge
from homeload.sources import documents


def merge_runs(spark: SparkSession, folders: Sequence[str], file: str, schema: str) -> DataFrame:
    """All records of one stage file over run folders; missing and broken files are left out."""
    paths = documents.existing(spark, [f"{f.rstrip('/')}/{file}" for f in folders])
    return documents.read_documents(spark, paths, schema)


def merge_rule_bases(spark: SparkSession, folders: Sequence[str], file: str = "knowledge_base.txt") -> DataFrame:
    """Sorted distinct rule lines over run folders."""
    paths = documents.existing(spark, [f"{f.rstrip('/')}/{file}" for f in folders])
    if not paths:
        return spark.createDataFrame([], "line STRING")
    return merge.merged_rules([spark.read.text(paths).withColumnRenamed("value", "line")])
