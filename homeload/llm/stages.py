"""Corpus stages: documents in, documents out, each by one operator of this subpackage.

All stages keep rows and columns they have no reason to change; columns beyond
those of ``documents`` come along untouched.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload.llm import decontaminate, packing, quality, simhash, substrings
from homeload.llm.common import text_key
from homeload.queries.tables import table

TOKENIZER, SEQUENCE = "word_bpe_49k.json", 2048
#: Working columns; no table has columns of these names.
_ID, _TELL = "__homeload_near_id", "__homeload_near_tell"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rule cascade keeps.

    Null texts have no words and go; repeated rows are judged alike. An empty
    table gives an empty one.
    """
    judged = quality.judge(docs.withColumnsRenamed({c: f"__{c}" for c in ("q", "base_failed", "kept") if c in docs.columns}))
    kept = judged.where("kept").drop("q", "base_failed", "kept")
    return kept.withColumnsRenamed({f"__{c}": c for c in ("q", "base_failed", "kept")})


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component: three-word shingles, at most two differing bits.

    Where several texts of a component share that id one of them stays, and of
    rows equal in id and text one. Null ids count only where a component has no
    other; null and wordless texts are one component. An empty table gives an
    empty one.
    """
    found = simhash.near_duplicates(docs).groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tell")).alias("first"))
    # an id and text has one root, so no two components name the same row
    keep = found.select(F.col("first.doc_id").alias(_ID), F.col("first.tell").alias(_TELL))
    tell = text_key(F.coalesce(docs["text"], F.lit("")))
    kept = docs.join(keep, docs["doc_id"].cast("long").eqNullSafe(keep[_ID]) & (tell == keep[_TELL]), "left_semi")
    return kept.withColumn(_TELL, text_key(F.coalesce("text", F.lit("")))).dropDuplicates(["doc_id", _TELL]).drop(_TELL)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less repeated passages; a document of which nothing is left goes."""
    figures = {c: f"__{c}" for c in ("n_bytes", "n_removed", "n_spans") if c in docs.columns}
    cleaned = substrings.remove_repeats(docs.withColumnsRenamed(figures))
    left = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(quality.WORD))
    shorter = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", shorter).drop("n_bytes", "n_removed", "n_spans").withColumnsRenamed({v: k for k, v in figures.items()}).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item.

    Null texts and null items hold no words and match nothing; rows equal in id
    and text go together. Empty tables on either side lose nothing.
    """
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents placed in sequences of at most 2048 tokens.

    A null or empty text is one piece, its end token; repeated rows are packed
    each. An empty table gives an empty one.
    """
    return packing.pack(packing.pieces(docs, public_tokenizers.path(TOKENIZER), end_id=0, size=SEQUENCE), SEQUENCE)
