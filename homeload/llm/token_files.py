"""Token-ID output: Parquet with one row and one list of ids per document.

Ids are dictionary-encoded (a vocabulary fits one dictionary page), ids of
documents and lengths delta-encoded; row groups and pages are small enough that
a reader of few documents, or of metadata alone, skips the rest by page index.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homeload.llm import tokens
from homeload.llm.common import keyed_text, text_key

LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#part": "false",
    "parquet.enable.dictionary#row": "false",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
SCHEMA = "part int, row long, doc_id long, n_tokens int, ids array<int>"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write it to ``folder`` in ascending ``doc_id`` order.

    ``part`` numbers the range a row lies in and ``row`` its place there. Null
    ids come first; rows that repeat an id are ordered by a hash of their text.
    Null and empty texts hold the end id alone. Other columns are not read.
    """

    def encode(batches):
        coder, part, row = tokens.encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for cut in tokens.slices(batch, "text"):
                ids, n = tokens.with_end(*coder.encode(cut.column("text")), end_id)
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), part), pa.int32()), pa.array(np.arange(row, row + len(n))), cut.column("doc_id"),
                        pa.array(n, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                    ],
                    ["part", "row", "doc_id", "n_tokens", "ids"],
                )
                row += len(n)

    order = [F.col("doc_id").asc_nulls_first(), text_key()]
    ranged = keyed_text(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.mapInArrow(encode, SCHEMA).write.options(**LAYOUT).parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``SCHEMA``; select columns and filter on ``doc_id`` to read only those pages."""
    return spark.read.schema(SCHEMA).parquet(folder)


def read_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``part, row, doc_id, n_tokens, start`` from the metadata columns; ``start`` counts all ids before the row.

    Running sums stay inside a range of documents; one total per range is
    carried across.
    """
    meta = read_tokens(spark, folder).select("part", "row", "doc_id", "n_tokens")
    return _starts(meta, meta)


def _starts(rows: DataFrame, meta: DataFrame) -> DataFrame:
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per written range
    totals = meta.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return inner.join(bases, "part").withColumn("start", F.col("base") + F.col("inner")).drop("base", "inner")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""

    def crc(batches):
        for b in batches:
            lists = b.column("ids")
            at = np.asarray(lists.offsets.to_numpy())
            data = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).view(np.uint8).data
            sums = np.fromiter((zlib.crc32(data[4 * a : 4 * e]) for a, e in zip(at[:-1], at[1:])), np.int64, len(lists))
            yield pa.RecordBatch.from_arrays(
                [b.column("part"), b.column("row"), b.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(sums)],
                ["part", "row", "doc_id", "n_tokens", "ids_crc32"],
            )

    files = read_tokens(spark, folder).select("part", "row", "doc_id", "ids")
    sums = files.mapInArrow(crc, "part int, row long, doc_id long, n_tokens long, ids_crc32 long")
    meta = read_tokens(spark, folder).select("part", "n_tokens")
    return _starts(sums, meta).select("doc_id", "start", "n_tokens", "ids_crc32")
