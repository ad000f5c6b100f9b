"""What several operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload.session import shared_folder


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: worked out once, safe from lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, null text as empty; other columns never meet an operator's own names."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def text_key(text: Column | str = "text") -> Column:
    """With ``doc_id`` it tells rows apart that repeat an id; rows equal in both are the same row to every operator."""
    return F.xxhash64(text)


def attach(rows: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on null-safe ``keys``; ``extra`` has one row per key."""
    on = [rows[k].eqNullSafe(extra[k]) for k in keys]
    return rows.join(extra, on, "left").drop(*[extra[k] for k in keys])


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Rows that follow each other with equal ``keys``, as one table each; of sorted rows one run is held at a time."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        edges = {0, batch.num_rows}
        for key in keys:
            column = batch.column(key)
            same = pc.equal(pc.fill_null(column.slice(1), 0), pc.fill_null(column.slice(0, len(column) - 1), 0))
            same = pc.and_(same, pc.equal(column.slice(1).is_null(), column.slice(0, len(column) - 1).is_null()))
            edges.update((np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1).tolist())
        edges = sorted(edges)
        for a, b in zip(edges, edges[1:]):
            own = tuple(batch.column(k)[a].as_py() for k in keys)
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = own
    if held:
        yield pa.Table.from_batches(held)
