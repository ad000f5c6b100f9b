"""Ids that have been taken in, for exactly-once intake after any delay.

The index holds two 64-bit digests of each id, filed by a day that an id always
comes with (the event day of its record). A batch reads the days its own ids
fall in and adds its new ids as files of its own, so nothing is written twice
and old days rest until a late copy asks for them. A batch that is run again
reads what earlier batches wrote and replaces its own files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCHEMA = "one BIGINT, two BIGINT, batch BIGINT, day DATE"


def _marked(rows: DataFrame, id_col: str, day: Column) -> DataFrame:
    name = F.col(id_col).cast("string")
    return rows.withColumns({"__one": F.xxhash64(name), "__two": F.xxhash64(name, F.lit("second")), "__day": day})


def first_time(rows: DataFrame, path: str, number: int, id_col: str, day: Column) -> DataFrame:
    """``rows`` of batch ``number`` whose id no earlier batch brought, one row per id; their ids join the index.

    Of rows that share an id within the batch any one stays. ``day`` must be the
    same for all copies of an id. Null ids are one id.
    """
    spark = rows.sparkSession
    marked = _marked(rows, id_col, day).dropDuplicates(["__one", "__two"])
    days = [r.d for r in marked.select(F.col("__day").alias("d")).distinct().collect() if r.d is not None]
    try:
        seen = spark.read.schema(_SCHEMA).parquet(path).where(F.col("batch") < number)
        among = F.col("day").isin(days) if days else F.lit(False)
        known = seen.where(among | F.col("day").isNull()).select(F.col("one").alias("__one"), F.col("two").alias("__two"))
        fresh = marked.join(known, ["__one", "__two"], "left_anti")
    except AnalysisException:  # the first batch
        fresh = marked
    index = fresh.select(F.col("__one").alias("one"), F.col("__two").alias("two"), F.col("__day").alias("day"))
    # a folder of this batch's own, replaced whole; rows of a day lie together, a large day over several files
    index.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={number}")
    return fresh.select(*rows.columns)
