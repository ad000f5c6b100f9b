"""Finished items kept by key: an upsert table of plain Parquet that survives retries.

Items are hashed by key into a number of buckets that is fixed when the store
is made. A write takes the numbers of its items' buckets, reads those buckets
as they were before it, drops the items it brings anew (an anti-join within the
bucket) and writes the buckets again, as a version named after the batch. The
last step commits: one small file that lists the versions. So

- other items of a bucket, and all other buckets, stay as they are;
- a batch that is run again, after a failure or by mistake, starts from the
  same state and replaces its own version, whatever was written in between;
- readers see whole batches, as a version counts once it is committed.

One writer at a time. A batch number stands for one set of items.

Folders: ``buckets`` (their number), ``commits/batch=N`` (buckets of the
batch), ``data/batch=N/bucket=B``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
_COMMIT = "bucket INT, keys ARRAY<STRING>, batch BIGINT"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of an item, the same for a whole number of any width; null keys are keys like any other."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _bucket_number(spark: SparkSession, path: str, wanted: int | None) -> int:
    try:
        number = spark.read.schema("buckets INT").json(f"{path}/buckets").first().buckets
    except AnalysisException:
        number = wanted or BUCKETS
        spark.createDataFrame([(number,)], "buckets INT").coalesce(1).write.mode("overwrite").json(f"{path}/buckets")
    if wanted not in (None, number):
        raise ValueError(f"the store has {number} buckets, not {wanted}")
    return number


def versions(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """Batch that holds each bucket, of all commits or those of earlier batches; as many as there are buckets at most."""
    try:
        commits = spark.read.schema(_COMMIT).option("basePath", f"{path}/commits").parquet(f"{path}/commits")
        if before is not None:
            commits = commits.where(F.col("batch") < before)
        return {r.bucket: r.batch for r in commits.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()}
    except AnalysisException:  # nothing committed yet
        return {}


def _read(spark: SparkSession, path: str, schema: T.StructType, chosen: dict[int, int]) -> DataFrame:
    if not chosen:
        return spark.createDataFrame([], schema).withColumn("bucket", F.lit(None).cast("int"))
    folders = [f"{path}/data/batch={batch}/bucket={bucket}" for bucket, batch in sorted(chosen.items())]
    own = T.StructType([*schema, T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(own).option("basePath", path + "/data").parquet(*folders).select(*schema.names, "bucket")


def touched_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None) -> list[int]:
    """Buckets that the keys of ``df`` fall in; ``buckets`` is their number in a store that is new."""
    number = _bucket_number(df.sparkSession, path, buckets)
    return [r.b for r in df.select(bucket_of(keys, number).alias("b")).distinct().collect()]


def write_items(
    df: DataFrame, path: str, keys: Sequence[str], batch: int, buckets: int | None = None, touched: Sequence[int] | None = None
) -> None:
    """Put the items of ``df`` in the store in place of those with equal ``keys``; all other items stay.

    An item may be several rows of one key: they come and go together. ``batch``
    orders writes; the same number again replaces that write. An empty ``df``
    changes nothing. Columns named ``bucket`` or ``batch`` are the store's own.
    ``touched``, where the caller has the buckets of all keys of ``df``, saves
    a pass over ``df``.
    """
    if {"bucket", "batch"} & set(df.columns):
        raise ValueError("bucket and batch are columns of the store")
    spark = df.sparkSession
    number = _bucket_number(spark, path, buckets)
    fresh = df.withColumn("bucket", bucket_of(keys, number))
    if touched is None:
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]
    if not touched:
        return
    before = {b: n for b, n in versions(spark, path, batch).items() if b in set(touched)}
    new = fresh.select(F.col("bucket").alias("new_bucket"), *[F.col(k).alias(f"new_{i}") for i, k in enumerate(keys)]).distinct()
    old = _read(spark, path, df.schema, before)
    same = (old["bucket"] == new["new_bucket"])
    for i, k in enumerate(keys):
        same = same & old[k].eqNullSafe(new[f"new_{i}"])
    whole = old.join(new, same, "left_anti").unionByName(fresh)
    # rows of a bucket lie together, a large bucket over several files
    whole.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/batch={batch}")
    done = spark.createDataFrame([(b, list(keys)) for b in touched], "bucket INT, keys ARRAY<STRING>")
    done.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/batch={batch}")


def read_items(spark: SparkSession, path: str, schema: T.StructType | str, only: Sequence[int] | None = None) -> DataFrame:
    """All items, or those of some buckets; no item at all where nothing is committed."""
    schema = schema_of(schema) if isinstance(schema, str) else schema
    chosen = versions(spark, path)
    if only is not None:
        chosen = {b: n for b, n in chosen.items() if b in set(only)}
    return _read(spark, path, schema, chosen).drop("bucket")


def matching_items(
    df: DataFrame, path: str, keys: Sequence[str], schema: T.StructType, before: int | None = None, touched: Sequence[int] | None = None
) -> DataFrame:
    """The stored items in the buckets that the keys of ``df`` fall in: what a join with ``df`` can need.

    ``before`` reads the state that batch number started from; ``touched`` is as in ``write_items``.
    """
    spark = df.sparkSession
    touched = set(touched_buckets(df, path, keys) if touched is None else touched)
    return _read(spark, path, schema, {b: n for b, n in versions(spark, path, before).items() if b in touched}).drop("bucket")


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
