"""JSON documents: one array or one object per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload import schemas
from homeload.functions import keys, text
from homeload.operators import nested, tasks

Paths = str | Sequence[str]


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that can be listed; a path is looked up, its data is not read."""
    found = []
    for path in paths:
        try:
            spark.read.text(path)
        except AnalysisException:
            continue
        found.append(path)
    return found


def read_documents(
    spark: SparkSession, paths: Paths, schema: str, pattern: str | None = None, source_column: str | None = None
) -> DataFrame:
    """Documents of all files with an explicit schema; unreadable files give no rows.

    An object counts as a list of one. A field of the wrong type is null, so
    the rules can report it; a file that is not exactly one JSON value drops
    out as a whole. Each file is read once. ``pattern`` filters file names, ``source_column`` adds the
    name of the file a row came from.
    """
    if not paths:
        return spark.createDataFrame([], schema)
    whole = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    files = whole.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    good = files.where(text.is_json(F.col("value"))).select(F.col("_metadata.file_path").alias("_path"), "value")
    listed = F.from_json("value", schemas.array_of(schema), schemas.ANY_LENGTH)  # an object alone is a list of one
    df = good.select("_path", F.explode(F.filter(listed, lambda d: d.isNotNull())).alias("_doc"))
    if source_column:
        return df.select("_doc.*", keys.file_name(F.col("_path")).alias(source_column))
    return df.select("_doc.*")


def families(spark: SparkSession, paths: Paths, **kw) -> DataFrame:
    return read_documents(spark, paths, schemas.FAMILY, **kw)


def weather_profiles(spark: SparkSession, paths: Paths, **kw) -> DataFrame:
    """Seasonal, sampled and dated profiles alike; fields a variant lacks are null."""
    return read_documents(spark, paths, schemas.WEATHER_PROFILE, **kw)


def consumption(spark: SparkSession, paths: Paths, **kw) -> DataFrame:
    return read_documents(spark, paths, schemas.CONSUMPTION, **kw)


def sequences(spark: SparkSession, paths: Paths, schema: str = schemas.WEATHER_PROFILE) -> DataFrame:
    """Items of files holding a list, one object or ``{"sequence": [...]}``."""
    raw = spark.read.text(paths, wholetext=True)
    return raw.select(F.inline(nested.sequence_items(F.col("value"), schema)))


def finished_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """``(path, file, valid)`` of finished-work files; valid means it parses as JSON."""
    raw = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    name = F.input_file_name()
    return raw.select(
        name.alias("path"), keys.file_name(name).alias("file"),
        text.is_json(F.col("value")).alias("valid"),
    )


def corrupt_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    return finished_files(spark, folder, pattern).where(~F.col("valid")).select("path", "file")


_KEYS = {"family": keys.family_key, "weather": keys.weather_key, "consumption": keys.consumption_key}


def completed(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Distinct keys of the valid finished files; kind is family, weather or consumption."""
    files = finished_files(spark, folder).where("valid")
    return tasks.keyed(files, _KEYS[kind](F.col("file"))).distinct()
