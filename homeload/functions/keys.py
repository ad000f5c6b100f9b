"""Keys of finished work read from file names, and stable per-task seeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from homeload.functions.arrays import let

# File name formats, newest first.
_STAMP = r"_\d{8}_\d{6}\.json$"
FAMILY_NAME = r"^(.+?)_var(\d+)" + _STAMP
WEATHER_NAME = r"^variation(\d+)_([^_]+)" + _STAMP
CONSUMPTION_NAMES = (
    # pattern, parts in the order family, work, season, profile, day type, variant; an absent part is 1
    (r"^(.+?)_work(\d+)_s3var(\d+)_([^_]+)_([^_]+)_var(\d+)" + _STAMP, "$1/$2/$4/$3/$5/$6"),
    (r"^(.+?)_work(\d+)_([^_]+)_([^_]+)_var(\d+)" + _STAMP, "$1/$2/$3/1/$4/$5"),
    (r"^(.+?)_([^_]+)_([^_]+)_var(\d+)" + _STAMP, "$1/1/$2/1/$3/$4"),
)
COMBO_CODE = r"_(H\d+_P\d+_C\d+_E\d+)$"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _parts(name: Column, pattern: str, layout: str) -> Column:
    """Parts of a matching name as an array, null for any other; one replacement finds them all."""
    hit = F.rlike(name, F.lit(pattern))
    return F.when(hit, F.split(F.regexp_replace(name, pattern, layout), "/"))


def family_key(name: Column) -> Column:
    """``struct(household_id, variant)`` or null."""

    def key(p: Column) -> Column:
        return F.when(
            p.isNotNull(), F.struct(p[0].alias("household_id"), p[1].try_cast("int").alias("variant"))
        )

    return let(_parts(name, FAMILY_NAME, "$1/$2"), key)


def combo_code(household_part: Column) -> Column:
    """Demographic code a targeted household id ends in, or null."""
    return F.nullif(F.regexp_extract(household_part, COMBO_CODE, 1), F.lit(""))


def weather_key(name: Column) -> Column:
    """``struct(variant, season)`` or null."""

    def key(p: Column) -> Column:
        return F.when(p.isNotNull(), F.struct(p[0].try_cast("int").alias("variant"), p[1].alias("season")))

    return let(_parts(name, WEATHER_NAME, "$1/$2"), key)


def consumption_key(name: Column) -> Column:
    """``struct(family_id, work, season, profile, day_type, variant)`` or null.

    Formats are tried newest first.
    """

    def key(p: Column) -> Column:
        return F.when(
            p.isNotNull(),
            F.struct(
                p[0].alias("family_id"), p[1].try_cast("int").alias("work"), p[2].alias("season"),
                p[3].try_cast("int").alias("profile"), p[4].alias("day_type"), p[5].try_cast("int").alias("variant"),
            ),
        )

    return let(F.coalesce(*[_parts(name, *form) for form in CONSUMPTION_NAMES]), key)


def consumption_file_name(
    family_id: Column, profile: Column, season: Column, day_type: Column, variant: Column, stamp: Column
) -> Column:
    return F.concat(
        family_id, F.lit("_work01_s3var"), F.lpad(profile.cast("string"), 2, "0"), F.lit("_"), season,
        F.lit("_"), day_type, F.lit("_var"), F.lpad(variant.cast("string"), 2, "0"), F.lit("_"), stamp,
        F.lit(".json"),
    )


def task_seed(*parts: Column) -> Column:
    """Seed in 1..999999 fixed by the task key, so a re-run repeats it."""
    return (F.pmod(F.xxhash64(*parts), F.lit(999999)) + 1).cast("int")
