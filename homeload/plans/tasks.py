"""Task lists of the three stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload.functions import calendar as cal
from homeload.functions import text
from homeload.operators import tasks as t


def family_tasks(
    runs: DataFrame,
    keys: Sequence[str],
    variants: int,
    combos: DataFrame | None = None,
    completed: DataFrame | None = None,
) -> DataFrame:
    """Targeted family tasks of each run, minus the finished ``(combo_code, variant)``."""
    grid = t.representative(t.demographic_grid(runs, keys, variants), combos)
    left = t.remaining(grid, completed, [*keys, "combo_code", "variant"])
    return t.with_seed(left, [*keys, "combo_code", "variant"])


def standard_family_tasks(
    runs: DataFrame, keys: Sequence[str], variants: int, families_per_call: int, completed: DataFrame | None = None
) -> DataFrame:
    """One task per variant, minus variants with enough households."""
    grid = runs.select(*keys, F.explode(t.numbers(variants)).alias("variant"))
    done = None if completed is None else t.completed_variants(completed, families_per_call, [*keys, "variant"])
    return t.with_seed(t.remaining(grid, done, [*keys, "variant"]), [*keys, "variant"])


def weather_tasks(
    runs: DataFrame, keys: Sequence[str], variants: int, seasons: Sequence[str], completed: DataFrame | None = None
) -> DataFrame:
    """Variant x season tasks of each run, minus the finished ones."""
    grid = runs.select(*keys, F.explode(t.numbers(variants)).alias("variant")).select(
        "*", F.explode(F.array(*[F.lit(s) for s in seasons])).alias("season")
    )
    done_keys = [*keys, "variant", "season"]
    return t.with_seed(t.remaining(grid, completed, done_keys), done_keys)


def consumption_tasks(
    families: DataFrame,
    profiles: DataFrame,
    on: Sequence[str],
    variants: int,
    day_types: Sequence[str] = (cal.WEEKDAY, cal.WEEKEND),
    completed: DataFrame | None = None,
    prune: bool = False,
) -> DataFrame:
    """Consumption tasks with ids, labels and seeds.

    ``families`` carries ``family_file_id`` and ``household_id``, ``profiles``
    carries ``season`` and ``profile``; both carry the run columns ``on``.
    ``prune`` is that of ``operators.tasks.remaining``.
    """
    narrow = families.select(*on, "family_file_id", F.coalesce("household_id", F.lit("Unknown")).alias("household_id"))
    grid = t.scenario_fanout(narrow, profiles, on, variants, day_types)
    keys = [*on, "family_file_id", "season", "profile", "day_type", "variant"]
    left = t.remaining(grid, completed, keys, prune)
    labelled = left.withColumn("family_label", text.day_label(F.col("household_id"), F.col("day_type")))
    return t.with_seed(labelled, keys)


def with_documents(tasks: DataFrame, families: DataFrame, profiles: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join the documents a task needs, after elimination has made the list short."""
    fam = families.select(
        *on, "family_file_id", F.struct(*[c for c in families.columns if c not in (*on, "family_file_id")]).alias("family"),
        text.work_regime(
            F.col("household_work_regime"), F.col("weekday_daytime_occupancy_level"), F.col("members")
        ).alias("work_regime"),
    )
    weather = profiles.select(
        *on, "season", "profile", F.struct(*[c for c in profiles.columns if c not in (*on, "profile")]).alias("weather")
    )
    return tasks.join(fam, [*on, "family_file_id"]).join(weather, [*on, "season", "profile"])


def pick_family(
    families: DataFrame, household_id: str | None = None, index: int | None = None
) -> DataFrame:
    """The first file's family at a 0-based position, or with an id; position has priority.

    ``families`` carries ``file_rank`` and ``position``.
    """
    if household_id is None and index is None:
        raise ValueError("give a household id or a position")
    hit = families.where(F.col("position") == index) if index is not None else families.where(
        F.col("household_id") == household_id
    )
    packed = F.struct(*families.columns)
    return hit.agg(F.min_by(packed, F.struct("file_rank", "position")).alias("f")).where(F.col("f").isNotNull()).select("f.*")


def run_frame(spark: SparkSession, **columns) -> DataFrame:
    """One run row from settings, e.g. ``run_frame(spark, country="Ireland", year=2009)``."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
