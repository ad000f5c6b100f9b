"""Task grids: products of scenario dimensions minus finished work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload import dims
from homeload.functions import calendar as cal
from homeload.functions import keys as key
from homeload.functions import text
from homeload.operators import ordered, pruning


def _pairs(rows: Sequence[tuple[int, str]]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(n).alias("name")) for i, n in rows])


def numbers(last: int) -> Column:
    return F.sequence(F.lit(1), F.lit(last))


def demographic_grid(runs: DataFrame, keys: Sequence[str], variants: int) -> DataFrame:
    """House type x people x composition x variant for every run row.

    The dimensions are fixed code lists, so the product is a chain of explodes
    of literals: no join and no shuffle. Employment status cycles with the
    variant.
    """
    grid = runs.select(*keys, F.explode(_pairs(dims.HOUSE_TYPES)).alias("h"))
    grid = grid.select("*", F.explode(_pairs(dims.PEOPLE_COUNTS)).alias("p"))
    grid = grid.select("*", F.explode(_pairs(dims.COMPOSITIONS)).alias("c"))
    grid = grid.select("*", F.explode(numbers(variants)).alias("variant"))
    statuses = dims.EMPLOYMENT_STATUSES
    cycle = F.pmod(F.col("variant") - 1, F.lit(len(statuses))) + 1
    grid = grid.withColumn("e", F.element_at(_pairs(statuses), cycle))
    code = F.concat(
        F.lit("H"), F.col("h.id"), F.lit("_P"), F.col("p.id"), F.lit("_C"), F.col("c.id"), F.lit("_E"), F.col("e.id")
    )
    return grid.select(
        *keys, F.col("h.id").alias("house_code"), F.col("p.id").alias("people_code"),
        F.col("c.id").alias("composition_code"), "variant", code.alias("combo_code"),
        F.col("h.name").alias("house_type"), F.col("p.name").alias("num_people"),
        F.col("c.name").alias("composition"), F.col("e.name").alias("employment_status"),
    )


def representative(grid: DataFrame, combos: DataFrame | None) -> DataFrame:
    """Keep the combinations listed as ``(people_code, house_code, composition_code)``.

    ``None`` keeps all. At most 75 distinct combinations exist, so the distinct
    list is a proven small side.
    """
    if combos is None:
        return grid
    names = ["people_code", "house_code", "composition_code"]
    valid = combos.where(
        F.col("people_code").between(1, len(dims.PEOPLE_COUNTS))
        & F.col("house_code").between(1, len(dims.HOUSE_TYPES))
        & F.col("composition_code").between(1, len(dims.COMPOSITIONS))
    )
    return grid.join(F.broadcast(valid.select(*names).distinct()), names, "left_semi")


def remaining(tasks: DataFrame, completed: DataFrame | None, keys: Sequence[str], prune: bool = False) -> DataFrame:
    """Tasks whose key is not finished yet; repeated finished keys combine before the shuffle.

    ``prune`` clears tasks by a Bloom filter first, which pays where the grid is
    much larger than what is finished: tasks that are surely open are not shuffled.
    """
    if completed is None:
        return tasks
    if prune:
        return pruning.anti_join(tasks, completed, keys)
    return tasks.join(completed.select(*keys).distinct(), list(keys), "left_anti")


def keyed(files: DataFrame, key_struct: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Fields of a parsed key as columns; files without a key drop out.

    The key is unpacked by a generator, so it is parsed once per file: no
    filter on a field can be moved in front of it.
    """
    found = F.filter(F.array(key_struct), lambda k: k.isNotNull())
    return files.select(*keep, F.inline(found))


def completed_variants(items: DataFrame, wanted: int, by: Sequence[str] = ("variant",)) -> DataFrame:
    """Variants that have at least ``wanted`` distinct households."""
    return (
        items.groupBy(*by).agg(F.count_distinct("household_id").alias("n_families"))
        .where(F.col("n_families") >= wanted)
    )


def number_households(
    families: DataFrame, call: Sequence[str], position: Sequence[str], levels: Sequence[str] = ()
) -> DataFrame:
    """Assign household ids: a counter per type initials inside one generation call."""
    abbr = text.initials(F.coalesce("family_type", F.lit("Unknown")))
    counted = ordered.running_number(
        families.withColumn("__abbr", abbr), [*call, "__abbr"], position, "__n", levels
    )
    new_id = text.household_id(F.col("country"), F.col("family_type"), F.col("__n"))
    return counted.withColumn("household_id", new_id).drop("__abbr", "__n")


def index_families(families: DataFrame, position: Sequence[str], levels: Sequence[str], run: Sequence[str] = ()) -> DataFrame:
    """Add ``family_index`` and the short file id ``f01`` in list order."""
    numbered = ordered.running_number(families, list(run), position, "family_index", levels)
    return numbered.withColumn("family_file_id", F.concat(F.lit("f"), text.zero_padded(F.col("family_index"), 2)))


def index_profiles(
    profiles: DataFrame, position: Sequence[str], run: Sequence[str] = (), levels: Sequence[str] = ()
) -> DataFrame:
    """Add ``profile``: the number of a weather profile within its season."""
    named = profiles.withColumn("season", F.coalesce("season", F.lit("Unknown")))
    return ordered.running_number(named, [*run, "season"], position, "profile", levels)


def season_groups(profiles: DataFrame, position: str, run: Sequence[str] = ()) -> DataFrame:
    """Profiles per season with the first position each season was seen at."""
    return profiles.groupBy(*run, F.coalesce("season", F.lit("Unknown")).alias("season")).agg(
        F.count(F.lit(1)).alias("n_profiles"), F.min(position).alias("first_position")
    )


def scenario_fanout(
    families: DataFrame,
    profiles: DataFrame,
    on: Sequence[str],
    variants: int,
    day_types: Sequence[str] = (cal.WEEKDAY, cal.WEEKEND),
) -> DataFrame:
    """Family x weather profile x day type x variant within each run.

    Families and profiles meet on the run key; whatever the profile side's size,
    the planner may broadcast it from statistics or split a skewed run. Rows
    carry ids only, documents join late.
    """

    def optional(name: str) -> Column:
        return F.col(name) if name in profiles.columns else F.lit(None).cast("string")

    types = cal.day_types_of_profile(
        optional("day_type"), optional("date_type"), optional("day_name"), day_types
    )
    narrow = profiles.select(*on, "season", "profile", types.alias("types"))
    tasks = families.join(narrow, list(on))
    tasks = tasks.withColumn("day_type", F.explode("types")).drop("types")
    return tasks.withColumn("variant", F.explode(numbers(variants)))


def with_seed(tasks: DataFrame, keys: Sequence[str]) -> DataFrame:
    return tasks.withColumn("seed", key.task_seed(*[F.col(k) for k in keys]))
