"""Load curves over consumption documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.operators import loads


def load_curves(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Curve, daily total, peak and occupancy per document; nothing is shuffled."""
    return loads.document_loads(docs, keys)


def mean_curves(docs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean kWh per hour over documents, e.g. by country, season and day type."""
    hours = docs.select(
        *by, F.posexplode(loads.household_kwh()).alias("hour", "kwh")
    )
    return hours.groupBy(*by, "hour").agg(F.avg("kwh").alias("kwh"), F.count(F.lit(1)).alias("documents"))
