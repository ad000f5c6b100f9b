"""Unions of run outputs and of rule lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union; columns a part lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def text_lines(texts: DataFrame, column: str) -> DataFrame:
    """Every line of a text column; carriage returns count as line ends."""
    return texts.select(F.explode(F.split(F.col(column), "\r\n|\r|\n")).alias("line"))


def stripped(line: Column) -> Column:
    """Leading and trailing white space removed, whatever its kind."""
    return F.regexp_replace(line, r"(?U)^\s+|\s+$", "")


def distinct_lines(lines: DataFrame) -> DataFrame:
    """Distinct non-empty stripped lines; copies combine before the shuffle."""
    return lines.select(stripped(F.col("line")).alias("line")).where(F.col("line") != "").distinct()


def merged_rules(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of rule lines of several runs, sorted for output."""
    return distinct_lines(union_all([p.select("line") for p in parts])).orderBy("line")
