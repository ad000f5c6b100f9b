"""Rounding, token and cost arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_RATES = (1.0, 3.0)  # fixed values: USD per million input / output tokens


def rounded(value: Column, digits: int = 2) -> Column:
    """Half-to-even, the rounding published profiles use."""
    return F.bround(value, digits)


def per_call(total: Column, calls: Column) -> Column:
    return F.when(calls > 0, total / calls).otherwise(F.lit(0.0))


def total_tokens(tokens_in: Column, tokens_out: Column) -> Column:
    return F.coalesce(tokens_in, F.lit(0)) + F.coalesce(tokens_out, F.lit(0))


def call_cost(tokens_in: Column, tokens_out: Column, rate_in: Column, rate_out: Column) -> Column:
    """Cost struct; a call without both token counts costs nothing."""
    billed = (F.coalesce(tokens_in, F.lit(0)) > 0) & (F.coalesce(tokens_out, F.lit(0)) > 0)

    def cost(amount: Column) -> Column:
        return F.when(billed, amount / 1e6).otherwise(F.lit(0.0))

    return F.struct(
        cost(tokens_in * rate_in).alias("input"),
        cost(tokens_out * rate_out).alias("output"),
        cost(tokens_in * rate_in + tokens_out * rate_out).alias("total"),
    )


def response_chars(response: Column) -> Column:
    return F.coalesce(F.length(response), F.lit(0)).cast("bigint")
