"""Anti-joins that shuffle only rows which can have a partner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a key, hashes a key: about one row in a hundred is asked in vain.
BITS_A_KEY, HASHES = 10, 4
#: Bits of the largest filter that is broadcast, 32 MB; beyond it the plain anti-join does the work.
MOST_BITS = 1 << 28
_CHUNK = 1 << 15  # bits of one bitmap of the built-in functions


def _positions(keys: Sequence[str], bits: int) -> list[Column]:
    """Places of a row's key in the filter; a null in a key has a place like any value."""
    whole = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    return [F.pmod(F.xxhash64(whole, F.lit(seed)), F.lit(bits)) for seed in range(HASHES)]


def bloom_filter(df: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """``chunk, bitmap``: a Bloom filter over the keys, 4 KB a row; built by an aggregate that merges map-side."""
    at = df.select(F.explode(F.array(*_positions(keys, bits))).alias("at"))
    return at.groupBy(F.bitmap_bucket_number("at").alias("chunk")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))


def may_hold(df: DataFrame, bloom: DataFrame, keys: Sequence[str], bits: int, name: str) -> DataFrame:
    """``df`` with boolean ``name``: false where the filter proves that a key is not in it."""
    out, tests = df, []
    for i, at in enumerate(_positions(keys, bits)):
        chunk, bitmap = f"__chunk{i}", f"__bitmap{i}"
        side = F.broadcast(bloom.select(F.col("chunk").alias(chunk), F.col("bitmap").alias(bitmap)))
        out = out.join(side, F.bitmap_bucket_number(at) == F.col(chunk), "left")
        place = F.bitmap_bit_position(at)
        byte = F.conv(F.hex(F.substring(bitmap, F.expr("1") + F.floor(place / 8).cast("int"), F.lit(1))), 16, 10).cast("bigint")
        tests.append(F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False)))
    held = tests[0]
    for test in tests[1:]:
        held = held & test
    return out.select(*df.columns, held.alias(name))


def anti_join(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``keys`` are not in ``done``: the rows of a ``left_anti`` join, shuffled only in part.

    A Bloom filter over ``done`` clears most of the rows that stay; only those
    it cannot clear meet ``done`` itself. The filter's size is worked out from
    the number of keys and checked: with too many for ``MOST_BITS`` the plain
    join is used. As in the plain join a key with a null equals no other.
    """
    done = done.select(*keys).where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).distinct()
    bits = _CHUNK * max(1, -(-done.count() * BITS_A_KEY // _CHUNK))
    if bits > MOST_BITS:
        return df.join(done, list(keys), "left_anti")
    marked = may_hold(df, bloom_filter(done, keys, bits), keys, bits, "__may_hold")
    clear = marked.where(~F.col("__may_hold")).drop("__may_hold")
    asked = marked.where("__may_hold").drop("__may_hold")
    return clear.unionByName(asked.join(done, list(keys), "left_anti").select(*df.columns))
