"""Quality rules as a short-circuit cascade, cheapest rejection first.

Each rule is a condition over a text's measures. On a bounded sample every
rule's cost and selectivity are measured; rules are then tried in the order of
rejections per cost, and a text that one rule rejects never meets the next. The
order changes what a verdict costs, never the verdict. Only built-in functions.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload.functions.arrays import let
from homeload.llm.common import written

#: Fixed value: what parts words.
WORD = r"[^\x20\x09-\x0D]+"
SAMPLE_ROWS, SAMPLE_SHARE = 500, 0.05
#: A rule is timed over passes that take so long together, or over so many.
LEAST_SECONDS, MOST_PASSES = 0.15, 1 << 12


def _equal_neighbours(rows: Column) -> Column:
    """Of a sorted array of ``struct<key, i>``: the rows whose key equals the one before or after."""

    def pick(s: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            return F.coalesce(F.get(s, i)["key"] == F.get(s, j)["key"], F.lit(False))

        return F.filter(s, lambda row, i: ((i > 0) & same(i, i - 1)) | same(i, i + 1))

    return let(F.sort_array(rows), pick)


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows found twice or more in the text, the first included.

    Hashes that are all distinct prove that no window repeats, which settles
    most texts. Else windows are sorted with their places, so equal ones are
    neighbours: by hash first, then those that met by their words.
    """

    def covered(hashes: Column) -> Column:
        met = _equal_neighbours(F.transform(hashes, lambda h, i: F.struct(h.alias("key"), i.alias("i"))))
        window = lambda m: F.struct(*[F.get(words, m["i"] + k).alias(f"w{k}") for k in range(3)])
        hits = _equal_neighbours(F.transform(met, lambda m: F.struct(window(m).alias("key"), m["i"].alias("i"))))
        start = F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n"))
        add = lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n"))
        return F.aggregate(F.sort_array(F.transform(hits, lambda m: m["i"])), start, add, lambda a: a["n"])

    none = F.lit(0).cast("long")
    hashed = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(3)]))
    counted = let(hashed, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h)))
    return F.when(F.size(words) < 3, none).otherwise(counted)


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``q``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of the whole ``text`` (null: none)."""
    text = F.coalesce("text", F.lit(""))
    full_lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(full_lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(words).alias("n_repeat_words"),
        )

    return docs.withColumn("q", let(F.regexp_extract_all(text, F.lit(WORD), 0), of_words))


def base_failed(q: Column) -> Column:
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def rules(q: Column, text: Column) -> dict[str, Column]:
    """Name -> condition that rejects a text."""
    return {
        "symbols": 10 * q["n_symbols"] > q["n_words"],
        "shouting": 10 * F.regexp_count(text, F.lit("!")) > 3 * q["n_words"],
        "repeated lines": (q["n_dup_lines"] > 3) & (10 * q["n_dup_lines"] > 3 * F.regexp_count(text, F.lit("\n"))),
        "word length": (q["word_chars"] < 2 * q["n_words"]) | (q["word_chars"] > 15 * q["n_words"]),
        "signs": 2 * F.regexp_count(text, F.lit(r"[!-@\[-`{-~]")) > q["word_chars"],
    }


def cascade_order(docs: DataFrame, conditions: Mapping[str, Column], sample_rows: int = SAMPLE_ROWS, share: float = SAMPLE_SHARE) -> list[str]:
    """Rule names by rejections per second, from at most ``sample_rows`` of ``docs``; only sampled texts are measured.

    A rule is run over the sample again and again within one job, until the job
    takes ``LEAST_SECONDS``, so what starting a job costs does not count.
    """
    sample = written(measures(docs.select("text").sample(fraction=share, seed=7).limit(sample_rows)), "quality-sample")

    if sample.isEmpty():
        return list(conditions)

    def cost(condition: Column) -> tuple[float, int]:
        """Seconds for one pass over the sample, and rejections."""
        passes = 16
        while True:
            repeated = sample.withColumn("__pass", F.explode(F.sequence(F.lit(1), F.lit(passes))))
            start = time.perf_counter()
            found = repeated.agg(F.count_if(condition)).first()[0]
            took = time.perf_counter() - start
            if took >= LEAST_SECONDS or passes >= MOST_PASSES:
                return took / passes, found // passes
            passes *= 4

    idle = cost(F.lit(False))[0]
    rates = {}
    for name, condition in conditions.items():
        seconds, found = cost(condition)
        rates[name] = found / max(seconds - idle, 1e-6)
    return sorted(rates, key=lambda n: -rates[n])


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures ``q``, ``base_failed`` and ``kept``; a text without words fails the base.

    Every row is judged by itself, so repeated rows and ids, nulls in other
    columns and empty tables change nothing.
    """
    measured = measures(docs).withColumn("base_failed", base_failed(F.col("q")))
    text = F.coalesce("text", F.lit(""))
    conditions = rules(F.col("q"), text)
    order = cascade_order(docs, conditions)
    cascade = reduce(lambda rest, name: F.when(conditions[name], False).otherwise(rest), reversed(order), F.lit(True))
    return measured.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(cascade))
