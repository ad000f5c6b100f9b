"""Outcomes of tasks kept up to date while their attempts arrive, in any order."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from homeload.operators import verdict

#: Groups that tasks are dealt over. A batch calls Python once for each group it meets, not once for each task.
GROUPS = 512
#: the tasks of a group as an Arrow table
STATE = "tasks BINARY"
OUTCOME = "status STRING, attempts_used BIGINT, final_output STRING, stalled BOOLEAN"
_TASK = [
    ("accepted_at", pa.int64()), ("final_output", pa.string()), ("last_attempt", pa.int64()), ("newest", pa.int64()),
    ("told", pa.bool_()), ("fresh", pa.bool_()),
]

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this library


def _arrived(parts: Iterator[pd.DataFrame], schema: pa.Schema) -> pa.Table:
    """A batch's attempts, each as the task it would be on its own."""
    found = []
    for part in parts:
        column = lambda name, dtype: pa.array(part[name], dtype, from_pandas=True)
        attempt, ok = column("attempt", pa.int64()), column("ok", pa.bool_())
        own = [pc.if_else(ok, attempt, None), column("final", pa.string()), attempt, column("stamp", pa.int64())]
        flags = [pa.array([False] * len(part)), pa.array([True] * len(part))]
        found.append(pa.table([*(column(k, pa.string()) for k in schema.names[: -len(_TASK)]), *own, *flags], schema=schema))
    return pa.concat_tables(found) if found else schema.empty_table()


def _merged(tasks: pa.Table, names: Sequence[str]) -> pa.Table:
    """One row per task: the first accepting attempt with its output, the highest attempt, the newest event."""
    first = pc.ScalarAggregateOptions(skip_nulls=False)
    rules = [
        ("accepted_at", "first", first), ("final_output", "first", first), ("last_attempt", "max"), ("newest", "max"), ("told", "min"), ("fresh", "max"),
    ]
    one = tasks.sort_by("accepted_at").group_by(names, use_threads=False).aggregate(rules)
    return one.select([*names, *(f"{r[0]}_{r[1]}" for r in rules)]).rename_columns([*names, *(r[0] for r in rules)])


def outcomes(
    attempts: DataFrame, keys: Sequence[str], time: str, late: str, stall_ms: int, max_attempts: int = verdict.MAX_ATTEMPTS,
    groups: int = GROUPS,
) -> DataFrame:
    """A stream of ``verdict.replay`` rows with ``stalled``: a row for every task that a batch changes.

    Each task is a small machine: the first attempt that accepts and its output,
    the highest attempt, the newest event. Attempts may come in any order; an
    earlier accepting one replaces a later one. A task that is open and without
    an attempt for ``stall_ms`` of event time, as seen from the watermark
    (``late`` behind the newest event), is reported as stalled by a timer, once;
    a new attempt can wake it up. Attempts later than ``late`` are dropped by
    the engine, so ``late`` must cover the longest delay.

    Tasks are dealt over ``groups`` by their ``keys``, which must be atomic
    values other than binary. The machines of a group advance together, column
    by column, and share one state and one timer, set to the first task that may
    stall. A batch rewrites the state of the groups it meets.
    """
    ok = F.coalesce(verdict.is_accepted(), F.lit(False))
    final = F.when(F.col("decision") == verdict.ACCEPT, F.col("output")).otherwise(F.col("edited_output"))
    stamp = F.unix_millis(F.col(time).cast("timestamp"))
    names, types = [f"key{i}" for i in range(len(keys))], attempts.select(*keys).schema
    group = F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("group")
    rows = attempts.withWatermark(time, late).where(F.col("attempt") <= max_attempts).select(
        group, *(F.col(k).cast("string").alias(n) for k, n in zip(keys, names)), time, F.col("attempt").cast("bigint").alias("attempt"),
        ok.alias("ok"), F.when(ok, final).alias("final"), stamp.alias("stamp"),
    )
    schema = pa.schema([*((n, pa.string()) for n in names), *_TASK])
    told = T.StructType([*(T.StructField(n, T.StringType()) for n in names), *T.StructType.fromDDL(OUTCOME)])

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tasks = pa.ipc.open_stream(bytes(state.get[0])).read_all() if state.exists else schema.empty_table()
        if not state.hasTimedOut:
            tasks = _merged(pa.concat_tables([tasks, _arrived(parts, schema)]), names).cast(schema)
        seen, accepted = state.getCurrentWatermarkMs(), pc.is_valid(tasks["accepted_at"])
        is_open = pc.and_(pc.invert(accepted), pc.less(tasks["last_attempt"], max_attempts))
        due = pc.add(tasks["newest"], stall_ms)
        stalled = pc.and_kleene(is_open, pc.less(due, seen))  # unknown without any time
        told_now = pc.fill_null(pc.and_(stalled, pc.invert(tasks["told"])), False)
        status = pc.if_else(accepted, "accepted", pc.if_else(is_open, "open", "failed"))
        used = pc.coalesce(tasks["accepted_at"], tasks["last_attempt"])
        found = pa.table([*(tasks[n] for n in names), status, used, tasks["final_output"], stalled], told.names)
        kept = tasks.select(schema.names[:-2]).append_column("told", stalled).append_column("fresh", pa.repeat(False, len(tasks)))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema) as out:
            out.write_table(kept.cast(schema).combine_chunks())
        state.update((sink.getvalue().to_pybytes(),))
        waiting = pc.min(due.filter(pc.and_(is_open, pc.invert(stalled)))).as_py()
        if waiting is not None:
            state.setTimeoutTimestamp(max(waiting, seen + 1))
        yield found.filter(pc.or_(tasks["fresh"], told_now)).to_pandas()

    found = rows.groupBy("group").applyInPandasWithState(step, told, STATE, "update", GroupStateTimeout.EventTimeTimeout)
    return found.select(*(F.col(n).cast(f.dataType).alias(f.name) for n, f in zip(names, types)), *told.names[len(names) :])


def newest_outcomes(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of every task out of the folders of ``usage.run_available`` in mode ``update``."""
    rows = spark.read.schema(T.StructType([*schema, T.StructField("batch", T.LongType())])).parquet(path)
    rest = [f.name for f in schema if f.name not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")
