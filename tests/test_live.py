"""Streams that keep state: what a batch sees of earlier ones, and what a batch does that is run again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from homeload.session import shared_folder
from homeload.sources import seen_index
from homeload.streaming import attempts, ingest, pairing, usage

EVENTS = "log STRING, line LONG, block LONG, model STRING, chars LONG"
LOG = [("a", 1, 0, "m1", None), ("a", 2, 0, None, 5), ("a", 3, 0, "m1", None), ("a", 4, 1, "m2", None), ("a", 5, 1, None, 7), ("a", 6, 1, None, 8),
       ("b", 1, 0, None, 9), ("b", 2, 0, "other", None), ("b", 3, 0, None, 4), ("b", 4, 2, "m1", None), (None, 1, 0, "m2", None), (None, 2, 0, None, 3)]
PAIRED = [("a", 2, "m1", 5), ("a", 5, "m2", 7), (None, 2, "m2", 3)]


@pytest.mark.parametrize("cuts", [[12], [1, 12], [3, 5, 8, 9, 11, 12], list(range(1, 13))])
def test_pairs_meet_over_batches(spark, cuts):
    state, rows, start = shared_folder(spark, "last"), [], 0
    for number, stop in enumerate(cuts):
        batch = spark.createDataFrame(LOG[start:stop], EVENTS)
        for _ in range(2):  # the second time as after a failure
            got = pairing.pair_batch(batch, number, state, ["log"], ["line"], ["block"], ["m1", "m2"]).collect()
        rows += [(r.log, r.line, r.model, r.chars) for r in got]
        start = stop
    assert sorted(rows, key=str) == sorted(PAIRED, key=str)


def test_an_old_batch_run_again_sees_its_own_past(spark):
    state = shared_folder(spark, "last")
    parts = [spark.createDataFrame(LOG[a:b], EVENTS) for a, b in ((0, 1), (1, 4), (4, 6))]
    pair = lambda n: [(r.line, r.model) for r in pairing.pair_batch(parts[n], n, state, ["log"], ["line"], ["block"], ["m1", "m2"]).collect()]
    assert [pair(n) for n in range(3)] == [[], [(2, "m1")], [(5, "m2")]]
    assert pair(1) == [(2, "m1")] and pair(2) == [(5, "m2")]


def marked(docs):
    return docs.withColumn("broken_rules", F.when(F.col("bad"), F.array(F.lit("VAL4"))).otherwise(F.array().cast("array<string>")))


def test_first_document_of_a_key_wins(spark):
    unique = ingest.Unique(["country", "kind"], ["id"], shared_folder(spark, "claims"))
    schema = "id INT, country STRING, kind STRING, bad BOOLEAN"
    batches = [[(2, "X", "k", True), (3, "X", "k", False), (1, "X", None, False)], [(4, "X", "k", False), (5, "Y", "k", False), (6, "Y", "k", False), (7, "X", None, False)], []]
    got = {}
    for number in (0, 1, 1, 0, 2):
        rows = ingest.claim(marked(spark.createDataFrame(batches[number], schema)), number, unique).collect()
        assert len(rows) == len(batches[number])
        got |= {r.id: r.broken_rules for r in rows}
    assert got == {1: [], 2: ["VAL4"], 3: [], 4: ["VAL10"], 5: [], 6: ["VAL10"], 7: ["VAL10"]}


def test_ids_are_taken_in_once(spark):
    index, schema = shared_folder(spark, "seen"), "id LONG, ts TIMESTAMP, v INT"
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    batches = [[(1, day(0), 1), (1, day(0), 1), (2, day(1), 1)], [(2, day(1), 1), (3, day(1), 1)], [(1, day(0), 1), (4, None, 1), (None, day(5), 1)], [(4, None, 1), (None, day(5), 1), (3, day(1), 1), (5, day(400), 1)]]
    want = [[1, 2], [3], [-1, 4], [5]]
    for number in (0, 1, 1, 2, 3, 2, 3):
        rows = seen_index.first_time(spark.createDataFrame(batches[number], schema), index, number, "id", F.to_date("ts"))
        assert sorted(-1 if r.id is None else r.id for r in rows.collect()) == want[number]


def test_attempts_in_any_order(spark, tmp_path):
    schema = "task INT, attempt INT, readable BOOLEAN, decision STRING, edit_decision STRING, edit_readable BOOLEAN, output STRING, edited_output STRING, at TIMESTAMP"
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    row = lambda task, attempt, decision, n: (task, attempt, True, decision, None, None, f"o{attempt}", None, day(n))
    turns = [
        [row(1, 2, "ACCEPT", 3), row(2, 1, "REGENERATE_FULL", 0), row(3, 3, "REGENERATE_FULL", 2), row(4, 1, "REGENERATE_FULL", 0), row(5, 9, "ACCEPT", 0), row(6, 1, "REGENERATE_FULL", 30)],
        [row(1, 1, "ACCEPT", 1), row(2, 3, "REGENERATE_FULL", 4), row(7, 1, "ACCEPT", 30)],
        [row(4, 2, "ACCEPT", 31)],  # woken up
    ]
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    seen = []
    for rows in turns:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = attempts.outcomes(spark.readStream.schema(schema).parquet(source), ["task"], "at", "20 days", 5 * 86_400_000)
        usage.run_available(stream, out, state, "update")
        seen.append({r.task: (r.status, r.attempts_used, r.final_output, r.stalled) for r in attempts.newest_outcomes(spark, out, stream.schema, ["task"]).collect()})
    # the watermark stands at day 10 after the first turn
    assert seen[0] == {1: ("accepted", 2, "o2", False), 2: ("open", 1, None, True), 3: ("failed", 3, None, False), 4: ("open", 1, None, True), 6: ("open", 1, None, False)}
    assert seen[1] == seen[0] | {1: ("accepted", 2, "o2", False), 2: ("open", 1, None, True), 7: ("accepted", 1, "o1", False)}
    assert seen[2][4] == ("accepted", 2, "o2", False)


def test_an_earlier_acceptance_replaces_a_later_one(spark, tmp_path):
    schema = "task INT, attempt INT, readable BOOLEAN, decision STRING, edit_decision STRING, edit_readable BOOLEAN, output STRING, edited_output STRING, at TIMESTAMP"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for n, (attempt, decision) in enumerate([(3, "ACCEPT"), (1, "REGENERATE_PARTIAL"), (2, "ACCEPT")]):
        rows = [(1, attempt, True, decision, "REGENERATE_FULL", True, f"o{attempt}", "e", dt.datetime(2024, 1, 9 - n))]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = attempts.outcomes(spark.readStream.schema(schema).parquet(source), ["task"], "at", "30 days", 86_400_000)
        usage.run_available(stream, out, state, "update")
    assert [tuple(r)[1:4] for r in attempts.newest_outcomes(spark, out, stream.schema, ["task"]).collect()] == [("accepted", 2, "o2")]


@pytest.mark.parametrize("groups", [1, 512])
def test_machines_of_a_group_advance_together(spark, tmp_path, groups):
    """Python is called for groups of tasks; the machines stay apart, whatever the group, null keys among them."""
    schema = "run STRING, task LONG, attempt INT, readable BOOLEAN, decision STRING, edit_decision STRING, edit_readable BOOLEAN, output STRING, edited_output STRING, at TIMESTAMP"
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    row = lambda run, task, attempt, decision, n: (run, task, attempt, True, decision, None, None, f"{task}/{attempt}" if attempt < 3 else None, None, day(n))
    big = 2**53 + 1
    turns = [
        [row("a", i, 1, "ACCEPT" if i % 2 else "REGENERATE_FULL", 0) for i in range(40)] + [row(None, big, 2, "ACCEPT", 30), row(None, big + 1, 1, "UNSURE", 30), row("a", None, 3, "ACCEPT", 30)],
        [row(None, big, 1, "ACCEPT", 29), row("a", 2, 2, "ACCEPT", 30), row("a", 4, 3, "UNSURE", 30)],
        [row("b", 1, 1, "ACCEPT", 60), (*row("c", 1, 1, "UNSURE", 0)[:-1], None)],
    ]
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows in turns:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        found = attempts.outcomes(spark.readStream.schema(schema).parquet(source), ["run", "task"], "at", "20 days", 5 * 86_400_000, groups=groups)
        usage.run_available(found, out, state, "update")
    got = {(r.run, r.task): tuple(r)[2:] for r in attempts.newest_outcomes(spark, out, found.schema, ["run", "task"]).collect()}
    want = {("a", i): ("accepted", 1, f"{i}/1", False) if i % 2 else ("open", 1, None, True) for i in range(40)}
    assert got == want | {
        (None, big): ("accepted", 1, f"{big}/1", False), (None, big + 1): ("open", 1, None, True), ("a", None): ("accepted", 3, None, False),
        ("a", 2): ("accepted", 2, "2/2", False), ("a", 4): ("failed", 3, None, False), ("b", 1): ("accepted", 1, "1/1", False),
        ("c", 1): ("open", 1, None, None),  # no time is known
    }
    rows = spark.read.parquet(out)
    assert rows.where("run = 'a' AND task = 6").count() == 2  # open, then stalled, each told once
    assert rows.where("run = 'a' AND task = 1").count() == 1
