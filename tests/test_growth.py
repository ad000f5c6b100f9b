"""Pruned anti-joins, period joins, aligned diffs and kept sums against plain versions."""

import datetime as dt
import difflib
import random

import pytest
from pyspark.sql import functions as F

from homeload import dims
from homeload.operators import alignment, periods, pruning
from homeload.plans import usage, usage_store
from homeload.queries import QUERIES
from homeload.queries.audit import DAYS_A_TASK, consumption_day_docs
from homeload.session import shared_folder

# --- anti-join ------------------------------------------------------------------

TASK = "a INT, b STRING, n INT"


@pytest.mark.parametrize("bits", [pruning.MOST_BITS, 0])
def test_pruned_rows_are_those_of_the_plain_join(spark, monkeypatch, bits):
    monkeypatch.setattr(pruning, "MOST_BITS", bits)
    rng = random.Random(1)
    tasks = [(rng.randrange(300) if i % 50 else None, rng.choice(["x", "y", "", None]), i) for i in range(4000)]
    done = [(rng.randrange(300) if i % 40 else None, rng.choice(["x", "", None]), i) for i in range(300)] + [(7, "x", 0)] * 5
    t, d = spark.createDataFrame(tasks, TASK), spark.createDataFrame(done, TASK).select("a", "b")
    want = sorted(r.n for r in t.join(d, ["a", "b"], "left_anti").collect())
    assert sorted(r.n for r in pruning.anti_join(t, d, ["a", "b"]).collect()) == want and 0 < len(want) < 4000
    assert pruning.anti_join(t, d.where("false"), ["a", "b"]).count() == 4000


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    held = spark.range(20_000).selectExpr("id * 3 AS k")
    bits = 20_000 * pruning.BITS_A_KEY // (1 << 15) * (1 << 15) + (1 << 15)
    marked = pruning.may_hold(spark.range(120_000).withColumnRenamed("id", "k"), pruning.bloom_filter(held, ["k"], bits), ["k"], bits, "may")
    own = marked.groupBy((F.col("k") % 3 == 0) & (F.col("k") < 60_000)).agg(F.count("*").alias("n"), F.count_if("may").alias("m")).collect()
    figures = {r[0]: (r.n, r.m) for r in own}
    assert figures[True] == (20_000, 20_000) and figures[False][1] < 0.03 * figures[False][0]


def test_exact_join_gets_possible_hits_only(spark):
    tasks, done = spark.range(50_000).withColumnRenamed("id", "k"), spark.range(0, 1000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = pruning.anti_join(tasks, done, ["k"])
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exact = plan.split("LeftAnti")[1]
    assert plan.count("LeftAnti") == 1 and "getbit" in exact and "Filter" in exact.split("Exchange hashpartitioning")[1]
    assert plan.count("BroadcastHashJoin") >= pruning.HASHES and out.count() == 49_000


# --- periods --------------------------------------------------------------------


def test_dates_meet_all_their_periods_once(spark):
    rng, base = random.Random(2), dt.date(2023, 12, 1)
    day = lambda: base + dt.timedelta(days=rng.randrange(400))
    facts = [(i, rng.choice(["A", "B", "C", None]), day() if i % 30 else None) for i in range(400)]
    made = []
    for i in range(150):
        a = day()
        made.append((i, rng.choice(["A", "B", None]), a if i % 17 else None, a + dt.timedelta(days=rng.choice([-1, 0, 3, 31, 32, 33, 90])) if i % 13 else None))
    made += [(900, "A", dt.date(1, 1, 1), dt.date(9999, 12, 31)), (901, "B", dt.date(2050, 1, 1), dt.date(2051, 1, 1))]
    f = spark.createDataFrame(facts, "n INT, code STRING, day DATE")
    p = spark.createDataFrame(made, "p INT, code STRING, valid_from DATE, valid_to DATE")
    low, high = dt.date.min, dt.date.max
    hits = [(n, q) for n, c, d in facts for q, k, a, b in made if c and c == k and d and (a or low) <= d <= (b or high)]
    alone = [(n, None) for n, _, _ in facts if n not in {h[0] for h in hits}]
    for bins in (1, 32, 1000):
        got = periods.period_join(f, p, "code", "day", bin_days=bins)
        assert sorted(((r.n, r.p) for r in got.collect()), key=str) == sorted(hits + alone, key=str)
        assert got.columns == ["n", "code", "day", "p", "valid_from", "valid_to"]
    assert periods.period_join(f, p, "code", "day", how="inner").count() == len(hits)
    assert periods.period_join(f.where("false"), p, "code", "day").count() == 0
    assert periods.period_join(f, p.where("false"), "code", "day").count() == len(facts)
    plan = periods.period_join(f, p, "code", "day")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "__bin" in plan


def test_equal_dates_and_equal_periods_meet_once(spark, tmp_path):
    """The registered query joins distinct dates with distinct periods and counts as if each row met each."""
    at = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    orders = [(97, 1, at(0)), (97, 1, at(0)), (9, 1, at(3)), (14, 51, at(3)), (None, 1, at(5)), (16, None, at(2)), (17, 2, None), (194, 2, at(8))]
    lines = [(s, at(d) if d is not None else None) for s in (1, 61, 2, None) for d in (0, 3, 3, 4, 9, None)]
    spark.createDataFrame(orders, "o_orderkey LONG, o_custkey LONG, o_orderdate TIMESTAMP_NTZ").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_suppkey LONG, l_shipdate TIMESTAMP_NTZ").write.parquet(str(tmp_path / "lineitem.parquet"))
    want = {}
    for s, day in lines:
        met = []
        for o, c, start in orders:
            span = dt.timedelta(days=o % 9 - 1) if o is not None and o % 97 else None
            if None not in (s, day, c) and c % 50 == s % 60 and (start is None or start <= day) and (span is None or start is None or day <= start + span):
                met.append(o)
        row = want.setdefault((None if s is None else s % 60, day and day.year), [0, 0, 0])
        row[0] += max(1, len(met))
        row[1] += sum(o is not None for o in met)
        row[2] += sum((o or 0) % 1000 for o in met)
    found = QUERIES["period_join"](spark, str(tmp_path))
    assert {(r.code, r.year): [r["rows"], r.hits, r.checked] for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan[plan.index("Join ") :].count("Aggregate [") == 2


def test_days_are_dealt_by_their_number(spark):
    """A small table of customers is one task; the days made of them are not."""
    c = spark.range(4500).selectExpr("if(id % 9 = 0, 7, id) AS c_custkey", "id % 25 AS c_nationkey", "concat('c', id) AS c_name").coalesce(1)
    docs = consumption_day_docs(c)
    sizes = [r["count"] for r in docs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4500 and len(sizes) == 3 and max(sizes) <= DAYS_A_TASK
    assert consumption_day_docs(c.where("false")).count() == 0


# --- diffs ----------------------------------------------------------------------


def diff(frame_of, old, new):
    return [tuple(r)[1:] for r in sorted(frame_of([(1, old, new)]).collect(), key=lambda r: (r.old_no is None, r.old_no, r.new_no))]


@pytest.fixture(scope="module")
def aligned(spark):
    return lambda rows: alignment.aligned_diff(spark.createDataFrame(rows, "k INT, old STRING, new STRING"), ["k"], "old", "new")


def test_one_inserted_line_is_one_change(aligned):
    assert diff(aligned, "a\nb\nc", "a\nnew\nb\nc") == [(None, 1, None, "new")]
    assert diff(aligned, "a\nb\nc", "a\nc") == [(1, None, "b", None)]
    assert diff(aligned, "a\nb\nc", "a\nB\nc") == [(1, 1, "b", "B")]
    assert diff(aligned, "x\nx\nx", "x\nx\nx\nx") == [(None, 3, None, "x")]  # no line stands once: equal ends
    assert diff(aligned, "a\nb\nb\nc", "a\nb\nb\nb\nc") == [(None, 3, None, "b")]
    assert diff(aligned, "same", "same") == [] and diff(aligned, None, None) == []
    assert diff(aligned, None, "a\nb") == [(None, 0, None, "a"), (None, 1, None, "b")] and diff(aligned, "a", None) == [(0, None, "a", None)]
    # of two lines that changed places one stays
    assert len(diff(aligned, "a\nb\nc\nd", "a\nc\nb\nd")) == 2


def test_changes_turn_one_version_into_the_other(spark, aligned):
    rng, rows = random.Random(3), []
    for k in range(120):
        old = [rng.choice(["", "x", "y", f"l{rng.randrange(60)}"]) if k % 2 else f"u{i}" for i in range(rng.randrange(1, 25))]
        new = list(old)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(new) + 1)
            new[at : at + rng.randrange(2)] = [f"n{rng.randrange(10**6)}"] * rng.randrange(2)
        rows.append((k, "\n".join(old), "\n".join(new)))
    found = {}
    for r in aligned(rows).collect():
        found.setdefault(r.k, []).append(r)
    for k, old, new in rows:
        a, b, own = old.split("\n"), new.split("\n"), found.get(k, [])
        gone, come = {r.old_no for r in own if r.old_no is not None}, {r.new_no: r.new_line for r in own if r.new_no is not None}
        assert all(a[r.old_no] == r.old_line for r in own if r.old_no is not None)
        kept = iter([x for i, x in enumerate(a) if i not in gone])
        assert [come[i] if i in come else next(kept) for i in range(len(b))] == b and next(kept, None) is None
        best = sum(n for _, _, n in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
        assert k % 2 or len(gone) == len(a) - best  # with unlike lines no more than must


def test_longest_chain(spark):
    rng = random.Random(4)
    rows = [(k, [(o, n) for o, n in enumerate(rng.sample(range(20), rng.randrange(0, 15)))]) for k in range(60)]
    df = spark.createDataFrame(rows, "k INT, p ARRAY<STRUCT<o: INT, n: INT>>").select("k", "p", alignment.longest_chain(F.col("p")).alias("c"))
    for r in df.collect():
        ends = []
        for _, n in r.p:
            ends.append(1 + max((e for e, (_, m) in zip(ends, r.p) if m < n), default=0))
        chain = [(x.o, x.n) for x in r.c]
        assert len(chain) == max(ends, default=0) and chain == sorted(chain) and [n for _, n in chain] == sorted(n for _, n in chain)
        assert set(chain) <= {(x.o, x.n) for x in r.p}


# --- sums -----------------------------------------------------------------------

FLAT = "id STRING, ts TIMESTAMP, model STRING, role STRING, provider STRING, duration_seconds DOUBLE, response_chars LONG, tokens_in LONG, tokens_out LONG, cost_total DOUBLE"


def test_sums_of_loads_equal_the_whole_report(spark):
    rng, roles = random.Random(5), dims.ROLES
    rows = [(f"c{i}", dt.datetime(2024, 1, 1 + i % 5) if i % 9 else None, rng.choice([m for _, m in roles]), rng.choice([*[r for r, _ in roles], None, "who"]), "p", 0.25 * i, i, i % 7, None, i / 8) for i in range(60)]
    loads = [rows[:20], rows[10:30], [], rows[25:60] + rows[:3]]
    folder = shared_folder(spark, "sums")
    for number in (0, 1, 1, 2, 3, 1, 3):
        usage_store.add_calls(spark.createDataFrame(loads[number], FLAT), roles, folder, number)
    whole = usage.usage_report(spark.createDataFrame(rows, FLAT), roles)
    show = lambda df: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())
    assert show(usage_store.report(spark, folder, roles)) == show(whole)
    assert usage_store.by_day(spark, folder).agg(F.sum("calls")).first()[0] == whole.where("role = 'TOTAL'").first().calls
