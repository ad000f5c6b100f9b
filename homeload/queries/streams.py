"""Streaming jobs and sinks, run over what is there and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeload.functions.calendar import utc_instant, utc_wall_time
from homeload.plans import audit as plan
from homeload.plans import weather as weather_plan
from homeload.queries import usage as u
from homeload.queries.audit import ATTEMPTS_SQL, FAMILY_SQL, family_docs, timed_attempts
from homeload.queries.registry import query
from homeload.queries.tables import choose, hourly_weather, table
from homeload.queries.weather import SEASONAL_SQL, D
from homeload.session import shared_folder
from homeload.sources import sinks
from homeload.streaming import attempts as live_attempts
from homeload.streaming import ingest, pairing
from homeload.streaming import usage as live


def _stream(spark, sf_dir, name):
    """A table as a stream; the pattern matches one file as well as a folder of parts."""
    path = f"{sf_dir.rstrip('/')}/{name}.parque"
    return spark.readStream.schema(spark.read.parquet(path + "t").schema).parquet(path + "[t]")


_SUMS = """count(*) AS calls, sum(coalesce(tokens_in, 0))::BIGINT AS tokens_in, sum(coalesce(tokens_out, 0))::BIGINT AS tokens_out,
  round(sum(duration_seconds), 4) AS total_time, round(sum(cost_total), 8) AS total_cost"""
_SEEN = "seen AS (SELECT * FROM calls)"


def _live_calls(df):
    """Call records of an event stream; each even event arrives twice and must count once."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    once = df.select(
        F.col("event_id").alias("id"), utc_instant(F.col("ts")).alias("ts"), u._mapped("event_type", u.ROLE_OF).alias("role"),
        u._mapped("event_type", u.MODEL_OF).alias("model"), choose(F.col("event_id"), u.PROVIDERS).alias("provider"),
        F.col("value").alias("duration_seconds"),
        F.when(F.col("event_id") % 11 != 0, F.col("event_id") % 5000 + 100).alias("tokens_in"), (k * 10).alias("tokens_out"),
    )
    copies = F.when(F.col("id") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return once.withColumn("copy", F.explode(copies)).drop("copy")


def _run(spark, sf_dir, mode, **kw):
    stream = live.usage_windows(_live_calls(_stream(spark, sf_dir, "events")), **kw)
    out, checkpoint = shared_folder(spark, "usage-windows"), shared_folder(spark, "usage-windows-state")
    live.run_available(stream, out, checkpoint, mode)
    return live.delivered(spark, out, stream.schema, mode).select(
        utc_wall_time(F.col("window_start")).alias("window_start"), utc_wall_time(F.col("window_end")).alias("window_end"),
        "role", "calls", "tokens_in", "tokens_out", F.round("total_time", 4).alias("total_time"), F.round("total_cost", 8).alias("total_cost"),
    )


@query(f"""
WITH {u.CALLS_SQL}, {_SEEN}, {u._PRICED.format(source="seen")},
w AS (SELECT date_trunc('hour', ts) AS window_start, coalesce(role, 'unknown') AS role, {_SUMS} FROM priced GROUP BY 1, 2)
SELECT *, window_start + INTERVAL 1 HOUR AS window_end FROM w""")
def stream_usage_windows(spark, sf_dir):
    return _run(spark, sf_dir, "update")


@query(f"""
WITH {u.CALLS_SQL}, {_SEEN}, {u._PRICED.format(source="seen")},
s AS (SELECT *, date_trunc('hour', ts) - to_hours(h) AS window_start FROM priced, (SELECT unnest(range(4)) AS h)),
w AS (SELECT window_start, coalesce(role, 'unknown') AS role, {_SUMS} FROM s GROUP BY 1, 2)
SELECT *, window_start + INTERVAL 4 HOUR AS window_end FROM w""")
def stream_usage_sliding(spark, sf_dir):
    return _run(spark, sf_dir, "update", window="4 hours", slide="1 hour")


@query(f"""
WITH {u.CALLS_SQL}, {_SEEN}, {u._PRICED.format(source="seen")},
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY coalesce(role, 'unknown') ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM priced),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY coalesce(role, 'unknown') ORDER BY ts) AS session FROM g),
w AS (SELECT min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, coalesce(role, 'unknown') AS role, {_SUMS} FROM s GROUP BY coalesce(role, 'unknown'), session)
SELECT * FROM w""")
def stream_usage_sessions(spark, sf_dir):
    return _run(spark, sf_dir, "complete", session_gap="30 minutes")


@query(f"""
WITH {FAMILY_SQL.replace("""
    CASE WHEN count(*) OVER (PARTITION BY country, family_type) > 1 THEN 'VAL10|HIGH|cultural' END]""", """
    NULL]""")},
bad AS (SELECT c_custkey, string_agg(DISTINCT rule_id, ',' ORDER BY rule_id) AS broken_rules FROM findings WHERE severity = 'HIGH' GROUP BY c_custkey),
late AS (SELECT k AS c_custkey, row_number() OVER (PARTITION BY country, family_type ORDER BY k) > 1 AS taken FROM f WHERE k NOT IN (SELECT c_custkey FROM bad)),
j AS (SELECT c_custkey, coalesce(broken_rules, CASE WHEN taken THEN 'VAL10' ELSE '' END) AS broken_rules
      FROM customer LEFT JOIN bad USING (c_custkey) LEFT JOIN late USING (c_custkey))
SELECT c_custkey, broken_rules = '' AS accepted, broken_rules FROM j""")
def stream_validated_ingest(spark, sf_dir):
    """Documents arrive twice, the lower keys first; of equal family types in a country the first good one is accepted."""
    good, bad, state, claims, arrived = (shared_folder(spark, f"ingest-{n}") for n in ("accepted", "quarantine", "state", "claims", "arrivals"))
    unique = ingest.Unique(["country", "family_type"], ["c_custkey"], claims)
    customers = table(spark, sf_dir, "customer")
    middle = customers.agg(F.avg("c_custkey")).first()[0]
    for turn in range(2):
        half = customers.where((F.col("c_custkey") <= middle) == F.lit(turn == 0))
        half.write.mode("append").parquet(arrived)
        docs = family_docs(spark.readStream.schema(customers.schema).parquet(arrived))
        ingest.validated_ingest(docs, plan.marked_families, good, bad, state, unique=unique)
    accepted = spark.read.parquet(good).select("c_custkey", F.lit(True).alias("accepted"), F.lit("").alias("broken_rules"))
    refused = spark.read.parquet(bad).select(
        "c_custkey", F.lit(False).alias("accepted"), F.array_join("broken_rules", ",").alias("broken_rules")
    )
    return accepted.unionByName(refused)


def _in_turns(spark, df, turn, turns, keys, folder):
    """Write ``df`` as files, those of earlier ``turn`` values first; rows of equal ``keys`` in a turn share a file."""
    for n in range(turns):
        df.where(turn == n).repartition(_FILES, *keys).write.mode("append").parquet(folder)


_FILES, _TURNS = 4, (1, 3, 10)


@query(f"""
WITH {u._EVENTS_SQL} SELECT turns, conv_id, turn, model, chars FROM done, (SELECT unnest({list(_TURNS)}) AS turns)""")
def stream_log_pairing(spark, sf_dir):
    """Log events in one, three and ten turns; each pairs them as the whole logs do."""
    events, found = u._log_events(spark, sf_dir), None
    for turns in _TURNS:
        source, out, state, checkpoint = (shared_folder(spark, f"pairing-{n}") for n in ("events", "calls", "last", "state"))
        _in_turns(spark, events, F.expr(f"turn * {turns} div 8"), turns, ["conv_id"], source)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", _FILES).parquet(source)
        pairing.paired_calls(stream, out, state, checkpoint, ["conv_id"], ["turn"], ["block"], u.MODELS, buckets=_FILES)
        own = spark.read.parquet(out).select(F.lit(turns).alias("turns"), "conv_id", "turn", "model", "chars")
        found = own if found is None else found.unionByName(own)
    return found


#: Days an attempt may come late, and days (and half a day) without an attempt after which an open task has stalled.
_LATE, _STALL = 60, 120.5


@query(f"""
WITH {ATTEMPTS_SQL},
day AS (SELECT l_orderkey AS task, max(l_shipdate) AS newest FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1),
seen AS (SELECT max(l_shipdate) AS last_day FROM lineitem)
SELECT outc.*, status = 'open' AND epoch(last_day) - {_LATE} * 86400 > epoch(newest) + {int(_STALL * 86400)} AS stalled FROM outc JOIN day USING (task), seen""")
def stream_attempt_replay(spark, sf_dir):
    """Attempts arrive two years at a time, out of order within and across turns by up to two months; open tasks stall after four."""
    attempts, turns = timed_attempts(spark, sf_dir), 4
    source, out, checkpoint = (shared_folder(spark, f"attempts-{n}") for n in ("events", "outcomes", "state"))
    seen = F.date_add(F.col("at").cast("date"), F.pmod(F.xxhash64("task", "attempt"), F.lit(_LATE - 1)).cast("int"))
    arrival = F.floor((F.year(seen) - 1992) / 2).cast("int")
    _in_turns(spark, attempts, F.greatest(F.lit(0), F.least(F.lit(turns - 1), arrival)), turns, ["task"], source)
    stream = spark.readStream.schema(attempts.schema).option("maxFilesPerTrigger", _FILES).parquet(source)
    found = live_attempts.outcomes(stream, ["task"], "at", f"{_LATE} days", int(_STALL * 86_400_000))
    live.run_available(found, out, checkpoint, "update")
    return live_attempts.newest_outcomes(spark, out, found.schema, ["task"])


@query(f"""
WITH {u.CALLS_SQL}
SELECT ts::DATE AS day, coalesce(role, 'unknown') AS role, count(*) AS calls, sum(coalesce(tokens_in, 0))::BIGINT AS tokens_in FROM calls GROUP BY 1, 2""")
def stream_late_copies(spark, sf_dir):
    """Every call arrives, every second one again up to 60 days late; each counts once."""
    calls = u.calls(spark, sf_dir)
    late = calls.where(F.col("id") % 2 == 0).withColumn("after", F.col("id") % 61)
    both = calls.withColumn("after", F.lit(0).cast("bigint")).unionByName(late)
    arrival = F.date_add(F.col("ts").cast("date"), F.col("after").cast("int"))
    source, out, index, checkpoint = (shared_folder(spark, f"copies-{n}") for n in ("events", "calls", "seen", "state"))
    first = calls.agg(F.min("ts").cast("date").alias("d")).first().d
    turn = F.least(F.lit(3), F.floor(F.datediff(arrival, F.lit(first)) / 30)).cast("int")
    _in_turns(spark, both.withColumn("turn", turn), F.col("turn"), 4, ["id"], source)
    stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", _FILES).parquet(source)
    live.exactly_once(stream, out, index, checkpoint, "id", F.to_date("ts"))
    rows = spark.read.schema(calls.schema).parquet(out)
    return rows.groupBy(F.to_date("ts").alias("day"), F.coalesce("role", F.lit("unknown")).alias("role")).agg(
        F.count("*").alias("calls"), F.coalesce(F.sum("tokens_in"), F.lit(0)).alias("tokens_in")
    )


@query(f"""
SELECT replace("Country", ' ', '-') AS "Country", * EXCLUDE ("Country") FROM ({SEASONAL_SQL})""")
def sinks_roundtrip(spark, sf_dir):
    """Seasonal CSV files written by country and season, read back."""
    out = shared_folder(spark, "seasonal-csv")
    profile = weather_plan.seasonal_profile(hourly_weather(spark, sf_dir), digits=D)
    sinks.write_seasonal_files(profile, out)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in profile.schema if f.name not in ("Country", "Season"))
    return spark.read.option("header", True).option("nullValue", None).schema(f"{schema}, Country STRING, Season STRING").csv(
        out).na.fill("")


@query("""
SELECT o_custkey AS family_id, 'stage' || (o_orderkey % 2) AS stage, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS output
FROM orders GROUP BY 1, 2""")
def checkpoint_table(spark, sf_dir):
    """Stage outputs appended twice; the newest per key is read back."""
    out = shared_folder(spark, "checkpoints")
    o = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("stage"), (F.col("o_orderkey") % 2).cast("string")).alias("stage"), F.lit("Ireland").alias("country"),
        F.lit("Winter").alias("season"), F.col("o_custkey").alias("family_id"), F.col("o_orderkey").alias("output"),
        F.struct(F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("seq")).alias("timestamp"), "o_orderdate",
    )
    sinks.append_checkpoint(o.where("o_orderdate < '1998-01-01'").drop("o_orderdate"), out)
    sinks.append_checkpoint(o.where("o_orderdate >= '1998-01-01'").drop("o_orderdate"), out)
    return sinks.latest_checkpoints(spark, out).select("family_id", "stage", "output")
