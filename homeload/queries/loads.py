"""Load curves, activity mix, runs and jumps over event-like activity."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeload.operators import loads, nested, ordered
from homeload.plans import loads as plan
from homeload.queries.registry import query
from homeload.queries.tables import table

ACTION_OF = {
    "view": "Watching-TV", "click": "Cooking", "purchase": "Sleeping", "signup": "At-school", "error": "Commuting",
}
ACTIONS_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ACTION_OF.items()) + " END"


def action():
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in ACTION_OF.items():
        out = out.when(F.col("event_type") == k, v)
    return out


def activity_long(spark, sf_dir):
    """Events as long activity rows; purchases run the heating, the rest are members."""
    e = table(spark, sf_dir, "events")
    heating = F.col("event_type") == "purchase"
    return e.select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.when(heating, "heating").otherwise("member").alias("stream"),
        F.when(~heating, F.col("event_type")).alias("member_id"), F.hour("ts").alias("hour"), action().alias("action"),
        (F.col("value") / 1000).alias("kwh"), "ts", "event_id",
    )


LONG_SQL = f"""act AS (
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_type = 'purchase' THEN 'heating' ELSE 'member' END AS stream,
         CASE WHEN event_type <> 'purchase' THEN event_type END AS member_id, hour(ts) AS hour, {ACTIONS_SQL} AS action,
         value / 1000 AS kwh, ts, event_id FROM events)"""


@query(f"WITH {LONG_SQL} SELECT user_id, day, hour, round(sum(kwh), 8) AS kwh, count(*) AS entries FROM act GROUP BY user_id, day, hour")
def load_curve(spark, sf_dir):
    curve = loads.load_curve(activity_long(spark, sf_dir), ["user_id", "day"])
    return curve.withColumn("kwh", F.round("kwh", 8))


@query(f"""
WITH {LONG_SQL}, c AS (SELECT user_id, day, hour, sum(kwh) AS kwh FROM act GROUP BY ALL)
SELECT user_id, day, round(sum(kwh), 8) AS daily_kwh, round(max(kwh), 8) AS peak_kwh, arg_max(hour, (kwh, -hour)) AS peak_hour
FROM c GROUP BY user_id, day""")
def daily_load(spark, sf_dir):
    daily = loads.daily_load(loads.load_curve(activity_long(spark, sf_dir), ["user_id", "day"]), ["user_id", "day"])
    return daily.withColumn("daily_kwh", F.round("daily_kwh", 8)).withColumn("peak_kwh", F.round("peak_kwh", 8))


@query(f"""
WITH {LONG_SQL}
SELECT day, hour, count(*) FILTER (WHERE action = 'Cooking') AS n_cooking, count(*) FILTER (WHERE action = 'Watching-TV') AS n_watching_tv,
       count(*) FILTER (WHERE action NOT IN ('Cooking', 'Watching-TV')) AS n_other, round(sum(kwh), 8) AS kwh
FROM act GROUP BY day, hour""")
def activity_mix(spark, sf_dir):
    mix = loads.activity_mix(activity_long(spark, sf_dir), ["day"], ["Cooking", "Watching-TV"])
    return mix.withColumn("kwh", F.round("kwh", 8))


@query(f"""
WITH {LONG_SQL}
SELECT day, hour, count(*) FILTER (WHERE action NOT IN ('Commuting', 'At-school')) AS members_home,
       count(*) FILTER (WHERE action IN ('Commuting', 'At-school')) AS members_away
FROM act WHERE stream = 'member' GROUP BY day, hour""")
def occupancy_by_hour(spark, sf_dir):
    return loads.occupancy(activity_long(spark, sf_dir), ["day"])


def hourly_entries(spark, sf_dir):
    """At most one entry per document, stream, member and hour, so documents stay bounded."""
    long = activity_long(spark, sf_dir)
    return long.groupBy("user_id", "day", "stream", "member_id", "hour").agg(
        F.min_by("action", "event_id").alias("action"), F.sum("kwh").alias("kwh")
    )


def consumption_docs(spark, sf_dir):
    """One consumption document per user and day."""
    return nested.consumption_nested(hourly_entries(spark, sf_dir), ["user_id", "day"])


@query(f"""
WITH {LONG_SQL}
SELECT user_id, day, stream, member_id, hour, arg_min(action, event_id) AS action, round(sum(kwh), 8) AS kwh
FROM act GROUP BY user_id, day, stream, member_id, hour""")
def consumption_roundtrip(spark, sf_dir):
    again = nested.consumption_long(consumption_docs(spark, sf_dir), ["user_id", "day"])
    return again.withColumn("kwh", F.round("kwh", 8))


@query(f"""
WITH {LONG_SQL},
c AS (SELECT user_id, day, h AS hour, coalesce(sum(kwh) FILTER (WHERE hour = h), 0) AS kwh,
             count(DISTINCT member_id) FILTER (WHERE hour = h AND stream = 'member' AND action NOT IN ('Commuting', 'At-school')) AS home
      FROM act, (SELECT unnest(range(24)) AS h) GROUP BY user_id, day, h)
SELECT user_id, day, round(sum(kwh), 8) AS daily_kwh, round(max(kwh), 8) AS peak_kwh, arg_max(hour, (kwh, -hour)) AS peak_hour,
       string_agg(CAST(home AS VARCHAR), ',' ORDER BY hour) AS members_home
FROM c GROUP BY user_id, day""")
def document_loads(spark, sf_dir):
    out = plan.load_curves(consumption_docs(spark, sf_dir), ["user_id", "day"])
    return out.select(
        "user_id", "day", F.round("daily_kwh", 8).alias("daily_kwh"), F.round("peak_kwh", 8).alias("peak_kwh"), "peak_hour",
        F.array_join(F.transform("members_home", lambda n: n.cast("string")), ",").alias("members_home"),
    )


@query(f"""
WITH {LONG_SQL},
c AS (SELECT user_id, day, h AS hour, coalesce(sum(kwh) FILTER (WHERE hour = h), 0) AS kwh FROM act, (SELECT unnest(range(24)) AS h) GROUP BY ALL)
SELECT day, hour, round(avg(kwh), 14) AS kwh, count(*) AS documents FROM c GROUP BY day, hour""")
def mean_load_curve(spark, sf_dir):
    return plan.mean_curves(consumption_docs(spark, sf_dir), ["day"]).withColumn("kwh", F.round("kwh", 14))


def _by_user(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "user_id", "ts", "event_id", "event_type", "value", F.date_trunc("day", "ts").alias("day"), F.date_trunc("hour", "ts").alias("hour")
    )


@query("""
WITH m AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                   - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g FROM events)
SELECT user_id, min(event_id) AS event_id, event_type, count(*) AS run_length FROM m GROUP BY user_id, event_type, g""")
def repeat_runs(spark, sf_dir):
    out = ordered.runs(_by_user(spark, sf_dir), ["user_id"], ["ts", "event_id"], "event_type", ["day"])
    return out.select("user_id", "event_id", "event_type", "run_length")


@query("""
WITH h AS (SELECT user_id, event_type AS signal, date_trunc('hour', ts) AS hour, avg(value) AS v FROM events GROUP BY ALL),
p AS (SELECT *, lag(v) OVER (PARTITION BY user_id, signal ORDER BY hour) AS before FROM h)
SELECT user_id, signal, hour, round(abs(v - before), 8) AS jump FROM p WHERE abs(v - before) > 100""")
def hour_jumps(spark, sf_dir):
    e = _by_user(spark, sf_dir)
    hourly = e.groupBy("user_id", F.col("event_type").alias("signal"), "hour", "day").agg(F.avg("value").alias("v"))
    marked = ordered.neighbour(hourly, ["user_id", "signal"], ["hour"], ["v"], "before", ["day"])
    jump = F.abs(F.col("v") - F.col("before.v"))
    return marked.where(jump > 100).select("user_id", "signal", "hour", F.round(jump, 8).alias("jump"))
