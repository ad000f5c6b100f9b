"""Usage, cost and log pairing over call-like tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeload import dims
from homeload.functions import numbers as num
from homeload.operators import usage as u
from homeload.plans import usage as plan
from homeload.plans import usage_store
from homeload.queries.registry import ORACLES, query
from homeload.queries.tables import choose, sql_choose, table
from homeload.session import shared_folder

# Event types as roles: written in both word orders, one known by its model only, one unknown.
ROLE_OF = {
    "view": "generator", "click": "auditor_cultural", "purchase": "Physical_Auditor", "signup": None, "error": "observer",
}
MODEL_OF = {
    "view": "google/gemini-2.5-flash", "click": "meta-llama/Llama-4-Maverick-17B-128E-Instruct-FP8",
    "purchase": "anthropic/claude-4-sonnet", "signup": "Qwen/Qwen2.5-72B-Instruct", "error": "local/none",
}
PROVIDERS = ("deepinfra", "OpenRouter", "elsewhere")


def _case(column: str, mapping: dict) -> str:
    return "CASE " + column + " " + " ".join(
        f"WHEN '{k}' THEN {'NULL' if v is None else repr(v)}" for k, v in mapping.items()
    ) + " END"


def _mapped(column: str, mapping: dict):
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in mapping.items():
        out = out.when(F.col(column) == k, F.lit(v).cast("string"))
    return out


def calls(spark, sf_dir):
    """Events as call records; every eleventh lacks an input count."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        F.col("event_id").alias("id"), "ts", _mapped("event_type", ROLE_OF).alias("role"),
        _mapped("event_type", MODEL_OF).alias("model"), choose(F.col("event_id"), PROVIDERS).alias("provider"),
        F.col("value").alias("duration_seconds"), num.response_chars(F.col("props")).alias("response_chars"),
        F.when(F.col("event_id") % 11 != 0, F.col("event_id") % 5000 + 100).alias("tokens_in"),
        (k * 10).alias("tokens_out"),
    )


CALLS_SQL = f"""calls AS (
  SELECT event_id AS id, ts, {_case("event_type", ROLE_OF)} AS role, {_case("event_type", MODEL_OF)} AS model,
         {sql_choose("event_id", PROVIDERS)} AS provider, value AS duration_seconds, length(props) AS response_chars,
         CASE WHEN event_id % 11 != 0 THEN event_id % 5000 + 100 END AS tokens_in,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 10 AS tokens_out
  FROM events)"""
_MEMBERS = [(r.replace("_", " ").title(), m) for r, m in dims.ROLES]
_MEMBERS_SQL = "(VALUES " + ", ".join(
    f"('{r}', '{m}', '{' '.join(sorted(r.lower().split()))}')" for r, m in _MEMBERS
) + ") AS members(role, model, role_key)"
_RESOLVED = f"""
mem AS (SELECT * FROM {_MEMBERS_SQL}),
resolved AS (
  SELECT c.*, coalesce(r.role, m.role) AS member_role, coalesce(r.model, m.model) AS member_model
  FROM calls c
  LEFT JOIN mem r ON r.role_key = list_aggregate(list_sort(string_split(lower(replace(c.role, '_', ' ')), ' ')), 'string_agg', ' ')
  LEFT JOIN mem m ON m.model = c.model
  WHERE coalesce(r.role, m.role) IS NOT NULL)"""
_PRICES_SQL = "(VALUES " + ", ".join(map(str, dims.PRICES)) + ") AS prices(provider, model, rate_in, rate_out)"
_PRICED = f"""
priced AS (
  SELECT c.*, CASE WHEN coalesce(tokens_in, 0) > 0 AND coalesce(tokens_out, 0) > 0
           THEN (tokens_in * coalesce(rate_in, 1.0::DOUBLE) + tokens_out * coalesce(rate_out, 3.0::DOUBLE)) / 1e6 ELSE 0 END AS cost_total
  FROM {{source}} c LEFT JOIN (SELECT provider, model, rate_in::DOUBLE AS rate_in, rate_out::DOUBLE AS rate_out FROM {_PRICES_SQL}) p
    ON p.model = c.model AND p.provider = CASE WHEN lower(c.provider) IN ('deepinfra', 'openrouter') THEN lower(c.provider) ELSE 'deepinfra' END)"""


@query(f"""
WITH {CALLS_SQL}, {_RESOLVED},
s AS (SELECT member_role AS role, member_model AS model, count(*) AS calls, sum(duration_seconds) AS total_time,
             sum(response_chars) AS total_chars, sum(coalesce(tokens_in, 0)) AS tokens_in, sum(coalesce(tokens_out, 0)) AS tokens_out
      FROM resolved GROUP BY 1, 2)
SELECT mem.role, mem.model, coalesce(calls, 0)::BIGINT AS calls, round(coalesce(total_time, 0), 4) AS total_time,
       coalesce(total_chars, 0)::BIGINT AS total_chars, coalesce(tokens_in, 0)::BIGINT AS tokens_in,
       coalesce(tokens_out, 0)::BIGINT AS tokens_out
FROM mem LEFT JOIN s USING (role, model)""")
def usage_by_member(spark, sf_dir):
    c = calls(spark, sf_dir).withColumn("cost_total", F.lit(0.0))
    out = plan.usage_report(c, dims.ROLES, totals=False)
    return out.withColumn("total_time", F.round("total_time", 4)).drop("total_cost")


@query(f"""
WITH {CALLS_SQL}, {_RESOLVED}, {_PRICED.format(source="resolved")},
s AS (SELECT member_role AS role, member_model AS model, count(*) AS calls, sum(duration_seconds) AS total_time,
             sum(response_chars) AS total_chars, sum(coalesce(tokens_in, 0)) AS tokens_in, sum(coalesce(tokens_out, 0)) AS tokens_out,
             sum(cost_total) AS total_cost
      FROM priced GROUP BY 1, 2),
b AS (SELECT mem.role, mem.model, coalesce(calls, 0) AS calls, coalesce(total_time, 0) AS total_time, coalesce(total_chars, 0) AS total_chars,
             coalesce(tokens_in, 0) AS tokens_in, coalesce(tokens_out, 0) AS tokens_out, coalesce(total_cost, 0) AS total_cost
      FROM mem LEFT JOIN s USING (role, model)
      UNION ALL SELECT 'TOTAL', '', sum(calls), sum(total_time), sum(total_chars), sum(tokens_in), sum(tokens_out), sum(total_cost) FROM s)
SELECT role, model, calls::BIGINT AS calls, round(total_time, 4) AS total_time, total_chars::BIGINT AS total_chars,
       tokens_in::BIGINT AS tokens_in, tokens_out::BIGINT AS tokens_out, round(total_cost, 8) AS total_cost,
       CASE WHEN calls > 0 THEN round(total_time / calls, 8) ELSE 0 END AS avg_time,
       CASE WHEN calls > 0 THEN round(total_chars / calls, 8) ELSE 0 END AS avg_chars,
       CASE WHEN calls > 0 THEN round((tokens_in + tokens_out) / calls, 8) ELSE 0 END AS avg_tokens,
       CASE WHEN calls > 0 THEN round(total_cost / calls, 8) ELSE 0 END AS avg_cost
FROM b""")
def usage_cost_rollup(spark, sf_dir):
    return _rounded(plan.usage_report(plan.priced_calls(calls(spark, sf_dir)), dims.ROLES))


def _rounded(report):
    digits = {"total_time": 4, "total_cost": 8, "avg_time": 8, "avg_chars": 8, "avg_tokens": 8, "avg_cost": 8}
    return report.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(ORACLES["usage_cost_rollup"])
def usage_incremental(spark, sf_dir):
    """The same report from sums kept over four loads that overlap, the second one run again at the end."""
    folder, c, load = shared_folder(spark, "usage-sums"), plan.priced_calls(calls(spark, sf_dir)), F.col("id") % 4
    for number in (0, 1, 2, 3, 1):
        again = (load == number - 1) & (F.col("id") % 3 == 0)  # calls that come a second time
        usage_store.add_calls(c.where((load == number) | again), dims.ROLES, folder, number)
    return _rounded(usage_store.report(spark, folder, dims.ROLES))


@query(f"""
WITH {CALLS_SQL}, {_PRICED.format(source="calls")}
SELECT id, provider, model, round(cost_total, 10) AS cost_total, coalesce(tokens_in, 0) + coalesce(tokens_out, 0) AS tokens FROM priced""")
def call_costs(spark, sf_dir):
    c = plan.priced_calls(calls(spark, sf_dir))
    return c.select(
        "id", "provider", "model", F.round("cost_total", 10).alias("cost_total"),
        num.total_tokens(F.col("tokens_in"), F.col("tokens_out")).alias("tokens"),
    )


MODELS = [m for _, m in dims.ROLES]
_LOG_MODELS = (*MODELS[:4], "local/none")


def _log_events(spark, sf_dir):
    """Turns as log events: user turns call a model, assistant turns complete, system turns are noise."""
    c = table(spark, sf_dir, "conversations").where("role <> 'system'")
    model = choose(F.col("conv_id") + F.col("turn"), _LOG_MODELS)
    return c.select(
        "conv_id", "turn", F.when(F.col("role") == "user", model).alias("model"),
        F.when(F.col("role") != "user", F.length("text")).cast("bigint").alias("chars"),
        F.when(F.col("role") != "user", F.length("text") / 64).alias("seconds"), F.expr("turn div 1024").alias("block"),
    )


_EVENTS_SQL = f"""ev AS (
  SELECT conv_id, turn, CASE WHEN role = 'user' THEN {sql_choose("conv_id + turn", _LOG_MODELS)} END AS model,
         CASE WHEN role <> 'user' THEN length(text) END AS chars
  FROM conversations WHERE role <> 'system'),
paired AS (SELECT *, lag(model) OVER (PARTITION BY conv_id ORDER BY turn) AS called FROM ev),
done AS (SELECT conv_id, turn, called AS model, chars FROM paired WHERE model IS NULL AND called IN ({", ".join(repr(m) for m in MODELS)}))"""


@query(f"WITH {_EVENTS_SQL} SELECT conv_id, turn, model, chars FROM done")
def log_pairing(spark, sf_dir):
    paired = u.pair_events(_log_events(spark, sf_dir), ["conv_id"], ["turn"], ["block"], MODELS)
    return paired.select("conv_id", "turn", "model", "chars")


@query(f"""
WITH {_EVENTS_SQL}, mem AS (SELECT * FROM {_MEMBERS_SQL}),
b AS (SELECT mem.role, mem.model, count(chars) AS calls, coalesce(sum(chars), 0) AS total_chars FROM mem LEFT JOIN done USING (model) GROUP BY 1, 2
      UNION ALL SELECT 'TOTAL', '', count(*), sum(chars) FROM done)
SELECT role, model, calls, total_chars::BIGINT AS total_chars, round(total_chars / 64, 6) AS total_time,
       CASE WHEN calls > 0 THEN round(total_chars / calls, 8) ELSE 0 END AS avg_chars FROM b""")
def text_log_usage(spark, sf_dir):
    report = plan.text_log_report(_log_events(spark, sf_dir), dims.ROLES, ["conv_id"], ["turn"], ["block"])
    return report.select(
        "role", "model", "calls", "total_chars", F.round("total_time", 6).alias("total_time"), F.round("avg_chars", 8).alias("avg_chars")
    )


@query("""
SELECT conv_id, turn, lower(role) AS role_key, row_number() OVER (PARTITION BY lower(role) ORDER BY conv_id, turn) AS call_number
FROM conversations""")
def call_sequence(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.expr("conv_id div 256").alias("conv_block"), F.col("conv_id").alias("conv"),
        F.expr("turn div 1024").alias("turn_block"),
    )
    out = u.call_sequence(c, ["conv_id", "turn"], ["conv_block", "conv", "turn_block"])
    return out.select("conv_id", "turn", "role_key", "call_number")
