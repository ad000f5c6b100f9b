"""Readers and writers of files, run over files that Spark writes from the tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from homeload import dims
from homeload.operators import ordered
from homeload.plans import merge
from homeload.plans import requests as request_plan
from homeload.plans import tasks as task_plan
from homeload.plans import usage as usage_plan
from homeload.queries.registry import query
from homeload.queries.tables import HOURLY_SQL, choose, hourly_weather, sql_choose, table
from homeload.queries.usage import _LOG_MODELS, _MEMBERS_SQL, MODELS
from homeload.session import shared_folder
from homeload.sources import call_logs, documents, item_store, sinks, split_logs, weather

CHUNK = 256
RESPONSE = "line\nbreak ]"


def _write_texts(df, column: str, path: str) -> None:
    """Every text a file of its own."""
    df.select(column).write.option("maxRecordsPerFile", 1).text(path)


def _listed(entry: Column, df, key: str):
    """``chunk, n, entries``: entries of at most ``CHUNK`` neighbouring keys as one text, joined by comma and line break."""
    chunks = df.select(F.expr(f"{key} div {CHUNK}").alias("chunk"), F.struct(F.col(key).alias("k"), entry.alias("entry")).alias("e"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["entry"]), ",\n")
    return chunks.groupBy("chunk").agg(joined.alias("entries"))


def _by_case(case: Column, forms) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, form in enumerate(forms):
        out = out.when(case == i, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in form]))
    return out


def _event_files(spark, sf_dir) -> str:
    """Events as JSON files: good, text behind the value, two values, a repeated key, cut short."""
    e = table(spark, sf_dir, "events")
    one = F.to_json(F.struct("event_id", "user_id", "event_type"))
    files = _listed(one, e, "event_id")
    x = F.col("entries")
    twice = F.replace(x, F.lit('"user_id":'), F.lit('"user_id":-1,"user_id":'))
    forms = (("[", x, "]"), ("[", x, "] oops"), ("[", x, "]\n[", x, "]"), ("[", twice, "]"), ("[", x))
    folder = shared_folder(spark, "event-files")
    _write_texts(files.select(_by_case(F.col("chunk") % len(forms), forms).alias("body")), "body", folder)
    return folder


@query(f"SELECT event_id, user_id, event_type FROM events WHERE event_id // {CHUNK} % 5 IN (0, 3)")
def document_files(spark, sf_dir):
    """Only files that are exactly one JSON value give rows."""
    return documents.read_documents(spark, _event_files(spark, sf_dir), "event_id BIGINT, user_id BIGINT, event_type STRING")


@query(f"SELECT c % 5 IN (0, 3) AS valid, count(*) AS files FROM (SELECT DISTINCT event_id // {CHUNK} AS c FROM events) GROUP BY 1")
def finished_file_validity(spark, sf_dir):
    found = documents.finished_files(spark, _event_files(spark, sf_dir), "*.txt")
    return found.groupBy("valid").agg(F.count_distinct("path").alias("files"))


def _call_logs(spark, sf_dir, folder: str) -> None:
    """Events as call logs: whole, open, open behind a comma, and in five states that cannot be read."""
    e = table(spark, sf_dir, "events")
    entry = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"), choose(F.col("event_id"), _LOG_MODELS).alias("model"), F.lit(RESPONSE).alias("response"),
            F.struct((F.col("event_id") % 100).alias("input"), F.lit(2).alias("output")).alias("tokens"),
        )
    )
    x = F.col("entries")
    forms = (
        ("[\n", x, "\n]"), ("[\n", x), ("[\n", x, ",\n"), ("[\n", x, ",\n{"), ("[", x, ",,", x, "]"), ("[", x, "][", x, "]"),
        ("[", x, "],\n", x, "]"), ("[\n", x, "\n]\nnote"),
    )
    body = _by_case(F.col("chunk") % len(forms), forms).alias("body")
    _write_texts(_listed(entry, e, "event_id").select(body), "body", folder)


_READABLE = f"SELECT * FROM events WHERE event_id // {CHUNK} % 8 IN (0, 1, 2)"


@query(f"SELECT CAST(event_id AS VARCHAR) AS id, {sql_choose('event_id', _LOG_MODELS)} AS model, event_id % 100 AS tokens_in FROM ({_READABLE})")
def call_log_files(spark, sf_dir):
    folder = shared_folder(spark, "call-logs")
    _call_logs(spark, sf_dir, folder)
    return call_logs.read_call_logs(spark, folder).select("id", "model", F.col("tokens.input").alias("tokens_in"))


SPLITS = (4096, 30_000, 1 << 27)


@query(f"""
SELECT s AS split_bytes, CAST(event_id AS VARCHAR) AS id, {sql_choose('event_id', _LOG_MODELS)} AS model, response, event_id % 100 AS tokens_in
FROM ({_READABLE}), (SELECT unnest({list(SPLITS)}) AS s), (SELECT 'line' || chr(10) || 'break ]' AS response)""")
def call_log_split(spark, sf_dir):
    """Logs read in splits of three sizes; every size gives the rows of the whole logs."""
    folder, out = shared_folder(spark, "call-logs"), []
    _call_logs(spark, sf_dir, folder)
    for size in SPLITS:
        calls = split_logs.read_split_logs(spark, folder, size)
        out.append(calls.select(F.lit(size).alias("split_bytes"), "id", "model", "response", F.col("tokens.input").alias("tokens_in")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def _text_log(spark, sf_dir, path: str) -> None:
    """Turns as lines of text logs, one log per block of conversations."""
    c = table(spark, sf_dir, "conversations").where("role IN ('user', 'assistant')")
    said = F.coalesce(F.length("text"), F.lit(0))
    model = choose(F.col("conv_id") + F.col("turn"), _LOG_MODELS)
    event = F.when(F.col("role") == "user", F.concat(F.lit("Calling deepinfra with model "), model)).otherwise(
        F.concat(F.lit("Successfully generated "), said.cast("string"), F.lit(" characters in "), (said / 64).cast("string"), F.lit("s"))
    )
    lines = c.select(
        F.expr("conv_id div 64").alias("log"), "conv_id", "turn", F.concat(F.lit("2026-01-01 00:00:00,000 - client - INFO - "), event).alias("line")
    )
    ordered = lines.repartition("log").sortWithinPartitions("log", "conv_id", "turn")
    ordered.select("log", "line").write.partitionBy("log").text(path)


@query(f"""
WITH mem AS (SELECT * FROM {_MEMBERS_SQL}),
r AS (SELECT {sql_choose('event_id', _LOG_MODELS)} AS model, event_id % 100 AS tokens FROM ({_READABLE})),
done AS (SELECT * FROM r WHERE model IN ({", ".join(map(repr, MODELS))})),
turns AS (SELECT conv_id // 64 AS log, conv_id, turn, role, coalesce(length(text), 0) AS chars,
                 CASE WHEN role = 'user' THEN {sql_choose('conv_id + turn', _LOG_MODELS)} END AS model
          FROM conversations WHERE role IN ('user', 'assistant')),
paired AS (SELECT role, chars, lag(model) OVER (PARTITION BY log ORDER BY conv_id, turn) AS model FROM turns),
said AS (SELECT model, chars FROM paired WHERE role = 'assistant' AND model IN ({", ".join(map(repr, MODELS))}))
SELECT 'json' AS run, role, model, count(tokens) AS calls, coalesce(sum(tokens), 0)::BIGINT AS tokens_in, ({len(RESPONSE)} * count(tokens))::BIGINT AS total_chars
FROM mem LEFT JOIN done USING (model) GROUP BY 2, 3
UNION ALL SELECT 'json', 'TOTAL', '', count(*), coalesce(sum(tokens), 0)::BIGINT, {len(RESPONSE)} * count(*) FROM done
UNION ALL SELECT 'text', role, model, count(chars), 0, coalesce(sum(chars), 0)::BIGINT FROM mem LEFT JOIN said USING (model) GROUP BY 2, 3
UNION ALL SELECT 'text', 'TOTAL', '', count(*), 0, coalesce(sum(chars), 0)::BIGINT FROM said""")
def run_report(spark, sf_dir):
    """Reports of two run folders: one has both kinds of logs and takes the JSON ones, one only a text log."""
    both, live = shared_folder(spark, "run-both"), shared_folder(spark, "run-live")
    _call_logs(spark, sf_dir, f"{both}/logs/api_calls_1.json")
    for folder in (both, live):
        _text_log(spark, sf_dir, f"{folder}/pipeline.log")

    def report(name, folder):
        found = usage_plan.run_report(spark, folder, dims.ROLES)
        return found.select(F.lit(name).alias("run"), "role", "model", "calls", "tokens_in", "total_chars")

    return report("json", both).unionByName(report("text", live))


@query(f"""
SELECT c_custkey, c_mktsegment FROM customer WHERE NOT (c_custkey % 3 = 2 AND c_custkey // {CHUNK} % 2 = 0)""")
def merged_run_folders(spark, sf_dir):
    """One stage file over run folders; a missing folder and broken files are left out."""
    root, c = shared_folder(spark, "runs"), table(spark, sf_dir, "customer")
    folders = [f"{root}/run{r}" for r in range(4)]  # the last one does not exist
    for r in range(3):
        files = _listed(F.to_json(F.struct("c_custkey", "c_mktsegment")), c.where(F.col("c_custkey") % 3 == r), "c_custkey")
        broken = (F.lit(r) == 2) & (F.col("chunk") % 2 == 0)
        body = F.concat(F.lit("["), "entries", F.when(broken, "").otherwise("]"))
        _write_texts(files.select(body.alias("body")), "body", f"{folders[r]}/stage1_families.json")
    return merge.merge_runs(spark, folders, "stage1_families.json", "c_custkey BIGINT, c_mktsegment STRING")


@query("SELECT DISTINCT '- [RULE: ' || c_mktsegment || '] nation ' || c_nationkey AS line FROM customer")
def merged_rule_files(spark, sf_dir):
    """Rule files of three runs with blank lines and trailing spaces, merged."""
    root, c = shared_folder(spark, "rules"), table(spark, sf_dir, "customer")
    line = F.concat(F.lit("- [RULE: "), "c_mktsegment", F.lit("] nation "), F.col("c_nationkey").cast("string"))
    folders = [f"{root}/run{r}" for r in range(4)]
    for r in range(3):
        lines = c.where(F.col("c_custkey") % 3 == r).select(F.concat(line, F.lit("  \n" if r else "")).alias("line"))
        lines.write.text(f"{folders[r]}/knowledge_base.txt")
    return merge.merge_rule_bases(spark, folders)


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def item_sink(spark, sf_dir):
    """Finished items written twice, as after a retry, and read once."""
    out = shared_folder(spark, "items")
    items = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for _ in range(2):
        item_store.write_items(items, out, ["o_orderkey"], batch=0)
    return item_store.read_items(spark, out, items.schema)


@query("""
SELECT o_custkey, o_orderstatus, arg_max(o_orderkey, (o_orderkey % 3, o_orderkey)) AS o_orderkey, arg_max(o_totalprice, (o_orderkey % 3, o_orderkey)) AS o_totalprice
FROM orders GROUP BY 1, 2""")
def item_upsert(spark, sf_dir):
    """Three overlapping batches of items, the second one run again at the end: the newest per key, nothing else lost."""
    out = shared_folder(spark, "item-upserts")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    for batch in (0, 1, 2, 1):
        items = ordered.latest(orders.where(F.col("o_orderkey") % 3 == batch), ["o_custkey", "o_orderstatus"], ["o_orderkey"])
        item_store.write_items(items, out, ["o_custkey", "o_orderstatus"], batch, buckets=16)
    return item_store.read_items(spark, out, orders.schema)


@query("SELECT o_orderkey, o_orderstatus, 'families.json' AS stage1_source_file, CAST(NULL AS VARCHAR) AS stage2_source_file FROM orders")
def combined_sink(spark, sf_dir):
    """All outputs in one data set, stamped with the file they came from."""
    out = shared_folder(spark, "combined")
    made = sinks.with_lineage(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "runs/a/families.json", None)
    sinks.write_combined(made, out)
    return spark.read.schema(made.schema).json(out)


@query(f"""
SELECT role AS "Role", model AS "Model", count(tokens)::INT AS "Calls", ({len(RESPONSE)} * count(tokens))::BIGINT AS "Total Chars"
FROM (SELECT * FROM {_MEMBERS_SQL}) AS m LEFT JOIN (SELECT {sql_choose('event_id', _LOG_MODELS)} AS model, event_id AS tokens FROM ({_READABLE})) AS r USING (model)
GROUP BY 1, 2""")
def statistics_file(spark, sf_dir):
    """The statistics of a run as sorted CSV, read back."""
    logs, out = shared_folder(spark, "call-logs"), shared_folder(spark, "statistics")
    _call_logs(spark, sf_dir, logs)
    report = usage_plan.usage_report(usage_plan.flat_calls(call_logs.read_call_logs(spark, logs)), dims.ROLES)
    sinks.write_statistics(report, out)
    read = spark.read.option("header", True).csv(out)
    return read.select("Role", "Model", F.col("Calls").cast("int").alias("Calls"), F.col("Total Chars").cast("bigint").alias("Total Chars"))


@query(f"""
WITH {HOURLY_SQL}
SELECT country, year(ts) AS year, count(*) AS hours, count(temp_air) AS temp_air, count(dni) AS dni, min(ts) AS first_hour, max(ts) AS last_hour
FROM hourly GROUP BY 1, 2""")
def weather_table(spark, sf_dir):
    """Hourly records kept by country and year, read back."""
    out = shared_folder(spark, "weather")
    hourly = hourly_weather(spark, sf_dir).withColumn("ghi", F.lit(None).cast("double"))
    weather.write_weather_table(hourly.select("ts", *weather.SIGNALS, "country"), out)
    read = weather.read_weather_table(spark, out)
    return read.groupBy("country", "year").agg(
        F.count("*").alias("hours"), F.count("temp_air").alias("temp_air"), F.count("dni").alias("dni"),
        F.min("ts").alias("first_hour"), F.max("ts").alias("last_hour"),
    )


@query("""
WITH c AS (SELECT c_custkey, c_name, CASE c_custkey % 4 WHEN 0 THEN 'no pets' WHEN 1 THEN '  # later' WHEN 2 THEN '' END AS criteria FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'Check ' || c_name || ': no pets / - Name: ' || c_name END AS prompt,
       CASE WHEN c_custkey % 4 <> 0 THEN 'NONE' END AS severity FROM c""")
def audit_prompts(spark, sf_dir):
    """Audits without criteria are not asked."""
    case = F.col("c_custkey") % 4
    criteria = F.when(case == 0, "no pets").when(case == 1, "  # later").when(case == 2, "")
    context = F.create_map(F.lit("name"), F.col("c_name"), F.lit("season"), F.lit(""))
    out = request_plan.audit_requests(
        table(spark, sf_dir, "customer"), "Check ${name}: $criteria / $context", {"name": F.col("c_name")}, context, criteria
    )
    return out.select("c_custkey", "prompt", "severity")


@query("""
WITH done AS (SELECT year(o_orderdate) AS run, o_orderkey % 7 AS variant FROM orders GROUP BY 1, 2 HAVING count(DISTINCT o_custkey) >= 20)
SELECT x.run, v::INT AS variant FROM (SELECT DISTINCT year(o_orderdate) AS run FROM orders) AS x, (SELECT unnest(range(1, 8)) AS v)
WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.run = x.run AND done.variant = v)""")
def standard_family_tasks(spark, sf_dir):
    """One call per run and variant, less the variants with enough households."""
    o = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("run"), (F.col("o_orderkey") % 7).alias("variant"), F.col("o_custkey").alias("household_id")
    )
    left = task_plan.standard_family_tasks(o.select("run").distinct(), ["run"], 7, 20, o)
    return left.select("run", "variant")
