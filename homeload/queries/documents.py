"""Answers, prompts, diffs, merges and nested round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeload.functions import text
from homeload.operators import alignment, merge, nested, verdict
from homeload.plans import requests as plan
from homeload.queries.registry import query
from homeload.queries.tables import choose, sql_choose, table
from homeload.sources import call_logs

FENCE = "```"


@query(rf"""
WITH a AS (SELECT event_id, CASE event_id % 9
    WHEN 0 THEN props WHEN 1 THEN 'Here you are: ' || props || ' - done' WHEN 2 THEN '{FENCE}json' || chr(10) || props || chr(10) || '{FENCE}'
    WHEN 3 THEN '<think>maybe {{x}} ]</think> ' || props WHEN 4 THEN '[' || props || ', ' || props || '] and {{more}}'
    WHEN 5 THEN 'sorry, no answer ' WHEN 6 THEN replace(props, '"', '''') WHEN 7 THEN '{FENCE}' || chr(10) || '[' || props || ']' || chr(10) || '{FENCE} tail }}'
    ELSE 'cut ] {{ "k": ' || event_id END AS answer, props, event_id % 9 AS c FROM events),
j AS (SELECT event_id, c, CASE c WHEN 0 THEN props WHEN 1 THEN props WHEN 2 THEN props WHEN 3 THEN props WHEN 4 THEN '[' || props || ', ' || props || ']'
    WHEN 5 THEN 'sorry, no answer' WHEN 6 THEN replace(props, '"', '''') WHEN 7 THEN '[' || props || ']' ELSE answer END AS json, props FROM a)
SELECT event_id, json, c IN (0, 1, 2, 3, 4, 7) AS readable,
       CASE WHEN c IN (0, 1, 2, 3) THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM j""")
def response_extract(spark, sf_dir):
    e, p = table(spark, sf_dir, "events"), F.col("props")
    forms = (
        p, F.concat(F.lit("Here you are: "), p, F.lit(" - done")), F.concat(F.lit(FENCE + "json\n"), p, F.lit("\n" + FENCE)),
        F.concat(F.lit("<think>maybe {x} ]</think> "), p), F.concat(F.lit("["), p, F.lit(", "), p, F.lit("] and {more}")),
        F.lit("sorry, no answer "), F.replace(p, F.lit('"'), F.lit("'")),
        F.concat(F.lit(FENCE + "\n["), p, F.lit("]\n" + FENCE + " tail }")),
        F.concat(F.lit('cut ] { "k": '), F.col("event_id").cast("string")),
    )
    case = F.col("event_id") % len(forms)
    answer = F.when(case == 0, forms[0])
    for i, form in enumerate(forms[1:], 1):
        answer = answer.when(case == i, form)
    answers = e.select("event_id", "props", answer.alias("answer"))
    out = plan.parse_answers(answers, "answer", "k INT", lambda c: F.get_json_object(c, "$.k").try_cast("int"))
    return out.select(
        "event_id", "json", text.is_json(F.col("json")).alias("readable"), F.col("parsed").alias("k")
    )


_SEV = ("LOW", "MEDIUM", "HIGH")


_REPORTS_SQL = f"""
a AS (SELECT event_id, event_id % 2 = 0 AS cultural, event_id % 7 AS c, {sql_choose("event_id", _SEV)} AS sev FROM events),
r AS (SELECT event_id, CASE WHEN cultural THEN 'cultural' ELSE 'physical' END AS auditor,
       CASE WHEN c < 3 THEN sev WHEN c = 5 THEN 'NONE' ELSE 'HIGH' END AS severity,
       CASE WHEN c < 3 THEN 'note ' || event_id WHEN c <> 5 THEN 'Failed to parse audit report' END AS first_note
FROM a)"""


def _reports(spark, sf_dir):
    """Each event as an auditor's answer in one of seven forms, parsed."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    cultural = k % 2 == 0
    note = F.array(F.concat(F.lit("note "), k.cast("string")))
    body = F.to_json(
        F.struct(
            F.when(cultural, note).alias("issue_descriptions"), F.when(~cultural, note).alias("violated_constraints"),
            choose(k, _SEV).alias("severity"),
        )
    )
    case = k % 7
    answer = (
        F.when(case == 0, body).when(case == 1, F.concat(F.lit(FENCE + "json\n"), body, F.lit("\n" + FENCE)))
        .when(case == 2, F.concat(F.lit("<think>hm</think>"), body)).when(case == 3, F.lit("cannot say"))
        .when(case == 4, F.concat(F.lit("["), body, F.lit("]"))).when(case == 5, F.lit('{"severity": "LOW", "severity": "NONE"}'))
        .otherwise(F.concat(F.lit("Sure "), body, F.lit(" but see {note}")))
    )
    answers = e.select("event_id", F.when(cultural, "cultural").otherwise("physical").alias("auditor"), answer.alias("answer"))
    return plan.audit_reports(answers, ["event_id"])


@query(f"WITH {_REPORTS_SQL} SELECT * FROM r")
def audit_answers(spark, sf_dir):
    first = F.coalesce(F.get("report.issue_descriptions", F.lit(0)), F.get("report.violated_constraints", F.lit(0)))
    return _reports(spark, sf_dir).select("event_id", "auditor", "report.severity", first.alias("first_note"))


@query(f"""
WITH {_REPORTS_SQL},
n AS (SELECT event_id // 2 AS doc, count(*) FILTER (WHERE severity = 'HIGH') AS auditors_high, count(*) FILTER (WHERE severity = 'MEDIUM') AS auditors_medium FROM r GROUP BY 1)
SELECT *, CASE WHEN auditors_high > 0 OR auditors_medium >= 2 THEN 'REGENERATE_FULL'
               WHEN auditors_medium = 1 THEN CASE WHEN doc % 2 = 0 THEN 'REGENERATE_FULL' ELSE 'REGENERATE_PARTIAL' END ELSE 'ACCEPT' END AS decision FROM n""")
def report_decision(spark, sf_dir):
    """Two auditors' answers per document become one decision."""
    reports = _reports(spark, sf_dir).withColumn("doc", F.expr("event_id div 2"))
    stage = F.when(F.col("doc") % 2 == 0, "stage3_consumption").otherwise("stage1_family")
    return verdict.decide_reports(reports, ["doc"], stage)


@query("""
SELECT event_id, CASE WHEN event_id % 4 < 2 THEN 'ACCEPT' ELSE 'REGENERATE_FULL' END AS decision,
       CASE WHEN event_id % 4 < 2 THEN 'fine' ELSE 'Failed to parse decision' END AS reason FROM events""")
def decision_answers(spark, sf_dir):
    """Decisions of model answers; text behind the object makes an answer unreadable."""
    case = F.col("event_id") % 4
    said = F.lit('{"decision": "ACCEPT", "reason": "fine"}')
    answer = (
        F.when(case == 0, said).when(case == 1, F.concat(F.lit(FENCE + "\n"), said, F.lit("\n" + FENCE)))
        .when(case == 2, F.concat(said, F.lit(" or {x}"))).otherwise(F.substring(said, 1, 20))
    )
    parsed = table(spark, sf_dir, "events").select("event_id", nested.parse_decision(answer).alias("d"))
    return parsed.select("event_id", "d.decision", "d.reason")


_TEMPLATE = "Plan for $name in ${country} ($segment), $unknown costs $$5. Again: $name$"


@query(f"""
WITH c AS (SELECT c_custkey, c_name, n_name, c_mktsegment,
    CASE WHEN c_custkey % 4 = 0 THEN 'Fix ' || c_name WHEN c_custkey % 4 = 1 THEN '' END AS guidance
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, 'Plan for ' || c_name || ' in ' || n_name || ' ($name is ' || c_mktsegment || '), $unknown costs $5. Again: ' || c_name || '$' ||
    CASE WHEN coalesce(guidance, '') <> '' THEN chr(10) || chr(10) || 'IMPORTANT GUIDANCE FOR REGENERATION:' || chr(10) || guidance ELSE '' END AS prompt,
  'unknown' AS unresolved,
  CASE WHEN c_custkey % 3 = 0 THEN '- No additional context' ELSE '- Family Id: ' || c_name || chr(10) || '- Country: ' || n_name END AS context
FROM c""")
def prompt_requests(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    empty = F.col("c_custkey") % 3 == 0
    context = F.create_map(
        F.lit("family_id"), F.when(empty, "").otherwise(F.col("c_name")), F.lit("season"), F.lit(""),
        F.lit("country"), F.when(~empty, F.col("n_name")),
    )
    guidance = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("Fix "), "c_name")).when(F.col("c_custkey") % 4 == 1, "")
    variables = {
        "name": F.col("c_name"), "country": F.col("n_name"), "segment": F.concat(F.lit("$name is "), "c_mktsegment"),
    }
    out = plan.requests(c, _TEMPLATE, variables, guidance)
    return out.select(
        "c_custkey", "prompt", F.array_join("unresolved", ",").alias("unresolved"), text.context_block(context).alias("context")
    )


@query("""
WITH d AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
    CASE WHEN c_custkey % 5 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS new_nation,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS new_segment FROM customer)
SELECT c_custkey, 'home.nation' AS path, CAST(c_nationkey AS VARCHAR) AS old_value, CAST(new_nation AS VARCHAR) AS new_value FROM d WHERE c_nationkey <> new_nation
UNION ALL SELECT c_custkey, 'segment', c_mktsegment, new_segment FROM d WHERE new_segment IS NULL
UNION ALL SELECT c_custkey, 'members[1].role', NULL, 'Guest' FROM d WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey, 'members[1].n', NULL, '2' FROM d WHERE c_custkey % 3 = 0""")
def document_diff(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")

    def version(nation, segment, members):
        return F.struct(
            F.col("c_name").alias("name"), F.struct(nation.alias("nation")).alias("home"), segment.alias("segment"),
            members.alias("members"),
        )

    first = F.array(F.struct(F.lit("Owner").alias("role"), F.lit(1).alias("n")))
    two = F.concat(first, F.array(F.struct(F.lit("Guest").alias("role"), F.lit(2).alias("n"))))
    nation, segment = F.col("c_nationkey"), F.col("c_mktsegment")
    pairs = c.select(
        "c_custkey", version(nation, segment, first).alias("old"),
        version(
            F.when(k % 5 == 0, nation + 1).otherwise(nation), F.when(k % 7 != 0, segment),
            F.when(k % 3 == 0, two).otherwise(first),
        ).alias("new"),
    )
    return nested.document_diff(pairs, ["c_custkey"], "old", "new")


@query("""
WITH v AS (SELECT doc_id, text AS a, replace(text, ' de ', ' DE ') || CASE WHEN doc_id % 10 = 0 THEN chr(10) || 'added' ELSE '' END AS b FROM documents),
o AS (SELECT doc_id, unnest(string_split(a, chr(10))) AS old_line, generate_subscripts(string_split(a, chr(10)), 1) - 1 AS line_no FROM v),
n AS (SELECT doc_id, unnest(string_split(b, chr(10))) AS new_line, generate_subscripts(string_split(b, chr(10)), 1) - 1 AS line_no FROM v)
SELECT doc_id, line_no, old_line, new_line FROM o FULL JOIN n USING (doc_id, line_no) WHERE old_line IS DISTINCT FROM new_line""")
def text_edit_diff(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("old"))
    edited = F.concat(
        F.replace("old", F.lit(" de "), F.lit(" DE ")), F.when(F.col("doc_id") % 10 == 0, "\nadded").otherwise("")
    )
    return nested.text_diff(d.withColumn("new", edited), ["doc_id"], "old", "new")


@query("""
WITH o AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderkey % 7 = 0 AS gone, o_orderkey % 5 = 0 AND o_orderkey % 7 <> 0 AS edited,
                  o_orderkey % 11 = 0 AND o_orderkey % 7 <> 0 AS extra FROM orders),
g AS (SELECT *, NOT gone AND NOT edited AS same, row_number() OVER w - 1 AS old_no,
             coalesce(sum(CASE WHEN gone OR edited THEN 0 ELSE 1 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gap,
             coalesce(sum(CASE WHEN gone THEN 0 WHEN extra THEN 2 ELSE 1 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS new_at
      FROM o WINDOW w AS (PARTITION BY c ORDER BY k)),
olds AS (SELECT c, gap, row_number() OVER (PARTITION BY c, gap ORDER BY k) AS i, old_no, 'order ' || k AS old_line FROM g WHERE NOT same),
lines AS (SELECT c, gap, new_at AS new_no, 'before ' || k AS new_line FROM g WHERE extra
          UNION ALL SELECT c, gap, new_at + CASE WHEN extra THEN 1 ELSE 0 END, 'edited ' || k FROM g WHERE edited),
news AS (SELECT *, row_number() OVER (PARTITION BY c, gap ORDER BY new_no) AS i FROM lines)
SELECT c AS o_custkey, CAST(old_no AS INTEGER) AS old_no, CAST(new_no AS INTEGER) AS new_no, old_line, new_line FROM olds FULL JOIN news USING (c, gap, i)""")
def text_alignment_diff(spark, sf_dir):
    """A line per order; in the second version some are gone, some are edited and some have a line before them."""
    k = F.col("o_orderkey")
    name = lambda word, key: F.concat(F.lit(f"{word} "), key.cast("string"))

    def after(key):
        line = F.array(F.when(key % 5 == 0, name("edited", key)).otherwise(name("order", key)))
        return F.when(key % 7 == 0, F.array().cast("array<string>")).when(key % 11 == 0, F.concat(F.array(name("before", key)), line)).otherwise(line)

    texts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(k)).alias("keys")).select(
        "o_custkey", F.array_join(F.transform("keys", lambda x: name("order", x)), "\n").alias("old"),
        F.nullif(F.array_join(F.flatten(F.transform("keys", after)), "\n"), F.lit("")).alias("new"),
    )
    return alignment.aligned_diff(texts, ["o_custkey"], "old", "new")


_BLANK = r"[\s\v\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(f"""
WITH l AS (SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line FROM documents)
SELECT DISTINCT regexp_replace(line, '^{_BLANK}|{_BLANK}$', '', 'g') AS line FROM l
WHERE regexp_replace(line, '^{_BLANK}|{_BLANK}$', '', 'g') <> ''""")
def rule_lines_merge(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    english = merge.text_lines(d.where("lang = 'en'"), "text")
    other = merge.text_lines(d.where("lang <> 'en'"), "text")
    return merge.distinct_lines(merge.union_all([english, other]))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS VARCHAR) AS priority, 'old' AS run FROM orders WHERE o_orderdate < '1998-01-01'
UNION ALL SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR), o_orderpriority, 'fresh' FROM orders WHERE o_orderdate >= '1997-06-01'""")
def union_runs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    old = o.where("o_orderdate < '1998-01-01'").select("o_orderkey", "o_custkey", "o_orderstatus", F.lit("old").alias("run"))
    fresh = o.where("o_orderdate >= '1997-06-01'").select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority"), F.lit("fresh").alias("run")
    )
    return merge.union_all([old, fresh])


@query("""
WITH x AS (SELECT *, event_id % 6 AS c FROM events)
SELECT event_id, event_type AS model, CAST(json_extract_string(props, '$.k') AS BIGINT) AS tokens_input
FROM x WHERE c IN (0, 1, 2, 5) UNION ALL SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) FROM x WHERE c = 5""")
def log_repair(spark, sf_dir):
    """Each event as the text of a small call log in one of six states of completion."""
    e, case = table(spark, sf_dir, "events"), F.col("event_id") % 6
    entry = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("model"),
            F.lit("line\nbreak ]").alias("response"),
            F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("input")).alias("tokens"),
        )
    )
    content = (
        F.when(case == 0, F.concat(F.lit("[\n"), entry, F.lit("\n]"))).when(case == 1, F.concat(F.lit("[\n"), entry))
        .when(case == 2, F.concat(F.lit("[\n"), entry, F.lit(",\n")))
        .when(case == 3, F.concat(F.lit("[\n"), F.substring(entry, F.lit(1), F.length(entry) - 5)))
        .when(case == 4, F.lit("["))
        .otherwise(F.concat(F.lit("[\n"), entry, F.lit(",\n"), entry, F.lit(" ")))
    )
    calls = e.select("event_id", F.explode(call_logs.parsed_calls(content)).alias("c"))
    return calls.select("event_id", "c.model", F.col("c.tokens.input").alias("tokens_input"))


@query("""
SELECT c_custkey AS doc, i AS item, CAST(c_nationkey + i AS BIGINT) AS n, c_mktsegment AS season
FROM customer, (SELECT unnest(range(3)) AS i) WHERE c_custkey % 3 < 2 OR i = 0""")
def sequence_unwrap(spark, sf_dir):
    """Documents that are a list, ``{"sequence": [...]}`` or one object."""
    c = table(spark, sf_dir, "customer")
    items = F.transform(
        F.sequence(F.lit(0), F.lit(2)),
        lambda i: F.struct(i.alias("item"), (F.col("c_nationkey") + i).cast("bigint").alias("n"), F.col("c_mktsegment").alias("season")),
    )
    case = F.col("c_custkey") % 3
    doc = (
        F.when(case == 0, F.to_json(items)).when(case == 1, F.to_json(F.struct(items.alias("sequence"))))
        .otherwise(F.to_json(F.get(items, F.lit(0))))
    )
    rows = c.select(F.col("c_custkey").alias("doc"), F.explode(nested.sequence_items(doc, "item INT, n BIGINT, season STRING")).alias("i"))
    return rows.select("doc", "i.*")


