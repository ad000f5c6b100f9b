"""Conversation repair, n-gram join and ranked search over their whole tables, beside their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload.llm import jaccard_join, ranked_search, repair
from homeload.llm.common import attach
from homeload.llm.registry import query
from homeload.queries.tables import table

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage of the contract; a dropped row leaves nothing."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    hit = F.col("hit")
    return (
        rows.select(
            "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
            (F.crc32(key) % 20).alias("hit"),
        )
        .where(hit != 0)
        .select(
            "conv_id", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(hit == 1, "").when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )



def _state_sql(to: int) -> str:
    """Cheapest way into state ``to`` (0 start, 1 system, 2 user, 3 assistant) over the next row."""
    p = [f"p{s}" for s in range(4)]
    move = lambda src, cost, edit, role, said: (
        f"CASE WHEN {src} IS NOT NULL THEN {{'c': {src}.c + {cost}, 'a': {src}.a || '{edit}', 'r': "
        + (f"list_append({src}.r, {role} || ':' || {said})" if role else f"{src}.r") + "} END"
    )
    ways = [move(p[to], repair.DELETE_COST, "D", None, None)]
    free = lambda way, extra="": f"CASE WHEN fault NOT IN (1, 2){extra} THEN {way} END"
    broken = f"CASE WHEN fault = 3 THEN {repair.TRUNCATED_COST} ELSE 0 END"
    for source, initial in {0: [], 1: [(0, "s")], 2: [(0, "u"), (1, "u"), (3, "u")], 3: [(2, "a")]}[to]:
        ways.append(free(move(p[source], broken, "K", "role", "text"), f" AND substr(role, 1, 1) = '{initial}'"))
        if to > 1:
            name = {2: "user", 3: "assistant"}[to]
            ways.append(free(move(p[source], f"{repair.REROLE_COST} + {broken}", "R", f"'{name}'", "text")))
    return f"list_min([{', '.join(ways)}])"


def _inserted_sql(to: int, v: str) -> str:
    """The state as it is or by one inserted turn; two in a row never pay, as they only lead from a state to a less useful one."""
    name = {2: "user", 3: "assistant"}.get(to)
    sources = {0: [], 1: [], 2: [0, 1, 3], 3: [2]}[to]
    ways = [f"{v}{to}"] + [
        f"CASE WHEN {v}{s} IS NOT NULL THEN {{'c': {v}{s}.c + {repair.INSERT_COST}, 'a': {v}{s}.a || 'I', 'r': list_append({v}{s}.r, '{name}:')}} END"
        for s in sources
    ]
    return f"list_min([{', '.join(ways)}])"


_REPAIR_SQL = f"""
    WITH RECURSIVE raw AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             list_reduce(list_concat([4294967295], flatten(list_transform(
               string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
               lambda b: [CAST(ascii(b) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda c, z: CASE WHEN z >= 0 THEN xor(c, z) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
      FROM conversations
    ), hit AS (
      SELECT *, xor(c, 4294967295) % 20 AS hit FROM raw
    ), d AS (
      SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
             CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN hit = 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM hit WHERE hit <> 0
    ), n AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             count(*) OVER (PARTITION BY conv_id) AS rows FROM d
    ), f AS (
      SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1
                     WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                     WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 3 ELSE 0 END AS fault,
             substr(role, 1, 1) || substr(lead(role) OVER (PARTITION BY conv_id ORDER BY i), 1, 1) AS pair
      FROM n
    ), walk AS (
      SELECT DISTINCT conv_id, rows, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])}} AS v0,
             CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR[])) AS v1, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR[])) AS v2,
             CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR[])) AS v3
      FROM n
      UNION ALL
      SELECT conv_id, rows, i, {", ".join(f"{_state_sql(s)} AS v{s}" for s in range(4))}
      FROM (
        SELECT w.conv_id, w.rows, f.i, f.role, f.text, f.fault, {", ".join(f"{_inserted_sql(s, 'w.v')} AS p{s}" for s in range(4))}
        FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
      )
    ), best AS (
      SELECT conv_id, list_min([v0, {_inserted_sql(3, "v")}]) AS b FROM walk WHERE i = rows
    ), g AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 1) AS blank,
             count_if(fault = 2) AS duplicate, count_if(fault = 3) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM f GROUP BY conv_id
    )
    SELECT o.conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
           CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(array_to_string(b.r, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id"""


@query(_REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation, with all counts."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = attach(rows.select("conv_id").distinct(), repair.repair(damaged(rows)), ["conv_id"])
    lines = F.transform(F.coalesce("repaired", F.array()), lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    return done.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in repair.FIGURES], F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"),
    )


_JOIN_SQL = f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, row_number() OVER () AS k, regexp_extract_all({LOWERED}, '{WORD}') AS w FROM documents
    ), s AS (
      SELECT DISTINCT k, array_to_string(w[i : i + {jaccard_join.WORDS - 1}], ' ') AS g
      FROM d, unnest(range(1, greatest(2, len(w) - {jaccard_join.WORDS - 2}))) AS r(i) WHERE len(w) > 0
    ), n AS (
      SELECT k, count(*) AS n FROM s GROUP BY k
    ), e AS (
      SELECT a.k AS x, b.k AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.k <> b.k GROUP BY 1, 2
    ), l AS (
      SELECT x, y FROM e JOIN n p ON p.k = x JOIN n q ON q.k = y WHERE 100 * shared >= {jaccard_join.PERCENT} * (p.n + q.n - shared)
    ), c AS (
      SELECT k, k AS other FROM d
      UNION
      SELECT c.k, l.y FROM c JOIN l ON l.x = c.other
    )
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
    FROM d LEFT JOIN n USING (k)
    JOIN (SELECT c.k, min(o.doc_id) AS component_id FROM c JOIN d o ON o.k = c.other GROUP BY c.k) m USING (k)"""


@query(_JOIN_SQL)
def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document, by links of at least 80 % in five-word shingles."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


_SEARCH_SQL = f"""
    WITH d AS (
      SELECT doc_id, row_number() OVER () AS k, regexp_extract_all({LOWERED}, '{TERM}') AS w FROM documents
    ), i AS (
      SELECT item_id, row_number() OVER () AS q, regexp_extract_all({LOWERED}, '{TERM}') AS w FROM benchmark
    ), it AS (
      SELECT q, item_id, t, count(*) AS repeats FROM i, unnest(w) AS u(t) GROUP BY ALL
    ), dt AS (
      SELECT k, t, count(*) AS tf FROM d, unnest(w) AS u(t) WHERE t IN (SELECT t FROM it) GROUP BY ALL
    ), s AS (
      SELECT count_if(len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d
    ), wt AS (
      SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM (SELECT t, count(*) AS df FROM dt GROUP BY t), s
    ), m AS (
      SELECT k, doc_id, 100 - 75 + ((75 * len(w) * docs) // terms) AS m FROM d, s WHERE len(w) > 0
    ), sc AS (
      SELECT q, item_id, k, doc_id, CAST(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM it JOIN dt USING (t) JOIN wt USING (t) JOIN m USING (k) GROUP BY ALL
    ), r AS (
      SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM sc WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""


@query(_SEARCH_SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)
