"""Task grids, ids, keys of finished work and run bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeload import dims
from homeload.functions import calendar as cal
from homeload.functions import keys as key
from homeload.functions import text
from homeload.operators import ordered
from homeload.operators import tasks as t
from homeload.plans import tasks as plan
from homeload.queries.registry import ORACLES, query
from homeload.queries.tables import choose, season_sql, sql_choose, table

VARIANTS = 4


def _values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(repr(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {columns}"


_RUNS = "runs AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)"
_COMBOS = (
    "combos AS (SELECT p_size % 5 + 1 AS people_code, length(p_name) % 5 + 1 AS house_code, "
    "CAST(p_partkey % 3 + 1 AS INTEGER) AS composition_code FROM part GROUP BY 1, 2, 3 HAVING avg(p_size) >= 26)"
)
_GRID = f"""grid AS (
  SELECT c_nationkey, c_mktsegment, h.id AS house_code, p.id AS people_code, c.id AS composition_code, v.variant,
         'H' || h.id || '_P' || p.id || '_C' || c.id || '_E' || e.id AS combo_code,
         h.name AS house_type, p.name AS num_people, c.name AS composition, e.name AS employment_status
  FROM runs, {_values(dims.HOUSE_TYPES, "h(id, name)")}, {_values(dims.PEOPLE_COUNTS, "p(id, name)")},
       {_values(dims.COMPOSITIONS, "c(id, name)")}, (SELECT unnest(range(1, {VARIANTS + 1}))::INTEGER AS variant) v,
       {_values(dims.EMPLOYMENT_STATUSES, "e(id, name)")}
  WHERE e.id = (v.variant - 1) % 4 + 1
    AND (p.id, h.id, c.id) IN (SELECT (people_code, house_code, composition_code) FROM combos)
)"""


def _runs(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()


def _combos(spark, sf_dir):
    """Combinations whose parts are large on average, as the representative list."""
    return table(spark, sf_dir, "part").groupBy(
        (F.col("p_size") % 5 + 1).alias("people_code"), (F.length("p_name") % 5 + 1).alias("house_code"),
        (F.col("p_partkey") % 3 + 1).cast("int").alias("composition_code"),
    ).agg(F.avg("p_size").alias("size")).where("size >= 26")


@query(f"WITH {_RUNS}, {_COMBOS}, {_GRID} SELECT * FROM grid")
def task_grid(spark, sf_dir):
    grid = t.demographic_grid(_runs(spark, sf_dir), ["c_nationkey", "c_mktsegment"], VARIANTS)
    return t.representative(grid, _combos(spark, sf_dir))


_CODE = (
    "'H' || (o_orderkey % 5 + 1) || '_P' || (o_custkey % 5 + 1) || '_C' || (o_orderkey % 3 + 1) || '_E' || (o_custkey % 4 + 1)"
)


@query(f"""
WITH {_RUNS}, {_COMBOS}, {_GRID},
done AS (SELECT c_nationkey, c_mktsegment, {_CODE} AS combo_code, CAST(o_custkey % 4 + 1 AS INTEGER) AS variant
         FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT c_nationkey, c_mktsegment, combo_code, variant, true AS seed_ok FROM grid
WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.c_nationkey = grid.c_nationkey AND d.c_mktsegment = grid.c_mktsegment
                  AND d.combo_code = grid.combo_code AND d.variant = grid.variant)""")
def family_tasks_remaining(spark, sf_dir):
    code = F.concat(
        F.lit("H"), F.col("o_orderkey") % 5 + 1, F.lit("_P"), F.col("o_custkey") % 5 + 1,
        F.lit("_C"), F.col("o_orderkey") % 3 + 1, F.lit("_E"), F.col("o_custkey") % 4 + 1,
    )
    done = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select("c_nationkey", "c_mktsegment", code.alias("combo_code"), (F.col("o_custkey") % 4 + 1).cast("int").alias("variant"))
    left = plan.family_tasks(
        _runs(spark, sf_dir), ["c_nationkey", "c_mktsegment"], VARIANTS, _combos(spark, sf_dir), done
    )
    return left.select(
        "c_nationkey", "c_mktsegment", "combo_code", "variant", F.col("seed").between(1, 999999).alias("seed_ok")
    )


_SEASONS = ("summer", "winter", "spring", "autumn")


@query(f"""
WITH runs AS (SELECT DISTINCT o_custkey AS run FROM orders),
done AS (SELECT DISTINCT o_custkey AS run, CAST(o_orderkey % 3 + 1 AS INTEGER) AS variant, lower({season_sql("o_orderdate")}) AS season FROM orders)
SELECT run, variant, season FROM runs, (SELECT unnest(range(1, 4))::INTEGER AS variant) v,
     (SELECT unnest({list(_SEASONS)}) AS season) s
EXCEPT SELECT run, variant, season FROM done""")
def weather_tasks_remaining(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    runs = o.select(F.col("o_custkey").alias("run")).distinct()
    done = o.select(
        F.col("o_custkey").alias("run"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("variant"),
        F.lower(cal.season_of(F.col("o_orderdate"))).alias("season"),
    )
    return plan.weather_tasks(runs, ["run"], 3, _SEASONS, done).select("run", "variant", "season")


def _families(spark, sf_dir):
    """Customers as families of the run of their nation, numbered in key order."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("run"), "c_custkey", F.col("c_name").alias("household_id"),
        F.expr("c_custkey div 1024").alias("block"),
    )
    return t.index_families(c, ["c_custkey"], ["block"], ["run"])


def _profiles(spark, sf_dir):
    """Season-years with orders as weather profiles of a run; every third states its day type."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("run"))
    seen = table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), cal.season_of(F.col("o_orderdate")).alias("season")
    )
    p = seen.join(c, "o_custkey").select("run", "year", "season").distinct()
    third = F.col("year") % 3
    p = p.withColumn("date_type", F.when(third == 0, "weekend")).withColumn("day_name", F.when(third == 1, "Tuesday"))
    return t.index_profiles(p, ["year"], ["run"])


_FAMILIES = (
    "families AS (SELECT c_nationkey AS run, c_custkey, c_name AS household_id, "
    "row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS family_index FROM customer), "
    "fam AS (SELECT *, 'f' || CASE WHEN family_index < 10 THEN '0' ELSE '' END || family_index AS family_file_id FROM families)"
)
_PROFILES = f"""prof0 AS (SELECT DISTINCT c_nationkey AS run, year(o_orderdate) AS year, {season_sql("o_orderdate")} AS season
          FROM orders JOIN customer ON o_custkey = c_custkey),
profiles AS (SELECT *, row_number() OVER (PARTITION BY run, season ORDER BY year) AS profile FROM prof0)"""
_TYPES = """CASE year % 3 WHEN 0 THEN ['weekend'] WHEN 1 THEN ['weekday'] ELSE ['weekday', 'weekend'] END"""
_FANOUT = f"""tasks AS (
  SELECT run, family_file_id, household_id, season, profile, unnest({_TYPES}) AS day_type, 1 AS variant
  FROM fam JOIN profiles USING (run))"""


@query(f"""
WITH {_FAMILIES}, {_PROFILES}, {_FANOUT}
SELECT *, household_id || ' (' || day_type || ')' AS family_label FROM tasks""")
def scenario_fanout(spark, sf_dir):
    out = plan.consumption_tasks(_families(spark, sf_dir), _profiles(spark, sf_dir), ["run"], 1)
    return out.drop("seed")


@query(f"""
WITH {_FAMILIES}, {_PROFILES}, {_FANOUT}, o AS (SELECT c_custkey, c_acctbal > 0 AS rich FROM customer)
SELECT t.run, t.family_file_id, t.season, t.profile, t.day_type, 'regime of ' || fam.household_id AS household_work_regime,
       CASE WHEN rich THEN 'low' ELSE 'Unknown' END AS weekday_daytime_occupancy_level, fam.household_id, p.year AS weather_year
FROM tasks t JOIN fam ON fam.run = t.run AND fam.family_file_id = t.family_file_id JOIN o USING (c_custkey)
JOIN profiles p ON p.run = t.run AND p.season = t.season AND p.profile = t.profile""")
def tasks_with_documents(spark, sf_dir):
    """Every task beside the family and the weather it is about, and what a request says of the household's routine."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") > 0).alias("rich"))
    families = _families(spark, sf_dir).join(customers, "c_custkey").select(
        "run", "family_file_id", "household_id", F.concat(F.lit("regime of "), "household_id").alias("household_work_regime"),
        F.when(F.col("rich"), "low").alias("weekday_daytime_occupancy_level"), F.array().cast("array<string>").alias("members"),
    )
    profiles = _profiles(spark, sf_dir)
    tasks = plan.consumption_tasks(_families(spark, sf_dir), profiles, ["run"], 1)
    whole = plan.with_documents(tasks.drop("household_id"), families, profiles, ["run"])
    return whole.select(
        "run", "family_file_id", "season", "profile", "day_type", "work_regime.household_work_regime", "work_regime.weekday_daytime_occupancy_level",
        "family.household_id", F.col("weather.year").alias("weather_year"),
    )


_FILE_OF_ORDER = f"""
  'f' || CASE WHEN o_orderkey % 70 < 10 THEN '0' ELSE '' END || (o_orderkey % 70) || '_work01_s3var' ||
  lpad(CAST(o_orderkey % 9 AS VARCHAR), 2, '0') || '_' || {season_sql("o_orderdate")} || '_' ||
  CASE WHEN o_orderkey % 2 = 0 THEN 'weekday' ELSE 'weekend' END || '_var01_' || strftime(o_orderdate, '%Y%m%d') || '_120000.json'"""
_KEY_RE = r"^(.+?)_work(\d+)_s3var(\d+)_([^_]+)_([^_]+)_var(\d+)_\d{8}_\d{6}\.json$"


def _order_file(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey",
        key.consumption_file_name(
            F.concat(F.lit("f"), text.zero_padded(F.col("o_orderkey") % 70, 2)), F.col("o_orderkey") % 9,
            cal.season_of(F.col("o_orderdate")), choose(F.col("o_orderkey"), ("weekday", "weekend")), F.lit(1),
            F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_120000")),
        ).alias("file"),
    )


@query(f"""
WITH {_FAMILIES}, {_PROFILES}, {_FANOUT},
files AS (SELECT CAST(o_custkey % 25 AS INTEGER) AS run, {_FILE_OF_ORDER} AS file FROM orders),
k AS (SELECT run, regexp_extract(file, '{_KEY_RE}', ['family_file_id', 'work', 'profile', 'season', 'day_type', 'variant']) AS k FROM files),
done AS (SELECT DISTINCT run, k.family_file_id AS family_file_id, k.season AS season, CAST(k.profile AS BIGINT) AS profile,
                k.day_type AS day_type, CAST(k.variant AS INTEGER) AS variant FROM k)
SELECT t.* FROM tasks t LEFT JOIN done d USING (run, family_file_id, season, profile, day_type, variant)
WHERE d.run IS NULL""")
def tasks_remaining(spark, sf_dir):
    return _remaining(spark, sf_dir)


def _remaining(spark, sf_dir, **kw):
    files = _order_file(spark, sf_dir).withColumn("run", (F.col("o_custkey") % 25).cast("int"))
    done = t.keyed(files, key.consumption_key(F.col("file")), ["run"]).select(
        "run", F.col("family_id").alias("family_file_id"), "season", F.col("profile").cast("bigint").alias("profile"),
        "day_type", "variant",
    )
    out = plan.consumption_tasks(_families(spark, sf_dir), _profiles(spark, sf_dir), ["run"], 1, completed=done, **kw)
    return out.drop("seed", "family_label")


@query(ORACLES["tasks_remaining"])
def tasks_remaining_pruned(spark, sf_dir):
    """The same tasks; those a Bloom filter over the finished ones clears are not shuffled."""
    return _remaining(spark, sf_dir, prune=True)


@query(f"""
WITH {_PROFILES}, named AS (SELECT run, year, CASE WHEN season = 'Spring' THEN 'Unknown' ELSE season END AS season FROM profiles)
SELECT run, season, count(*) AS n_profiles, min(year) AS first_position FROM named GROUP BY run, season""")
def profiles_by_season(spark, sf_dir):
    p = _profiles(spark, sf_dir).withColumn("season", F.nullif("season", F.lit("Spring")))
    return t.season_groups(p, "year", ["run"])


_WANTED = 280


@query(f"""
SELECT year(o_orderdate) AS year, o_orderkey % 7 AS variant, count(DISTINCT o_custkey) AS n_families
FROM orders GROUP BY 1, 2 HAVING count(DISTINCT o_custkey) >= {_WANTED}""")
def variant_completion(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), (F.col("o_orderkey") % 7).alias("variant"),
        F.col("o_custkey").alias("household_id"),
    )
    return t.completed_variants(items, _WANTED, ["year", "variant"])


@query(f"""
WITH f AS (
  SELECT c_custkey, 'United ' || n_name AS country, n_regionkey AS call,
         CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment)
              ELSE 'young ' || c_mktsegment || ' double income home' END AS family_type
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
w AS (SELECT *, list_aggregate(list_transform(string_split(coalesce(family_type, 'Unknown'), ' ')[1:3], lambda x: upper(x[1])), 'string_agg', '') AS abbr FROM f),
n AS (SELECT *, row_number() OVER (PARTITION BY call, abbr ORDER BY c_custkey) AS n FROM w)
SELECT c_custkey, 'UNI-' || abbr || '-' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS household_id
FROM n""")
def household_ids(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("United "), "n_name").alias("country"),
        F.col("n_regionkey").alias("call"),
    )
    kind = F.when(F.col("c_custkey") % 10 == 0, F.lit(None)).when(
        F.col("c_custkey") % 3 == 0, F.lower("c_mktsegment")
    ).otherwise(F.concat(F.lit("young "), "c_mktsegment", F.lit(" double income home")))
    families = table(spark, sf_dir, "customer").join(nation, "c_nationkey").select(
        "c_custkey", "country", "call", kind.alias("family_type"), F.expr("c_custkey div 1024").alias("block")
    )
    numbered = t.number_households(families, ["call"], ["c_custkey"], ["block"])
    return numbered.select("c_custkey", "household_id")


_NAMES = """CASE o_orderkey % 7
    WHEN 0 THEN 'IRE-NF-' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || '_var' || lpad(CAST(o_orderkey % 13 AS VARCHAR), 2, '0') || s
    WHEN 1 THEN 'IRE-SP-001_H' || (o_orderkey % 5 + 1) || '_P1_C1_E' || (o_orderkey % 4 + 1) || '_var02' || s
    WHEN 2 THEN 'variation' || lpad(CAST(o_orderkey % 12 AS VARCHAR), 2, '0') || '_summer' || s
    WHEN 3 THEN 'f01_work01_s3var' || (o_orderkey % 40) || '_Summer_weekday_var01' || s
    WHEN 4 THEN 'f' || (o_orderkey % 99) || '_work02_Winter_weekend_var03' || s
    WHEN 5 THEN 'f02_Autumn_weekday_var' || (o_orderkey % 8) || s
    ELSE 'notes_' || o_orderkey || '.txt' END"""
_ST = r"_\d{8}_\d{6}\.json$"


@query(rf"""
WITH o AS (SELECT o_orderkey, '_' || strftime(o_orderdate, '%Y%m%d') || '_120000.json' AS s FROM orders),
f AS (SELECT o_orderkey, {_NAMES} AS file FROM o),
g AS (SELECT *, regexp_matches(file, '^(.+?)_var(\d+){_ST}') AS is_f, regexp_matches(file, '^variation(\d+)_([^_]+){_ST}') AS is_w,
  regexp_matches(file, '^(.+?)_work(\d+)_s3var(\d+)_([^_]+)_([^_]+)_var(\d+){_ST}') AS c1,
  regexp_matches(file, '^(.+?)_work(\d+)_([^_]+)_([^_]+)_var(\d+){_ST}') AS c2,
  regexp_matches(file, '^(.+?)_([^_]+)_([^_]+)_var(\d+){_ST}') AS c3 FROM f)
SELECT o_orderkey, file,
  CASE WHEN is_f THEN regexp_extract(file, '^(.+?)_var(\d+){_ST}', 1) END AS household_part,
  CASE WHEN is_f THEN CAST(regexp_extract(file, '^(.+?)_var(\d+){_ST}', 2) AS INTEGER) END AS family_variant,
  CASE WHEN is_f THEN nullif(regexp_extract(regexp_extract(file, '^(.+?)_var(\d+){_ST}', 1), '_(H\d+_P\d+_C\d+_E\d+)$', 1), '') END AS combo_code,
  CASE WHEN is_w THEN CAST(regexp_extract(file, '^variation(\d+)_', 1) AS INTEGER) END AS weather_variant,
  CASE WHEN is_w THEN regexp_extract(file, '^variation\d+_([^_]+)_', 1) END AS weather_season,
  CASE WHEN c1 THEN regexp_extract(file, '^(.+?)_work', 1) WHEN c2 THEN regexp_extract(file, '^(.+?)_work', 1)
       WHEN c3 THEN regexp_extract(file, '^(.+?)_([^_]+)_([^_]+)_var(\d+){_ST}', 1) END AS family_id,
  CASE WHEN c1 OR c2 THEN CAST(regexp_extract(file, '_work(\d+)_', 1) AS INTEGER) WHEN c3 THEN 1 END AS work,
  CASE WHEN c1 THEN CAST(regexp_extract(file, '_s3var(\d+)_', 1) AS INTEGER) WHEN c2 OR c3 THEN 1 END AS profile,
  CASE WHEN c1 OR c2 OR c3 THEN regexp_extract(file, '_([^_]+)_([^_]+)_var\d+{_ST}', 1) END AS season,
  CASE WHEN c1 OR c2 OR c3 THEN regexp_extract(file, '_([^_]+)_([^_]+)_var\d+{_ST}', 2) END AS day_type,
  CASE WHEN c1 OR c2 OR c3 THEN CAST(regexp_extract(file, '_var(\d+){_ST}', 1) AS INTEGER) END AS variant
FROM g""")
def key_parsing(spark, sf_dir):
    k = F.col("o_orderkey")
    stamp = F.concat(F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_120000.json"))
    kinds = (
        F.concat(F.lit("IRE-NF-"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("_var"), F.lpad((k % 13).cast("string"), 2, "0"), stamp),
        F.concat(F.lit("IRE-SP-001_H"), k % 5 + 1, F.lit("_P1_C1_E"), k % 4 + 1, F.lit("_var02"), stamp),
        F.concat(F.lit("variation"), F.lpad((k % 12).cast("string"), 2, "0"), F.lit("_summer"), stamp),
        F.concat(F.lit("f01_work01_s3var"), k % 40, F.lit("_Summer_weekday_var01"), stamp),
        F.concat(F.lit("f"), k % 99, F.lit("_work02_Winter_weekend_var03"), stamp),
        F.concat(F.lit("f02_Autumn_weekday_var"), k % 8, stamp),
        F.concat(F.lit("notes_"), k, F.lit(".txt")),
    )
    name = F.when(k % 7 == 0, kinds[0])
    for i, kind in enumerate(kinds[1:], 1):
        name = name.when(k % 7 == i, kind)
    files = table(spark, sf_dir, "orders").select("o_orderkey", name.alias("file"))
    f = F.col("file")
    parsed = files.select(
        "o_orderkey", "file", key.family_key(f).alias("fk"), key.weather_key(f).alias("wk"), key.consumption_key(f).alias("ck")
    )
    return parsed.select(
        "o_orderkey", "file", F.col("fk.household_id").alias("household_part"), F.col("fk.variant").alias("family_variant"),
        key.combo_code(F.col("fk.household_id")).alias("combo_code"), F.col("wk.variant").alias("weather_variant"),
        F.col("wk.season").alias("weather_season"), "ck.family_id", "ck.work", "ck.profile", "ck.season", "ck.day_type", "ck.variant",
    )


@query("""
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate,
       arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus
FROM orders GROUP BY o_custkey""")
def latest_records(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return ordered.latest(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


_SEGMENTS = ("BUILDING", "MACHINERY")


@query("""
WITH f AS (SELECT c_nationkey AS file_rank, c_custkey AS position, c_mktsegment AS household_id, c_acctbal FROM customer)
SELECT 'by id' AS pick, file_rank, position, household_id, c_acctbal FROM f WHERE household_id = 'MACHINERY'
  QUALIFY row_number() OVER (ORDER BY file_rank, position) = 1
UNION ALL
SELECT 'by position', file_rank, position, household_id, c_acctbal FROM f WHERE position = 77
  QUALIFY row_number() OVER (ORDER BY file_rank, position) = 1""")
def family_pick(spark, sf_dir):
    f = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("file_rank"), F.col("c_custkey").alias("position"),
        F.col("c_mktsegment").alias("household_id"), "c_acctbal",
    )
    by_id = plan.pick_family(f, household_id="MACHINERY").withColumn("pick", F.lit("by id"))
    by_position = plan.pick_family(f, household_id="MACHINERY", index=77).withColumn("pick", F.lit("by position"))
    return by_id.unionByName(by_position)


@query(f"""
WITH o AS (SELECT o_orderkey, {sql_choose("o_orderkey", ("Stage 1", "families (draft)", "Stage2", "stage 3 weather", "Weather", "consumption", "Stage 3", "draft", "STAGE 21"))} AS stage,
                  {sql_choose("o_orderkey", ("cultural_auditor", "auditor_cultural", " Physical  Auditor", "generator"))} AS role,
                  dayname(o_orderdate) AS d FROM orders),
x AS (SELECT *, lower(replace(stage, ' ', '')) AS f FROM o)
SELECT o_orderkey, CASE WHEN contains(f, '1') OR contains(f, 'family') OR contains(f, 'families') THEN 'stage1_family'
         WHEN contains(f, '2') OR contains(f, 'weather') THEN 'stage2_weather'
         WHEN contains(f, '3') OR contains(f, 'consumption') THEN 'stage3_consumption' ELSE 'unknown_stage' END AS stage_folder,
  CASE role WHEN ' Physical  Auditor' THEN 'auditor physical' WHEN 'generator' THEN 'generator' ELSE 'auditor cultural' END AS role_key,
  CASE role WHEN 'cultural_auditor' THEN 'Cultural Auditor' WHEN 'auditor_cultural' THEN 'Auditor Cultural' WHEN 'generator' THEN 'Generator' ELSE role END AS role_name,
  d || ' (' || CASE WHEN d IN ('Saturday', 'Sunday') THEN 'weekend' ELSE 'weekday' END || ')' AS day_label
FROM x""")
def labels_and_stages(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    stage = choose(k, ("Stage 1", "families (draft)", "Stage2", "stage 3 weather", "Weather", "consumption", "Stage 3", "draft", "STAGE 21"))
    role = choose(k, ("cultural_auditor", "auditor_cultural", " Physical  Auditor", "generator"))
    return o.select(
        "o_orderkey", text.stage_of(stage).alias("stage_folder"), text.normalised_role(role).alias("role_key"),
        text.display_role(role).alias("role_name"), text.day_label(cal.day_name(d), cal.legacy_day_type(d)).alias("day_label"),
    )
