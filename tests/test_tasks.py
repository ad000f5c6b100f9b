from pyspark.sql import functions as F

from homeload import dims
from homeload.operators import tasks as t
from homeload.plans import tasks as plan


def run(spark):
    return plan.run_frame(spark, run="Ireland")


def test_family_grid_size_and_status_cycle(spark):
    tasks = plan.family_tasks(run(spark), ["run"], 5)
    assert tasks.count() == 5 * 5 * 3 * 5
    cycle = {r.variant: r.employment_status for r in tasks.select("variant", "employment_status").distinct().collect()}
    assert cycle == {1: "employee", 2: "self-employed", 3: "unemployed", 4: "retired", 5: "employee"}
    assert tasks.where(~F.col("seed").between(1, 999999)).count() == 0


def test_representative_combos_and_resume(spark):
    combos = dims.literal_frame(spark, [(1, 5, 1), (1, 5, 1), (3, 2, 3), (9, 9, 9)], "people_code INT, house_code INT, composition_code INT")
    tasks = plan.family_tasks(run(spark), ["run"], 2, combos)
    codes = sorted(r.combo_code for r in tasks.collect())
    assert codes == ["H2_P3_C3_E1", "H2_P3_C3_E2", "H5_P1_C1_E1", "H5_P1_C1_E2"]
    done = tasks.where("combo_code = 'H5_P1_C1_E2'")
    left = plan.family_tasks(run(spark), ["run"], 2, combos, done.union(done))
    assert left.count() == 3
    assert plan.family_tasks(run(spark), ["run"], 2, combos, tasks).count() == 0
    again = {(r.combo_code, r.seed) for r in left.collect()}
    assert again < {(r.combo_code, r.seed) for r in tasks.collect()}


def test_standard_tasks_skip_complete_variants(spark):
    done = spark.createDataFrame([("Ireland", 1, "a"), ("Ireland", 1, "a"), ("Ireland", 2, "a"), ("Ireland", 2, "b")],
                                 "run STRING, variant INT, household_id STRING")
    left = plan.standard_family_tasks(run(spark), ["run"], 3, 2, done)
    assert sorted(r.variant for r in left.collect()) == [1, 3]


def test_weather_tasks(spark):
    done = spark.createDataFrame([("Ireland", 1, "summer")], "run STRING, variant INT, season STRING")
    assert plan.weather_tasks(run(spark), ["run"], 2, ["summer", "winter"], done).count() == 3


def test_consumption_tasks(spark):
    fam = spark.createDataFrame([("r", 1, "A"), ("r", 2, None), ("q", 3, "C")], "run STRING, pos INT, household_id STRING")
    fam = t.index_families(fam, ["pos"], [], ["run"])
    w = spark.createDataFrame(
        [("r", 1, "Summer", None, None), ("r", 2, "Summer", "weekend", None), ("r", 3, None, None, "Monday"), ("z", 4, "Winter", None, None)],
        "run STRING, pos INT, season STRING, day_type STRING, day_name STRING",
    )
    w = t.index_profiles(w, ["pos"], ["run"])
    tasks = plan.consumption_tasks(fam, w, ["run"], 2)
    # two families x (both day types + weekend + weekday) x two variants; run q has no weather
    assert tasks.count() == 2 * 4 * 2
    rows = {(r.family_file_id, r.season, r.profile, r.day_type) for r in tasks.collect()}
    assert {k[1:] for k in rows if k[0] == "f01"} == {
        ("Summer", 1, "weekday"), ("Summer", 1, "weekend"), ("Summer", 2, "weekend"), ("Unknown", 1, "weekday"),
    }
    assert {r.family_label for r in tasks.where("family_file_id = 'f02'").collect()} == {"Unknown (weekday)", "Unknown (weekend)"}
    assert plan.consumption_tasks(fam, w, ["run"], 2, completed=tasks).count() == 0
    first = tasks.where("variant = 1")
    assert plan.consumption_tasks(fam, w, ["run"], 2, completed=first).count() == 8
    assert t.season_groups(w, "pos", ["run"]).where("season = 'Unknown'").first().first_position == 3


def test_documents_join_late(spark):
    fam = spark.createDataFrame([("r", "f01", "A", None, "low", ["x"])],
                                "run STRING, family_file_id STRING, household_id STRING, household_work_regime STRING, "
                                "weekday_daytime_occupancy_level STRING, members ARRAY<STRING>")
    w = spark.createDataFrame([("r", "Summer", 1, 2024)], "run STRING, season STRING, profile BIGINT, year INT")
    tasks = plan.consumption_tasks(fam, w, ["run"], 1, ["weekday"])
    row = plan.with_documents(tasks, fam, w, ["run"]).first()
    assert row.family.household_id == "A" and row.work_regime.household_work_regime == "{}" and row.weather.year == 2024


def test_household_numbers_restart_per_call(spark):
    rows = [("c1", 1, "Nuclear Family"), ("c1", 2, "nice folk"), ("c1", 3, "Single"), ("c2", 4, "New Friends")]
    df = spark.createDataFrame([(*r, "Ireland") for r in rows], "call STRING, pos INT, family_type STRING, country STRING")
    got = [r.household_id for r in t.number_households(df, ["call"], ["pos"]).orderBy("pos").collect()]
    assert got == ["IRE-NF-001", "IRE-NF-002", "IRE-S-001", "IRE-NF-001"]


def test_pick_family(spark):
    df = spark.createDataFrame([(1, 0, "B", 10), (0, 0, "A", 20), (0, 1, "B", 30), (1, 1, "A", 40)], "file_rank INT, position INT, household_id STRING, x INT")
    assert plan.pick_family(df, household_id="B").first().x == 30
    assert plan.pick_family(df, household_id="B", index=0).first().x == 20
    assert plan.pick_family(df, household_id="Z").count() == 0
