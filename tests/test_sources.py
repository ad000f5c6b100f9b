import datetime as dt
import json

import pytest
from test_rules import FAMILY, consumption_doc, profile

from homeload import dims, schemas
from homeload.plans import audit, merge
from homeload.plans import loads as load_plan
from homeload.plans import usage as usage_plan
from homeload.plans import weather as plan
from homeload.session import shared_folder
from homeload.sources import documents, item_store, settings, sinks, weather
from homeload.streaming import ingest
from test_usage import FLAT


def write(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value, indent=2))


def test_array_object_and_broken_files(spark, tmp_path):
    write(tmp_path / "a.json", [FAMILY, FAMILY])
    write(tmp_path / "b.json", FAMILY)
    write(tmp_path / "c.json", '[{"family_type": "x"')
    write(tmp_path / "e.json", FAMILY | {"num_people": "three"})
    write(tmp_path / "d.txt", [FAMILY])
    write(tmp_path / "f.json", json.dumps(FAMILY) + "\n" + json.dumps(FAMILY))
    write(tmp_path / "g.json", json.dumps([FAMILY]) + " oops")
    df = documents.read_documents(spark, str(tmp_path), schemas.FAMILY, "*.json", "src")
    assert {r.src: r["count"] for r in df.groupBy("src").count().collect()} == {"a.json": 2, "b.json": 1, "e.json": 1}
    assert df.count() == 4 and df.where("num_people IS NULL").first().home_type == "Apartment"
    assert df.first().members[2].role == "Son (10 years)"
    assert sorted(r.file for r in documents.corrupt_files(spark, str(tmp_path)).collect()) == ["c.json", "f.json", "g.json"]


def test_finished_work(spark, tmp_path):
    good = ["f01_work01_s3var02_Summer_weekday_var01_20260101_120000.json", "f01_work01_s3var02_Summer_weekday_var01_20260102_120000.json",
            "f02_Winter_weekend_var02_20260101_120000.json"]
    for name in good:
        write(tmp_path / name, {"a": 1})
    write(tmp_path / "f03_Winter_weekend_var02_20260101_120000.json", '{"a": ')
    write(tmp_path / "notes.json", {})
    got = {tuple(r) for r in documents.completed(spark, str(tmp_path), "consumption").collect()}
    assert got == {("f01", 1, "Summer", 2, "weekday", 1), ("f02", 1, "Winter", 1, "weekend", 2)}


def test_sequences(spark, tmp_path):
    a, b = profile() | {"date": "2024-01-01"}, profile() | {"date": "2024-01-02"}
    write(tmp_path / "list.json", [a, b])
    write(tmp_path / "wrapped.json", {"sequence": [a]})
    write(tmp_path / "one.json", b)
    got = documents.sequences(spark, str(tmp_path))
    assert sorted(r.date for r in got.collect()) == ["2024-01-01"] * 2 + ["2024-01-02"] * 2
    assert len(got.first().weather_data.humidity.hourly_profile) == 24


def test_merge_runs(spark, tmp_path):
    for name, value in (("r1", [FAMILY]), ("r2", FAMILY), ("r3", "[{")):
        (tmp_path / name).mkdir()
        write(tmp_path / name / "stage1_families.json", value)
    (tmp_path / "r1" / "knowledge_base.txt").write_text("\n- [RULE: a] x\n- [RULE: b] y")
    (tmp_path / "r2" / "knowledge_base.txt").write_text("- [RULE: a] x  \n\n")
    folders = [str(tmp_path / r) for r in ("r1", "r2", "r3", "gone")]
    assert merge.merge_runs(spark, folders, "stage1_families.json", schemas.FAMILY).count() == 2
    assert [r.line for r in merge.merge_rule_bases(spark, folders).collect()] == ["- [RULE: a] x", "- [RULE: b] y"]
    assert merge.merge_runs(spark, [folders[-1]], "stage1_families.json", schemas.FAMILY).count() == 0
    assert merge.merge_rule_bases(spark, [folders[-1]]).count() == 0


@pytest.fixture
def hourly(frame):
    rows = [
        {"ts": dt.datetime(2024, 7, 1) + dt.timedelta(hours=h), "country": c, "temp_air": 1.0 * h, "relative_humidity": 50.0, "ghi": 0.0,
         "dni": 1.0, "dhi": 2.0, "wind_speed": 3.0}
        for c in ("United Arab Emirates", "Brazil") for h in range(48)
    ]
    return frame(rows, schemas.TMY_HOURLY)


def test_weather_cache_and_table(spark, tmp_path, hourly):
    for country in ("United Arab Emirates", "Brazil"):
        folder = tmp_path / "cache" / country / "2024"
        folder.mkdir(parents=True)
        lines = ["time(UTC),temp_air,relative_humidity,ghi,dni,dhi,wind_speed,country"]
        lines += [f"2024-07-0{1 + h // 24} {h % 24:02d}:00:00+00:00,{1.0 * h},50.0,0.0,1.0,2.0,3.0,{country}" for h in range(48)]
        (folder / "tmy_data.csv").write_text("\n".join(lines) + "\n")
    got = weather.read_weather_cache(spark, str(tmp_path / "cache"))
    assert got.drop("year").select(*hourly.columns).exceptAll(hourly).count() == 0 and got.count() == 96
    out = shared_folder(spark, "table")
    weather.write_weather_table(got, out)
    table = weather.read_weather_table(spark, out).where("country = 'Brazil' AND year = 2024")
    assert table.count() == 48
    text = shared_folder(spark, "table-csv")
    weather.write_weather_table(got, text, "csv")
    assert weather.read_weather_table(spark, text, "csv").select(*hourly.columns).exceptAll(hourly).count() == 0
    scan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "Brazil" in scan.split("PartitionFilters")[1].split("]")[0]


def test_sinks(spark, hourly, frame):
    profile_out, seq_out, stats_out = (shared_folder(spark, n) for n in ("csv", "seq", "stats"))
    sinks.write_seasonal_files(plan.seasonal_profile(hourly), profile_out)
    back = spark.read.option("header", True).csv(profile_out)
    assert {r.Country for r in back.select("Country").distinct().collect()} == {"United-Arab-Emirates", "Brazil"}
    sinks.write_sequence(plan.weather_sequence(hourly, "07-01", 2, 2024), seq_out)
    assert spark.read.json(seq_out).count() == 4
    report = usage_plan.usage_report(frame([{"id": "1", "role": "editor", "duration_seconds": 1.005, "response_chars": 3}], FLAT), dims.ROLES)
    sinks.write_statistics(report, stats_out)
    rows = spark.read.option("header", True).csv(stats_out).collect()
    assert [r.Role for r in rows] == sorted(r.Role for r in rows) and len(rows) == 6 and rows[0].asDict()["Total Time (s)"] == "0.00"


def test_items_checkpoints_and_lineage(spark):
    items, state = shared_folder(spark, "items"), shared_folder(spark, "state")
    df = spark.createDataFrame([("s1", "X", "Winter", "f1", "old", "m", "2024-01-01"), ("s1", "X", "Winter", "f2", "only", "m", "2024-01-01")],
                               "stage STRING, country STRING, season STRING, family_id STRING, output STRING, metadata STRING, timestamp STRING")
    sinks.append_checkpoint(df, state)
    sinks.append_checkpoint(df.where("family_id = 'f1'").replace({"old": "new", "2024-01-01": "2024-01-02"}), state)
    assert {r.family_id: r.output for r in sinks.latest_checkpoints(spark, state).collect()} == {"f1": "new", "f2": "only"}
    item_store.write_items(df, items, ["country", "season"], 0)
    assert item_store.read_items(spark, items, df.schema).where("season = 'Winter'").count() == 2
    combined = shared_folder(spark, "combined")
    sinks.write_combined(df, combined)
    assert spark.read.json(combined).count() == 2
    stamped = sinks.with_lineage(df, "/data/a/stage1_families.json", None).first()
    assert (stamped.stage1_source_file, stamped.stage2_source_file) == ("stage1_families.json", None)


def test_settings(tmp_path):
    prices = {"p1": {"m": {"input_cost_per_million": 2, "output_cost_per_million": 4}}, "default": {"input_cost_per_million": 1.5}}
    write(tmp_path / "prices.json", prices)
    rows, default = settings.price_rows(settings.load(tmp_path / "prices.json"))
    assert rows == [("p1", "m", 2.0, 4.0)] and default == (1.5, 3.0)
    assert settings.role_rows({"roles": {"a": {"model": "m"}, "b": {}}}) == [("a", "m")]
    week = {"countries": {"weekends": {"AE": [{"start": "2006-09-01", "end": "2021-12-31", "weekend": ["FRI", "SAT"]}]},
                          "code_to_name": {"AE": "UAE"}, "aliases": {"E": "AE"}}}
    assert settings.weekend_rows(week) == [("AE", "2006-09-01", "2021-12-31", ["FRI", "SAT"])]
    assert settings.country_rows(week) == ([("AE", "UAE")], [("E", "AE")])
    assert settings.coordinate_rows({"tmy": {"coordinates": {"X": [1, 2]}, "southern_hemisphere": ["Y"]}}) == ([("X", 1.0, 2.0)], ["Y"])


def test_load_curves_do_not_depend_on_entry_order(frame):
    base = consumption_doc()
    turned = consumption_doc(members=[{"member_id": "Father", "hourly_activities": list(reversed(base["members"][0]["hourly_activities"]))}])
    docs = frame([base | {"id": "a"}, turned | {"id": "b"}, consumption_doc(members=None, hvac=None) | {"id": "c"}], "id STRING, " + schemas.CONSUMPTION)
    got = {r.id: r for r in load_plan.load_curves(docs, ["id"]).collect()}
    want = sum(a["consumption_kwh"] for a in base["members"][0]["hourly_activities"]) + 24 * 0.5
    assert got["a"].daily_kwh == pytest.approx(want) and got["b"].daily_kwh == pytest.approx(want)
    assert got["a"].members_home == got["b"].members_home == [1] * 24 and got["a"].peak_hour == got["b"].peak_hour == 8
    assert got["c"].daily_kwh == 0.0 and got["c"].members_home == [0] * 24


def test_ingest_replays_a_batch_without_duplicates(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    # two documents of one id are judged one by one
    rows = [FAMILY | {"household_id": "good"}, FAMILY | {"household_id": "bad", "num_people": 9}, FAMILY | {"household_id": "bad"}]
    (src / "a.json").write_text("\n".join(map(json.dumps, rows)))
    good, bad, state = (shared_folder(spark, n) for n in ("good", "bad", "ingest"))
    seen = []

    def start():
        docs = spark.readStream.schema(schemas.FAMILY).json(str(src))
        ingest.validated_ingest(docs, audit.marked_families, good, bad, state, lambda df, n: seen.append((n, df.count())))

    start()
    start()
    assert sorted(r.household_id for r in spark.read.parquet(good).collect()) == ["bad", "good"]
    assert [(r.household_id, r.broken_rules) for r in spark.read.parquet(bad).collect()] == [("bad", ["VAL4"])]
    assert seen == [(0, 2)]


def stored(spark, path, schema):
    return sorted((r.k if r.k is not None else -1, r.v) for r in item_store.read_items(spark, path, schema).collect())


def test_items_of_other_keys_stay(spark):
    out, schema = shared_folder(spark, "upsert"), "k INT, v STRING"
    assert stored(spark, out, schema) == []

    def write(batch, *rows):
        item_store.write_items(spark.createDataFrame(rows, schema) if rows else spark.createDataFrame([], schema), out, ["k"], batch, buckets=2)

    write(0, (1, "a"), (2, "a"), (3, "a"), (None, "a"))
    write(1, (4, "b"))
    assert stored(spark, out, schema) == [(-1, "a"), (1, "a"), (2, "a"), (3, "a"), (4, "b")]
    write(2, (2, "c"), (2, "c2"), (None, "c"), (5, "c"))  # an item may be two rows
    write(3)
    want = [(-1, "c"), (1, "a"), (2, "c"), (2, "c2"), (3, "a"), (4, "b"), (5, "c")]
    assert stored(spark, out, schema) == want
    for batch, rows in ((1, [(4, "b")]), (2, [(2, "c"), (2, "c2"), (None, "c"), (5, "c")])):
        write(batch, *rows)  # run again
        assert stored(spark, out, schema) == want
    with pytest.raises(ValueError):
        item_store.write_items(spark.createDataFrame([(1, "a")], schema), out, ["k"], 4, buckets=3)
    with pytest.raises(ValueError):
        item_store.write_items(spark.createDataFrame([(1, 1)], "k INT, bucket INT"), out, ["k"], 4)


def test_an_uncommitted_write_is_not_seen(spark, monkeypatch):
    out, schema = shared_folder(spark, "upsert"), "k INT, v STRING"
    item_store.write_items(spark.createDataFrame([(1, "a"), (2, "a")], schema), out, ["k"], 0)
    # the data of a batch that was lost before its commit
    broken = spark.createDataFrame([(1, "x", 0), (9, "x", 1)], "k INT, v STRING, bucket INT")
    broken.write.partitionBy("bucket").parquet(f"{out}/data/batch=1")
    assert stored(spark, out, schema) == [(1, "a"), (2, "a")]
    item_store.write_items(spark.createDataFrame([(1, "b")], schema), out, ["k"], 1)
    assert stored(spark, out, schema) == [(1, "b"), (2, "a")]


def test_only_touched_buckets_are_written(spark):
    out, schema = shared_folder(spark, "upsert"), "k INT, v STRING"
    item_store.write_items(spark.createDataFrame([(k, "a") for k in range(200)], schema), out, ["k"], 0, buckets=16)
    item_store.write_items(spark.createDataFrame([(7, "b")], schema), out, ["k"], 1)
    held = item_store.versions(spark, out)
    assert len(held) == 16 and sorted(held.values()) == [0] * 15 + [1]
    near = item_store.matching_items(spark.createDataFrame([(7,)], "k INT"), out, ["k"], item_store.read_items(spark, out, schema).schema)
    assert 0 < near.count() < 60 and near.where("k = 7").first().v == "b"
