import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homeload import schemas
from homeload.functions import keys, text
from homeload.operators import merge, nested
from homeload.plans import requests as plan


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "answer, want",
    [
        ('{"a": 1}', '{"a": 1}'), (" [1, 2] ", "[1, 2]"), ('Sure: {"a": {"b": 1}} ok?', '{"a": {"b": 1}}'),
        ('```json\n{"a": 1}\n```', '{"a": 1}'), ("text\n```\n[1]\n```\n{}", "[1]"),
        ("<think>{no} ]</think>\n[1]", "[1]"), ('{"a": 1} and [2]', '{"a": 1}'), ('[1] and {"a": 2}', "[1]"),
        ('[1] and {"a": [2]} x', '[1] and {"a": [2]'), ("{'a': 1}", "{'a': 1}"), ("  nothing here ", "nothing here"),
        ("} {", "} {"), ('] { "a": 1', '] { "a": 1'), ("", ""),
    ],
)
def test_extract_json(spark, answer, want):
    assert one(spark, text.extract_json(F.lit(answer))) == want


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ('{"a": 1}', True), (' [1, {"b": null}] \n', True), ('"s"', True), ("null", True), ('{"a": NaN}', True), ('{"a": 1, "a": 2}', True),
        ('{"a": 1} oops', False), ('{"a": 1}{"b": 2}', False), ('{"a": 1}, {"b": 2}', False), ('{"a": 1}]', False), ('{"a": 1}}', False),
        ('{"a": 1}], [2', False), ('1], "x": [2', False), ('1, "b": 2', False), ("{'a': 1}", False), ('{"a": "x\ny"}', False), ("[1, 2", False),
        ("[1,]", False), ("", False), ("  ", False), (None, False), ('{"a": 1}/*c*/', False),
    ],
)
def test_is_json_means_one_whole_value(spark, body, want):
    assert one(spark, text.is_json(F.lit(body).cast("string"))) is want


def test_text_behind_an_answer_makes_it_unreadable(spark):
    audit = lambda s: one(spark, nested.parse_audit(F.lit(s), F.lit("cultural"))).severity
    assert audit('Sure {"severity":"LOW"} but see {note}') == "HIGH" and audit('{"severity":"HIGH","severity":"LOW"}') == "LOW"
    assert one(spark, nested.parse_decision(F.lit('{"decision":"ACCEPT"} or {x}'))).decision == "REGENERATE_FULL"


def test_diff_tells_paths_and_empty_arrays_apart(frame):
    shape = "struct<`a.b`: int, a: struct<b: int>, xs: array<int>>"
    pairs = frame([{"k": 1, "old": (1, (2,), []), "new": (1, (3,), None)}], f"k INT, old {shape}, new {shape}")
    got = {(r.path, r.old_value, r.new_value) for r in nested.document_diff(pairs, ["k"], "old", "new").collect()}
    assert got == {("a.b", "2", "3"), ("xs", "[]", None)}


def test_unreadable_answers_become_fixed_records(spark):
    df = spark.createDataFrame([("{'severity': 'LOW'}", "physical"), ("[]", "cultural"), ('{"severity": "LOW"}', "physical")], "a STRING, w STRING")
    got = [r.x for r in df.select(nested.parse_audit(F.col("a"), F.col("w")).alias("x")).collect()]
    assert [g.severity for g in got] == ["HIGH", "HIGH", "LOW"]
    assert got[0].violations_found is True and got[0].issues_found is None and got[1].issue_descriptions == ["Failed to parse audit report"]
    bad = one(spark, nested.parse_decision(F.lit("hm"), "CEO decision"))
    assert (bad.decision, bad.reason) == ("REGENERATE_FULL", "Failed to parse CEO decision")
    good = one(spark, nested.parse_decision(F.lit('ok {"decision": "ACCEPT", "reason": "r"}')))
    assert good.decision == "ACCEPT" and good.regeneration_guidance is None


def test_templates(spark):
    t = "$a ${b} $$a $missing ${ $9 $A $ab"
    got = one(spark, text.render_template(F.lit(t), {"a": F.lit("$b"), "b": F.lit(2)}))
    assert got == "$b 2 $a $missing ${ $9 $A $ab"
    assert one(spark, text.unresolved_names(F.lit(t), ["a", "b"])) == ["A", "ab", "missing"]


def test_requests_and_lessons(spark):
    rules = spark.createDataFrame([("s1", "b"), ("s1", "a"), ("s1", "a")], "stage STRING, rule STRING")
    lessons = plan.lessons_of(rules).first().lessons
    assert lessons == "- [RULE: s1] a\n- [RULE: s1] b"
    out = plan.requests(spark.range(1), "Do $x", {"x": F.lit("it")}, F.lit(""), F.lit(lessons)).first()
    assert out.prompt == "Do it\n\nLESSONS LEARNED FROM PREVIOUS ATTEMPTS (MUST FOLLOW):\n" + lessons


def test_audit_requests_skip_placeholder_criteria(spark):
    df = spark.createDataFrame([("# none yet",), ("  ",), ("check it",)], "c STRING")
    ctx = F.create_map(F.lit("day_type"), F.lit("weekday"), F.lit("x"), F.lit(""))
    rows = plan.audit_requests(df, "$context / $criteria", {}, ctx, F.col("c")).collect()
    assert [(r.prompt, r.severity) for r in rows] == [
        (None, "NONE"), (None, "NONE"), ("- Day Type: weekday / check it", None),
    ]


def test_names(spark):
    assert one(spark, text.country_short_code(F.lit("United Kingdom"))) == "UNI"
    assert one(spark, text.initials(F.lit("single parent household of three"))) == "SPH"
    assert one(spark, text.household_id(F.lit("Ireland"), F.lit("Nuclear family"), F.lit(7))) == "IRE-NF-007"
    assert one(spark, text.household_id(F.lit("UAE"), F.lit(None).cast("string"), F.lit(1234))) == "UAE-U-1234"
    assert one(spark, text.normalised_role(F.lit("Cultural_Auditor"))) == "auditor cultural"
    assert [one(spark, text.stage_of(F.lit(s))) for s in ("Stage 1", "stage2 family", "WEATHER", "Stage 3", "?")] == [
        "stage1_family", "stage1_family", "stage2_weather", "stage3_consumption", "unknown_stage",
    ]


@pytest.mark.parametrize(
    "name, want",
    [
        ("f01_work01_s3var02_Summer_weekday_var01_20260101_120000.json", ("f01", 1, "Summer", 2, "weekday", 1)),
        ("f01_work02_Summer_weekday_var01_20260101_120000.json", ("f01", 2, "Summer", 1, "weekday", 1)),
        ("f01_Summer_weekday_var03_20260101_120000.json", ("f01", 1, "Summer", 1, "weekday", 3)),
        ("IRE_NF_Summer_weekday_var03_20260101_120000.json", ("IRE_NF", 1, "Summer", 1, "weekday", 3)),
        ("f01_Summer_weekday_20260101_120000.json", None), ("f01_Summer_weekday_var01_20260101_120000.txt", None),
    ],
)
def test_consumption_file_names(spark, name, want):
    got = one(spark, keys.consumption_key(F.lit(name)))
    assert (tuple(got) if got else None) == want


def test_family_and_weather_file_names(spark):
    got = one(spark, keys.family_key(F.lit("IRE-SP-001_H5_P1_C1_E1_var02_20260101_120000.json")))
    assert tuple(got) == ("IRE-SP-001_H5_P1_C1_E1", 2)
    assert one(spark, keys.combo_code(F.lit(got.household_id))) == "H5_P1_C1_E1"
    assert tuple(one(spark, keys.weather_key(F.lit("variation01_summer_20260101_120000.json")))) == (1, "summer")
    assert one(spark, keys.weather_key(F.lit("variation01_late_summer_20260101_120000.json"))) is None


def test_diff_reports_only_changed_leaves(frame):
    schema = f"id INT, old {T.StructType.fromDDL(schemas.FAMILY).simpleString()}"
    base = {"family_type": "A", "members": [{"role": "Father", "work_modality": "office"}], "appliances": ["TV", "Oven"], "num_people": 1}
    df = frame([{"id": 1, "old": base}], schema)
    same = nested.document_diff(df.withColumn("new", F.col("old")), ["id"], "old", "new")
    assert same.count() == 0
    edited = F.col("old").withField("num_people", F.lit(2)).withField("appliances", F.array(F.lit("TV")))
    diff = nested.document_diff(df.withColumn("new", edited), ["id"], "old", "new")
    assert {(r.path, r.old_value, r.new_value) for r in diff.collect()} == {
        ("num_people", "1", "2"), ("appliances[1]", "Oven", None),
    }
    assert nested.changed_only(df, diff, ["id"]).count() == 1


def test_rule_lines(spark):
    a = spark.createDataFrame([("- x\n\n  - y\r\n",), ("- x ",)], "t STRING")
    got = [r.line for r in merge.merged_rules([merge.text_lines(a, "t")]).collect()]
    assert got == ["- x", "- y"]
