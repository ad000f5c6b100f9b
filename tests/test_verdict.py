from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from homeload.operators import verdict as v

FINDINGS = "doc_id INT, auditor STRING, rule_id STRING, severity STRING"
RANK = {"NONE": 0, "LOW": 1, "MEDIUM": 2, "HIGH": 3}
CASES = {
    1: ([], v.ACCEPT), 2: ([("p", "LOW"), ("c", "LOW")], v.ACCEPT), 3: ([("p", "MEDIUM")], v.PARTIAL),
    4: ([("p", "MEDIUM"), ("p", "MEDIUM")], v.FULL), 5: ([("p", "MEDIUM"), ("c", "MEDIUM")], v.FULL),
    6: ([("c", "HIGH")], v.FULL), 7: ([("p", "NONE")], v.ACCEPT),
}


def table(frame, cases):
    return frame(
        [{"doc_id": d, "auditor": a, "rule_id": f"r{i}", "severity": s} for d, (f, _) in cases.items() for i, (a, s) in enumerate(f)], FINDINGS
    )


def test_decisions(frame):
    docs = frame([{"doc_id": d} for d in CASES], "doc_id INT")
    got = v.decide(docs, table(frame, CASES), ["doc_id"]).collect()
    assert {r.doc_id: r.decision for r in got} == {d: want for d, (_, want) in CASES.items()}


def test_consumption_is_strict_and_local_rules_soften(frame):
    cases = {1: ([("p", "MEDIUM")], None), 2: ([("p", "HIGH")], None)}
    docs = frame([{"doc_id": d} for d in cases], "doc_id INT")
    strict = v.decide(docs, table(frame, cases), ["doc_id"], F.lit("stage3_consumption")).collect()
    assert {r.decision for r in strict} == {v.FULL}
    soft = v.decide(docs, table(frame, cases), ["doc_id"], local_rules=["r0"]).collect()
    assert {r.decision for r in soft} == {v.PARTIAL}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["LOW", "MEDIUM", "HIGH"]), max_size=5), st.sampled_from(["LOW", "MEDIUM", "HIGH"]))
def test_one_more_finding_never_lowers_severity(frame, severities, extra):
    cases = {1: ([("p", s) for s in severities], None), 2: ([("p", s) for s in [*severities, extra]], None)}
    got = {r.doc_id: RANK[r.severity] for r in v.severity_rollup(table(frame, cases), ["doc_id"]).collect()}
    assert got.get(1, 0) <= got[2]


ATTEMPT = (
    "task STRING, attempt INT, readable BOOLEAN, decision STRING, edit_decision STRING, edit_readable BOOLEAN, output STRING, "
    "edited_output STRING, regeneration_guidance STRING, knowledge_base_rule STRING, stage STRING"
)
F_, P_, A_ = v.FULL, v.PARTIAL, v.ACCEPT


def rows_of(task, *attempts):
    return [{"task": task, "attempt": i, "output": f"o{i}", "edited_output": f"e{i}", "stage": "s"} | a for i, a in enumerate(attempts, 1)]


def test_replay(frame):
    data = [
        *rows_of("first", {"decision": A_}), *rows_of("third", {"decision": F_}, {"readable": False, "decision": None}, {"decision": A_}),
        *rows_of("edited", {"decision": P_, "edit_decision": F_}, {"decision": P_, "edit_decision": A_}),
        *rows_of("edit_broken", {"decision": P_, "edit_decision": A_, "edit_readable": False}),
        *rows_of("failed", {"decision": F_}, {"decision": "UNSURE"}, {"decision": P_}), *rows_of("late", *[{"decision": F_}] * 3, {"decision": A_}),
        *rows_of("unreadable_accept", {"readable": False, "decision": A_}),
    ]
    got = {r.task: (r.status, r.attempts_used, r.final_output) for r in v.replay(frame(data, ATTEMPT), ["task"]).collect()}
    assert got == {
        "first": ("accepted", 1, "o1"), "third": ("accepted", 3, "o3"), "edited": ("accepted", 2, "e2"), "edit_broken": ("open", 1, None),
        "failed": ("failed", 3, None), "late": ("failed", 3, None), "unreadable_accept": ("open", 1, None),
    }


def test_guidance_is_carried_from_full_rejections(frame):
    data = [
        *rows_of("a", {"decision": F_, "regeneration_guidance": "g1"}, {"decision": P_, "regeneration_guidance": "g2"}),
        *rows_of("b", {"decision": F_, "regeneration_guidance": "g1"}, {"decision": F_, "regeneration_guidance": ""}),
        *rows_of("c", {"decision": P_, "regeneration_guidance": "g"}), *rows_of("d", {"decision": A_}), *rows_of("e", *[{"decision": F_}] * 3),
    ]
    got = {r.task: (r.next_attempt, r.guidance) for r in v.next_actions(frame(data, ATTEMPT), ["task"]).collect()}
    assert got == {"a": (3, "g1"), "b": (3, "g1"), "c": (2, None)}


def test_rule_base_and_funnel(frame):
    data = rows_of(
        "a", {"decision": F_, "regeneration_guidance": "g", "knowledge_base_rule": " r "}, {"decision": F_, "knowledge_base_rule": "lost"},
        {"decision": P_, "regeneration_guidance": "g", "knowledge_base_rule": "no"},
    ) + rows_of("b", {"decision": F_, "regeneration_guidance": "g", "knowledge_base_rule": "r"}, {"decision": A_})
    df = frame(data, ATTEMPT)
    assert [tuple(r) for r in v.rule_base(df).collect()] == [("s", "r")]
    f = v.funnel(df, ["stage"]).first()
    assert (f.decisions, f.accepted, f.partial, f.full, f.other, f.accept_rate) == (5, 1, 1, 3, 0, 0.2)


def test_unreadable_attempts_have_no_say(frame):
    unread = {"readable": False, "decision": F_, "regeneration_guidance": "lost", "knowledge_base_rule": "lost"}
    df = frame([*rows_of("a", {"decision": F_, "regeneration_guidance": "g"}, unread), *rows_of("b", unread)], ATTEMPT)
    got = {r.task: (r.next_attempt, r.guidance) for r in v.next_actions(df, ["task"]).collect()}
    assert got == {"a": (3, "g"), "b": (2, None)}
    assert v.rule_base(df).count() == 0 and v.funnel(df, ["stage"]).first().decisions == 1


def test_reports_become_decisions(frame):
    cases = {1: ("NONE", "LOW"), 2: ("MEDIUM", "NONE"), 3: ("MEDIUM", "medium"), 4: ("HIGH", "NONE"), 5: (None, "NONE")}
    rows = [{"doc": d, "report": (s,)} for d, found in cases.items() for s in found]
    df = frame(rows, "doc INT, report STRUCT<severity: STRING>")
    got = {r.doc: r.decision for r in v.decide_reports(df, ["doc"]).collect()}
    assert got == {1: A_, 2: P_, 3: F_, 4: F_, 5: A_}
    assert v.decide_reports(df.where("doc = 2"), ["doc"], F.lit("stage3_consumption")).first().decision == F_


def test_outcomes(frame):
    df = frame([{"t": i, "status": s} for i, s in enumerate(["accepted", "failed", "accepted", "open"])], "t INT, status STRING")
    assert tuple(v.outcome_summary(df).first()) == (4, 2, 2) and v.failures(df).count() == 2
