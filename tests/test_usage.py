import json

import pytest
from pyspark.sql import functions as F

from homeload import dims
from homeload.operators import usage as u
from homeload.plans import usage as plan
from homeload.sources import call_logs

FLAT = (
    "id STRING, role STRING, model STRING, provider STRING, duration_seconds DOUBLE, response_chars BIGINT, "
    "tokens_in BIGINT, tokens_out BIGINT, cost_total DOUBLE"
)
MODEL = dict(dims.ROLES)


def test_published_sample_run(frame):
    """Totals of the published sample: five calls for each of four roles, two roles idle."""
    sample = [
        ("ceo", 12.4, 23147, 262, 0.0239), ("cultural_auditor", 5.8, 19526, 140, 0.0030),
        ("generator", 186.8, 10991, 17739, 0.0476), ("physical_auditor", 10.3, 22118, 180, 0.0760),
    ]
    rows = []
    for role, seconds, t_in, t_out, _ in sample:
        for i in range(5):
            rows.append({
                "id": f"{role}{i}", "role": role, "model": MODEL[role], "provider": "deepinfra", "duration_seconds": seconds / 5,
                "tokens_in": t_in // 5 + (t_in % 5 if i == 0 else 0), "tokens_out": t_out // 5 + (t_out % 5 if i == 0 else 0),
                "response_chars": 10,
            })
    report = plan.usage_report(plan.priced_calls(frame(rows, FLAT)), dims.ROLES).collect()
    by_role = {r.role: r for r in report}
    assert len(report) == 7 and by_role["Editor"].calls == 0 and by_role["Approver"].total_cost == 0.0
    for role, seconds, t_in, t_out, cost in sample:
        r = by_role[role.replace("_", " ").title()]
        assert (r.calls, r.tokens_in, r.tokens_out) == (5, t_in, t_out) and round(r.total_cost, 4) == cost
        assert round(r.total_time, 1) == seconds
    total = by_role["TOTAL"]
    assert (total.calls, total.tokens_in, total.tokens_out) == (20, 75782, 18321)
    assert round(total.total_cost, 4) == 0.1506 and round(total.avg_cost, 4) == 0.0075


def test_member_resolution(frame):
    rows = [
        {"id": "1", "role": "Auditor_Cultural", "model": "x"}, {"id": "2", "role": None, "model": MODEL["editor"]},
        {"id": "3", "role": "nobody", "model": MODEL["editor"]}, {"id": "4", "role": "nobody", "model": "nothing"},
        {"id": "5", "role": None, "model": None},
    ]
    got = u.resolve_members(frame(rows, FLAT), u.member_rows(dims.ROLES))
    assert {r.id: r.member_role for r in got.collect()} == {"1": "Cultural Auditor", "2": "Editor", "3": "Editor"}


def test_roles_that_share_a_model_stay_apart(frame):
    roles = [("generator", "m"), ("editor", "m")]
    rows = [{"id": "1", "role": "editor", "model": "m"}, {"id": "2", "role": None, "model": "m"}]
    got = {r.role: r.calls for r in plan.usage_report(frame(rows, FLAT), roles).collect()}
    assert got == {"Generator": 1, "Editor": 1, "TOTAL": 2}


def test_cost_needs_both_counts(frame):
    rows = [
        {"id": "a", "model": "unlisted", "provider": None, "tokens_in": 10, "tokens_out": 10},
        {"id": "b", "model": "unlisted", "provider": "x", "tokens_in": 10, "tokens_out": 0},
        {"id": "c", "model": "unlisted", "provider": "x", "tokens_out": 5},
        {"id": "d", "model": "moonshotai/Kimi-K2-Instruct-0905", "provider": "OpenRouter", "tokens_in": 1_000_000, "tokens_out": 1_000_000},
        {"id": "e", "model": "moonshotai/Kimi-K2-Instruct-0905", "provider": "other", "tokens_in": 1_000_000, "tokens_out": 1_000_000},
    ]
    got = {r.id: r.cost_usd for r in u.with_cost(frame(rows, FLAT)).collect()}
    assert got["a"].total == pytest.approx(4e-5) and got["a"].input == pytest.approx(1e-5)
    assert got["b"].total == got["c"].total == got["b"].input == got["c"].output == 0.0
    assert got["d"].total == pytest.approx(2.29) and got["e"].total == pytest.approx(2.40)


def entry(i, **kw):
    base = {
        "timestamp": f"2026-01-01T00:00:{i:02d}.5", "id": f"c{i}", "model": MODEL["generator"], "duration_seconds": 1.5, "prompt": "p,\n{",
        "system_prompt": None, "response": "text ]", "tokens": {"input": 10, "output": 5, "total": 15},
        "cost_usd": {"input": 0.1, "output": 0.2, "total": 0.3}, "metadata": {"provider": "deepinfra", "role": "generator"},
    }
    return json.dumps(base | kw, indent=2)


LOGS = {
    "complete": "[\n" + ",\n".join(entry(i) for i in range(3)) + "\n]",
    "open": "[\n" + ",\n".join(entry(i) for i in range(3)),
    "comma": "[\n" + ",\n".join(entry(i) for i in range(2)) + ",",
    "cut": "[\n" + ",\n".join(entry(i) for i in range(3))[:-40],
    "start": "[\n",
    "empty": "",
    "none": "[]",
    "nulls": "[\n" + entry(1, tokens={"input": None, "output": None, "total": 0}, response=None, metadata={}) + "\n]",
}
WANT = {"complete": 3, "open": 3, "comma": 2, "nulls": 1}


def test_call_logs_in_every_state(spark, tmp_path):
    for name, body in LOGS.items():
        (tmp_path / f"api_calls_{name}.json").write_text(body)
    calls = call_logs.read_call_logs(spark, str(tmp_path / "api_calls_*.json"))
    got = {r.log_file.split("api_calls_")[1][:-5]: r["count"] for r in calls.groupBy("log_file").count().collect()}
    assert got == WANT
    first = calls.where("log_file LIKE '%open%' AND id = 'c1'").first()
    assert first.response == "text ]" and first.prompt == "p,\n{" and first.tokens.total == 15
    report = {r.role: r for r in plan.usage_report(plan.flat_calls(calls), dims.ROLES).collect()}
    assert report["TOTAL"].calls == 9 and report["Generator"].total_chars == 8 * 6


def test_long_log_without_gaps(spark, tmp_path):
    body = json.dumps([json.loads(entry(i)) for i in range(4)])
    (tmp_path / "api_calls_min.json").write_text(body)
    assert call_logs.read_call_logs(spark, str(tmp_path / "api_calls_min.json")).count() == 4


@pytest.mark.parametrize("padding", [0, 5 << 20], ids=["small", "large"])
def test_broken_logs_have_one_rule_at_any_size(spark, tmp_path, padding):
    """Only an array that lacks nothing but its end can be read."""
    one, two = entry(1, prompt="p" * padding), entry(2)
    bodies = {
        "gap": f"[\n{one},\n{two},\n{{", "comma": f"[{one},,{two}]", "glued": f"[{one}][{two}]", "middle": f"[{one}],\n{two}]",
        "junk": f"[{one}]\nnote", "open": f"[{one}, {two}",
    }
    for name, body in bodies.items():
        (tmp_path / f"api_calls_{name}.json").write_text(body)
    calls = call_logs.read_call_logs(spark, str(tmp_path / "api_calls_*.json")).groupBy("log_file").count()
    assert {r.log_file.split("api_calls_")[1][:-5]: r["count"] for r in calls.collect()} == {"open": 2}


def test_run_report_takes_json_first(spark, tmp_path):
    folder = str(tmp_path)
    assert plan.run_report(spark, folder, dims.ROLES) is None
    call, done = f"Calling deepinfra with model {MODEL['generator']}", "Successfully generated 7 characters in 1.5s"
    (tmp_path / "pipeline.log").write_text("\n".join(map(line, [call, done])) + "\n")
    total = lambda: plan.run_report(spark, folder, dims.ROLES).where("role = 'TOTAL'").first()
    assert (total().calls, total().total_chars) == (1, 7)
    (tmp_path / "api_calls_1.json").write_text(LOGS["complete"])
    assert (total().calls, total().tokens_in) == (3, 30)


def test_run_folder_prefers_json(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    assert call_logs.run_calls(spark, str(tmp_path)) is None
    (tmp_path / "logs" / "pipeline.log").write_text("x\n")
    assert call_logs.run_text_events(spark, str(tmp_path)).count() == 0
    (tmp_path / "logs" / "api_calls_1.json").write_text(LOGS["open"])
    assert call_logs.run_calls(spark, str(tmp_path)).count() == 3


def line(text):
    return f"2026-01-01 00:00:00,000 - client - INFO - {text}"


def test_text_log_pairing(spark, tmp_path):
    gen, other = MODEL["generator"], "unknown/model"
    call, done = "Calling deepinfra with model {}", "Successfully generated {} characters in {}s"
    lines = [
        done.format(1, 0.1), call.format(gen), "noise", done.format(100, 1.5), done.format(2, 0.2), call.format(gen),
        call.format(MODEL["editor"]), done.format(50, 2.0), call.format(gen), call.format(other), done.format(3, 0.3),
    ]
    (tmp_path / "pipeline.log").write_text("\n".join(map(line, lines)) + "\n")
    events = call_logs.read_text_logs(spark, str(tmp_path / "pipeline.log"))
    report = plan.text_log_report(events, dims.ROLES, ["log_file"], ["block", "row"], ["block"])
    got = {r.role: (r.calls, r.total_chars, round(r.total_time, 2)) for r in report.where("calls > 0").collect()}
    assert got == {"Generator": (1, 100, 1.5), "Editor": (1, 50, 2.0), "TOTAL": (2, 150, 3.5)}


def test_no_calls_at_all(frame):
    report = plan.usage_report(frame([], FLAT), dims.ROLES)
    assert report.where("role = 'TOTAL'").first().avg_cost == 0.0 and report.agg(F.sum("calls")).first()[0] == 0


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_open_windows_are_delivered_in_their_newest_state(spark, tmp_path, mode):
    from homeload.streaming import usage as live

    schema = (
        "id STRING, ts TIMESTAMP, role STRING, model STRING, provider STRING, duration_seconds DOUBLE, tokens_in BIGINT, tokens_out BIGINT, "
        "cost_total DOUBLE"
    )
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run(*minutes):
        rows = ", ".join(f"('c{m}', TIMESTAMP '2026-01-01 10:{m}:00', 'editor', 'm', 'p', 1.0D, 1L, 1L, 0.5D)" for m in minutes)
        spark.sql(f"SELECT * FROM VALUES {rows} AS v(id, ts, role, model, provider, duration_seconds, tokens_in, tokens_out, cost_total)").write.mode(
            "append").parquet(source)
        calls = spark.readStream.schema(schema).parquet(source)
        gap = {"session_gap": "5 minutes"} if mode == "complete" else {}
        stream = live.usage_windows(calls, price=False, **gap)
        live.run_available(stream, out, state, mode)
        return sorted((str(r.window_end)[11:16], r.calls, r.tokens_in) for r in live.delivered(spark, out, stream.schema, mode).collect())

    first, second = run("01", "02"), run("04", "02", "30")
    assert first == ([("11:00", 2, 2)] if mode == "update" else [("10:07", 2, 2)])
    assert second == ([("11:00", 4, 4)] if mode == "update" else [("10:09", 3, 3), ("10:35", 1, 1)])
