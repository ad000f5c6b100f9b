"""Logs read in splits against the reader of whole texts."""

import json

import pytest

from homeload.plans import requests
from homeload.session import shared_folder
from homeload.sources import call_logs, documents, split_logs

CONF = "spark.sql.files.maxPartitionBytes"
ENTRY = json.dumps({"id": "1", "model": "m", "response": 'a "quoted} \\ [brace{" ]', "tokens": {"input": 3, "output": 4}})
OTHER = json.dumps({"id": "2", "response": "\n}\\\\", "prompt": "é漢}", "duration_seconds": 1.5})
BODY = f"{ENTRY},\n  {OTHER}"
LOGS = {
    "whole": f"[{BODY}]", "spaced": f" \n[ {ENTRY} , {OTHER} ] \n", "open": f"[{BODY}", "comma": f"[{BODY},\n", "empty": "[]", "nothing": "", "blank": "  \n",
    "bracket": "[", "one": f"[{ENTRY}]", "inside": f"[{BODY},\n{{\"id\": ", "in string": f"[{BODY},\n{{\"id\": \"x}}", "twice": f"[{BODY}][{BODY}]", "two commas": f"[{ENTRY},,{OTHER}]",
    "lists": f"[{BODY}],\n{BODY}]", "note": f"[{BODY}] note", "brace": f"[{BODY}]}}", "no list": ENTRY, "no bracket": f"{ENTRY},{OTHER}]", "nested": f"[[{ENTRY}],{OTHER}]",
    "late list": f"[{ENTRY},[{OTHER}]]", "mixed": f"[{ENTRY}}}{OTHER}]", "closed wrong": f"[{ENTRY}}}", "escape": '[{"id": "\\}"}]', "raw quote": '[{"id": "a"b"}]', "missing comma": f"[{ENTRY}{OTHER}]",
    "cut end": f"[{BODY}"[:-1], "word": "[x]", "no comma first": f"[,{ENTRY}]", "vertical": f"\x0b[{ENTRY}]\x0b", "single": "[{'id': '1'}]", "empty entry": "[{}]", "deep": '[{"id": "7", "extra": [{"a": {"b": ["}"]}}]}]',
}


def rows(df):
    return sorted((r.log_file.rsplit("/", 1)[1], str(r)) for r in df.collect())


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("logs")
    for name, body in LOGS.items():
        (out / name.replace(" ", "_")).write_text(body, newline="")
    return out


@pytest.mark.parametrize("size", [5, 64, 1 << 27])
def test_rows_of_any_split_size(spark, folder, size):
    want = rows(call_logs.read_call_logs(spark, str(folder)))
    assert {n for n, _ in want} == {"whole", "spaced", "open", "comma", "one", "vertical", "empty_entry", "deep"}
    before, few = spark.conf.get(CONF), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(CONF, size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        assert rows(split_logs.read_split_logs(spark, str(folder))) == want
    finally:
        spark.conf.set(CONF, before)
        spark.conf.set("spark.sql.files.openCostInBytes", few)


def test_a_log_spreads_over_tasks(spark, tmp_path):
    (tmp_path / "log").write_text("[" + ",".join(json.dumps({"id": str(i), "response": "x}" * (i % 7)}) for i in range(3000)) + "]")
    before = spark.conf.get(CONF)
    spark.conf.set(CONF, 10_000)
    try:
        assert split_logs.fragments(spark, str(tmp_path)).select("block").distinct().count() > 5
        got = split_logs.read_split_logs(spark, str(tmp_path))
        assert sorted(int(r.id) for r in got.select("id").collect()) == list(range(3000))
    finally:
        spark.conf.set(CONF, before)


def test_strings_of_any_length(spark, tmp_path):
    """The JSON parser's own limit of 20 million characters loses no file."""
    long = "x" * 21_000_000
    (tmp_path / "log").write_text(json.dumps([{"id": "1", "response": long}, {"id": "2"}]))
    for reader in (call_logs.read_call_logs, split_logs.read_split_logs):
        assert sorted((r.id, r.n) for r in reader(spark, str(tmp_path)).selectExpr("id", "length(response) AS n").collect()) == [("1", len(long)), ("2", None)]
    docs = documents.read_documents(spark, str(tmp_path), "id STRING, response STRING")
    assert docs.count() == 2 and docs.selectExpr("max(length(response))").first()[0] == len(long)
    answer = spark.read.text(str(tmp_path), wholetext=True)
    parsed = requests.parse_answers(answer.selectExpr("substr(value, 2, length(value) - 14) AS a"), "a", "id STRING, response STRING")
    assert parsed.selectExpr("length(parsed.response)").first()[0] == len(long)


@pytest.mark.parametrize("size", [5, 64])
def test_small_splits_share_a_task(spark, folder, size):
    """The rows stay those of whole logs, and only the logs are read in small splits."""
    before, few = spark.conf.get(CONF), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        assert rows(split_logs.read_split_logs(spark, str(folder), size)) == rows(call_logs.read_call_logs(spark, str(folder)))
        assert spark.conf.get(CONF) == before
        spark.conf.set(CONF, size)
        found = split_logs.fragments(spark, str(folder), size)
        assert found.select("log_file", "block").distinct().count() > len(LOGS) and found.rdd.getNumPartitions() == 1
    finally:
        spark.conf.set(CONF, before)
        spark.conf.set("spark.sql.files.openCostInBytes", few)
