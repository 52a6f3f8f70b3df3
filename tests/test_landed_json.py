"""Landed JSON: every file accounted for, rows as Python's parser gives them."""

import json
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from whlens.plans import roles
from whlens.plans.exports import Params, run_exports
from whlens.sources import json_pages as J
from whlens.sources.files import TableSet


def record(i):
    return {"query_id": str(i), "query_text": 'select "res": \\"res\\": { from t', "user_id": i, "user_name": None, "metrics": {"read_bytes": i * 10}}


def page(*ids, **more):
    return {"res": [record(i) for i in ids], "has_more": True, **more}


def land(folder, **files):
    for name, text in files.items():
        path = os.path.join(folder, name.replace("__", "/"))
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
    return folder


def rows(landed):
    return sorted(int(r.query_id) for r in J.shaped(landed.records, J.HISTORY_RECORD).collect())


def ledger(landed):
    return {os.path.basename(r.file): (r.form, r.pages, r.records, r.unreadable, r.status) for r in landed.ledger.collect()}


def dumped(*pages, **how):
    return "\n".join(json.dumps(p, **how) for p in pages) + "\n"


def test_forms_of_files(spark, tmp_out):
    d = land(tmp_out, **{
        "lines": dumped(page(1, 2), page(3)) + "\n",
        "sub [x]__a b%1": dumped(page(4, 5), indent=2),
        "concatenated": json.dumps(page(6), indent=1) + json.dumps(page(7)) + dumped(page(8), indent=4),
        "array": json.dumps([page(9), page()]),
        "one_line": json.dumps(page(10)) + json.dumps(page(11)),
        "record_a_line": '{"res": [\n' + json.dumps(record(12)) + ",\n" + json.dumps(record(13)) + "\n]}",
        "no_records": dumped(page(), {"has_more": False}),
        "marked": "﻿" + dumped(page(14)),
        "nothing": "",
    })
    got = J.ingest(spark, d, "res")
    assert rows(got) == list(range(1, 15)) and got.quarantine.isEmpty()
    assert ledger(got) == {
        "lines": ("lines", 2, 3, 0, "read"), "a%20b%251": ("document", 1, 2, 0, "read"), "concatenated": ("document", 3, 3, 0, "read"),
        "array": ("document", 2, 1, 0, "read"), "one_line": ("document", 2, 2, 0, "read"), "record_a_line": ("document", 1, 2, 0, "read"),
        "no_records": ("lines", 2, 0, 0, "read"), "marked": ("lines", 1, 1, 0, "read"), "nothing": ("empty", 0, 0, 0, "empty")}


BROKEN = {
    "cut": dumped(page(1)) + dumped(page(2, 3))[:70] + "\n" + dumped(page(4)),
    "cut_document": json.dumps(page(5, 6), indent=2)[:150],
    "cut_between_records": '{"res": [\n' + json.dumps(record(7)) + ",\n" + json.dumps(record(8)) + "\n",
    "null_array": '{"res": null}\n',
    "no_objects": '{"res": [1, {"query_id": "9"}]}\n',
    "no_json": "<html>502</html>\n",
    "whole": dumped(page(10)),
    "deep": "[" * 100_000,
}


def test_unreadable_pages_fail(spark, tmp_out):
    d = land(tmp_out, **BROKEN)
    with pytest.raises(J.UnreadablePages, match="unreadable pages in 7 files"):
        J.read_history_pages(spark, d)


def test_unreadable_pages_are_listed(spark, tmp_out):
    d = land(tmp_out, **BROKEN)
    got = J.ingest(spark, d, "res", on_unreadable="quarantine")
    assert rows(got) == [1, 4, 10]
    assert ledger(got) == {"cut": ("document", 2, 2, 1, "partly"), "whole": ("lines", 1, 1, 0, "read"),
                           **{k: ("document", 0, 0, 1, "unreadable") for k in BROKEN if k not in ("cut", "whole")}}
    listed = {os.path.basename(r.file): r for r in got.quarantine.collect()}
    assert len(listed) == 7 and all(r.reason for r in listed.values())
    for name, r in listed.items():    # nothing of a file is in neither
        assert r.raw in BROKEN[name] and BROKEN[name][r.at:].startswith(r.raw)
    assert listed["cut_between_records"].raw == BROKEN["cut_between_records"]


def test_large_files_keep_their_pages(spark, tmp_out):
    d = land(tmp_out, mixed=dumped(page(1)) + "{ broken\n" + dumped(page(2)), other=dumped(page(3)))
    got = J.ingest(spark, d, "res", on_unreadable="quarantine", max_document_bytes=10)
    assert rows(got) == [1, 2, 3] and ledger(got)["mixed"] == ("lines", 2, 2, 1, "partly")
    assert [(r.raw, r.reason) for r in got.quarantine.collect()] == [("{ broken", "line of a large file")]


def test_type_clash_nulls_one_field(spark, tmp_out):
    d = land(tmp_out, p=json.dumps({"res": [{"query_id": 7, "user_id": "abc", "status": "FINISHED", "metrics": {"read_bytes": "x", "rows_read_count": 5}}]}))
    (r,) = J.read_history_pages(spark, d).collect()
    assert (r.query_id, r.user_id, r.status, r.metrics.read_bytes, r.metrics.rows_read_count) == ("7", None, "FINISHED", None, 5)


def test_folder_without_files(spark, tmp_out):
    os.makedirs(f"{tmp_out}/none")
    got = J.ingest(spark, f"{tmp_out}/none", "res")
    assert rows(got) == [] and got.ledger.isEmpty()


def flat(value, prefix=""):
    """Leaves of a record by path, as the flattened export names them."""
    out = {}
    for k, v in value.items():
        if isinstance(v, dict) and v:
            out |= flat(v, f"{prefix}{k}.")
        else:
            out[prefix + k] = v
    return out


def test_rare_keys_arrive_in_one_scan(spark, tmp_out):
    recs = [{"QueryExecutionId": str(i), "Status": {"State": "OK", "SubmissionDateTime": "2024-01-05T01:00:00+02:00"}} for i in range(300)]
    recs[217]["Rare"] = {"Deep": {"Key": 5}}
    recs[3]["Statistics"] = {"Bytes": 12}
    recs[4]["Statistics"] = {"Bytes": 1.5}
    recs[5]["Mixed"], recs[6]["Mixed"], recs[7]["Mixed"] = 1, "one", {"a": [1, None]}
    recs[8]["Never"] = None
    recs[9]["odd key.x"] = True
    recs[10]["Big"] = 2**70
    d = land(tmp_out, a=dumped({"QueryExecutions": recs[:100]}), b=dumped({"QueryExecutions": recs[100:]}, indent=2))
    df = J.read_executions(spark, d)
    got = {r.QueryExecutionId: r for r in df.collect()}
    assert len(got) == 300 and got["217"].Rare.Deep.Key == 5 and got["0"].Rare is None
    assert [got[i].Statistics.Bytes for i in "34"] == [12.0, 1.5]
    assert [got[i].Mixed for i in "567"] == ["1", "one", '{"a":[1,null]}']
    assert got["8"].Never is None and got["9"]["odd key.x"] is True and int(got["10"].Big) == 2**70
    assert df.schema["Status"].dataType["SubmissionDateTime"].dataType == T.TimestampNTZType()
    assert got["0"].Status.SubmissionDateTime.isoformat() == "2024-01-04T23:00:00"
    # the landed text is not read again: only the tables that the one reading left
    assert all("landed-json-" in f for f in df.inputFiles())


json_values = st.recursive(st.none() | st.booleans() | st.integers(-2**40, 2**40) | st.text(max_size=8), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from("abc"), x, max_size=3), max_leaves=6)


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.lists(st.dictionaries(st.sampled_from(["res", "k", "é\n"]), json_values, max_size=3), max_size=3), st.sampled_from([None, 0, 2])), min_size=1, max_size=8), st.integers(0, 9))
def test_as_pythons_parser(spark, tmp_path_factory, pages, seed):
    d = str(tmp_path_factory.mktemp("p"))
    rng = random.Random(seed)
    files = {}
    for i, (records, indent) in enumerate(pages):
        files.setdefault(f"f{rng.randint(0, 3)}", []).append(json.dumps({"n": i, "res": records}, indent=indent, ensure_ascii=bool(i % 2)))
    land(d, **{k: "\n".join(v) for k, v in files.items()})
    got = J.ingest(spark, d, "res")
    want = sorted(json.dumps(r, sort_keys=True) for records, _ in pages for r in records)
    assert sorted(json.dumps(json.loads(r.j), sort_keys=True) for r in got.records.select(F.to_json("record").alias("j")).collect()) == want
    assert sum(r.pages for r in got.ledger.collect()) == len(pages)


def test_export_fails_on_lost_pages(spark, tmp_out):
    good = {"query_id": "a", "status": "FINISHED", "query_start_time_ms": 1704412800000}
    d = land(f"{tmp_out}/pages", a=json.dumps({"res": [good]}, indent=2), b=json.dumps({"res": [good]})[:40])
    def run(**more):
        params = Params(start="2024-01-05", end="2024-01-05", rest_pages=d, **more)
        (r,) = run_exports(spark, "databricks", TableSet(spark, f"{tmp_out}/landed"), f"{tmp_out}/out", params, ["query_history_output"], ("query_logs",)).collect()
        return r
    failed = run()
    assert failed.status == "failed" and "unreadable" in failed.error
    kept = run(on_unreadable="quarantine")
    assert (kept.status, kept.rows) == ("written", 1)


def test_records_are_stored_flat_and_not_moved(spark, tmp_out):
    """A stored row is a record, not a page, and no file's records are brought together in a shuffle."""
    d = land(tmp_out, lines=dumped(page(1, 2), page(), page(3)), printed=dumped(page(4, 5), indent=2))
    got = J.ingest(spark, d, "res")
    assert rows(got) == [1, 2, 3, 4, 5]
    kinds = {f.dataType.simpleString().partition("<")[0] for t in ("lines", "documents") for f in spark.read.parquet(f"{got.path}/{t}").schema}
    assert "array" not in kinds
    assert "Exchange" not in got.records._jdf.queryExecution().executedPlan().toString()


def test_mixed_file_is_read_once(spark, tmp_out):
    """Lines of a file that is read again as a whole don't count twice, nor do blank lines."""
    d = land(tmp_out, mixed=dumped(page(1)) + "\n\n" + dumped(page(2), indent=2), blank="\n \n", good=dumped(page(3)))
    got = J.ingest(spark, d, "res")
    assert rows(got) == [1, 2, 3]
    assert ledger(got) == {"mixed": ("document", 2, 2, 0, "read"), "blank": ("empty", 0, 0, 0, "empty"), "good": ("lines", 1, 1, 0, "read")}
    assert {os.path.basename(r.file): r.bytes for r in got.ledger.collect()}["blank"] == 3


def test_filter_reads_a_record_once(spark):
    """A filter on the columns of a record doesn't take the record apart for each of them."""
    records = spark.range(3).select(F.parse_json(F.format_string('{"query_id": "%d", "user_id": 1}', "id")).alias("record"))
    df = J.shaped(records, J.HISTORY_RECORD).where("user_id >= 0 and user_id < 5 and query_id <> 'x'").select("query_id", "user_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("variant_get(") == 1 and df.count() == 3


def test_printed_pages_lie_in_one_folder(spark, tmp_out):
    """A file for each printed page, and none of them in a folder of its own."""
    events = spark.range(1000).selectExpr("id as event_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "id as user_id", "'view' as event_type", "1.5D as value")
    documents = spark.range(5).selectExpr("id as doc_id", "concat('text ', id) as text")
    roles.land_history_pages({"events": events, "documents": documents}, f"{tmp_out}/l", cut=True)
    assert [e.name for e in os.scandir(f"{tmp_out}/l/documents") if e.is_dir()] == []
    got = J.ingest(spark, f"{tmp_out}/l", "res", on_unreadable="quarantine")
    forms = sorted((r.form, r.pages, r.records, r.unreadable, r.status) for r in got.ledger.where("form = 'document'").collect())
    assert forms == [("document", 0, 0, 1, "unreadable")] * 2 + [("document", 1, 100, 0, "read")] * 2
    assert len(rows(got)) == 800
