import json

from tallyloom.operators import drift

SCHEMA = "raw_id bigint, lane string, receipt_file string, file_date string, line_no int, arrived_at string, payload string, path string, type string"


def table(spark, files):
    rows, i = [], 0
    for day, lines in files:
        for n, x in enumerate(lines):
            rows.append((i, "a", f"a/{day}.jsonl", day, n, f"{day} 10:00", x if isinstance(x, str) or x is None else json.dumps(x), "p", "t"))
            i += 1
    return spark.createDataFrame(rows, SCHEMA)


def changes(df):
    return {(r.file[2:12], r.change, r.field, r.old_field) for r in drift.schema_changes(df).collect()}


def line(i, day, **more):
    return {"schema_version": "1.0.0", "status": ["ok", "held", "ok"][i % 3], "receipt": f"rcpt:a:{day}:{i:03d}", "rows": i % 5} | more


def test_parse_line():
    p = drift.parse_line('{"a": {"b": 1, "c": null}, "d": [1, {"x": 2}], "e": true, "f": "s", "a2": {}}')
    assert sorted((a, b) for a, b, _ in p) == [("a", "object"), ("a.b", "number"), ("a.c", "null"), ("a2", "object"), ("d", "array"), ("e", "boolean"), ("f", "string")]
    for bad in (None, "", "#{}", '{"a": 1', "[1]", "3", '{"a": NaN}', '{"a": 1}{"b": 2}'):
        assert drift.parse_line(bad) is None


def test_added_removed_retyped_renamed(spark):
    def moved(i, day):
        x = line(i, day)
        x["outcome"] = {"status": x.pop("status")}
        x["rid"] = x.pop("receipt")
        x["rows"] = str(x["rows"])
        x["note"] = "by hand"
        return x

    files = [("2026-01-01", [line(i, "2026-01-01") for i in range(6)] + ["", "#broken", None]), ("2026-01-02", [moved(i, "2026-01-02") for i in range(6)]), ("2026-01-03", [{k: v for k, v in moved(i, "2026-01-03").items() if k != "note"} for i in range(6)] + ["{"])]
    assert changes(table(spark, files)) == {
        ("2026-01-02", "renamed", "outcome.status", "status"), ("2026-01-02", "added", "outcome", ""), ("2026-01-02", "renamed", "rid", "receipt"), ("2026-01-02", "retyped", "rows", ""), ("2026-01-02", "added", "note", ""), ("2026-01-03", "removed", "note", ""),
    }


def test_object_renamed_with_its_members(spark):
    a = [("2026-01-01", [line(i, "2026-01-01", frame={"validator": "attest.strict", "n": 40 + i % 9}) for i in range(6)])]
    b = [("2026-01-02", [line(i, "2026-01-02", Frame={"validator": "attest.strict", "n": 40 + i % 9}) for i in range(6)])]
    assert changes(table(spark, a + b)) == {("2026-01-02", "renamed", "Frame", "frame"), ("2026-01-02", "renamed", "Frame.validator", "frame.validator"), ("2026-01-02", "renamed", "Frame.n", "frame.n")}


def test_unlike_contents_are_no_rename(spark):
    a = [("2026-01-01", [line(i, "2026-01-01", code="zone north") for i in range(6)])]
    b = [("2026-01-02", [line(i, "2026-01-02", stamp="2026-05-15") for i in range(6)])]
    assert changes(table(spark, a + b)) == {("2026-01-02", "removed", "code", ""), ("2026-01-02", "added", "stamp", "")}


def test_nulls_have_no_type_and_empty_tables(spark):
    a = [("2026-01-01", [{"x": 1}]), ("2026-01-02", [{"x": None}]), ("2026-01-03", [{"x": "s"}]), ("2026-01-04", ["", None])]
    assert changes(table(spark, a)) == set()
    assert changes(table(spark, [])) == set()


def test_consistent_table(spark):
    day = "2026-01-01"
    files = [(day, [line(i, day, rows_appended=i, target_date=day) for i in range(4)] + ["{"]), ("2026-01-02", [{"rowsAppended": 2 + i, "status": {"code": "ok"}, "target_date": "2026-13-99", "schema_version": "1.0.0", "receipt": "r"} for i in range(5)])]
    df = table(spark, files)
    rows = {r.raw_id: r for r in drift.consistent_table(df.union(df), drift.schema_changes(df)).collect()}
    assert len(rows) == 10
    assert rows[2].rows_appended == 2 and rows[2].status == "ok" and rows[2].failed == []
    assert rows[4].failed == ["(line)"]
    assert rows[5].rows_appended == 2 and rows[5].status == "ok" and rows[5].failed == ["target_date"] and rows[5].target_date is None


def test_consistent_table_has_every_field(spark):
    one, two = "2026-01-01", "2026-01-02"
    before = [line(i, one, frame={"n_samples": 40 + i, "ratio": 0.5 + i}, age_days=100 + i, labels=["a", "b"], reviewed=f"2026-05-1{i}", checks=None, Key="k", key="x") for i in range(6)]
    after = [line(i, two, Frame={"n_samples": 40 + i, "ratio": 0.5 + i, "more": [1, {"x": 2}]}, age_days=str(100 + i) if i else "old", labels="a;b" if i else ["c"], reviewed=20260510 + i if i else "2026-05-10", checks={"passed": i}, Key=["k", "l"] if i else "k") | {"day": "mon"} for i in range(6)]
    df = table(spark, [(one, before), (two, after)])
    t = drift.consistent_table(df, drift.schema_changes(df))
    kinds = dict(t.dtypes)
    assert {c: kinds[c] for c in ("frame.n_samples", "frame.ratio", "frame.more", "age_days", "labels", "reviewed", "checks.passed", "rows", "day#2", "Key", "key#2")} == {
        "frame.n_samples": "bigint", "frame.ratio": "double", "frame.more": "array<string>", "age_days": "bigint", "labels": "array<string>", "reviewed": "date", "checks.passed": "bigint", "rows": "bigint", "day#2": "string", "Key": "string", "key#2": "string",
    }
    assert len({c.lower() for c in t.columns}) == len(t.columns) and not {"frame", "Frame", "checks"} & set(t.columns)
    rows = {r.raw_id: r for r in t.collect()}
    for i, r in rows.items():
        assert (r["frame.n_samples"], r["frame.ratio"], str(r["reviewed"])) == (40 + i % 6, 0.5 + i % 6, f"2026-05-1{i % 6}")
    assert (rows[1]["age_days"], rows[1]["labels"], rows[1]["key#2"], rows[1]["failed"]) == (101, ["a", "b"], "x", [])
    assert (rows[6]["frame.more"], rows[6]["labels"], rows[6]["checks.passed"], rows[6]["day#2"]) == (["1", '{"x":2}'], ["c"], 0, "mon")
    assert rows[6]["failed_values"] == {"age_days": "old"} and rows[7]["failed_values"] == {"labels": "a;b", "Key": '["k","l"]'}
    assert (rows[6]["age_days"], rows[7]["age_days"], rows[7]["labels"]) == (None, 101, None)


def test_names_follow_renames_and_stay_distinct():
    import pandas as pd

    moves = [("2", "state", "status"), ("2", "Frame", "frame"), ("3", "outcome", "state")]
    paths = [("1", "status"), ("1", "frame"), ("1", "frame.n"), ("2", "state"), ("2", "Frame"), ("2", "Frame.n"), ("3", "outcome"), ("3", "status"), ("3", "state"), ("4", "state"), ("4", "status")]
    pdf = pd.DataFrame([(d, d, p, None) for d, p in paths] + [(d, d, p, o) for d, p, o in moves], columns=["day", "file", "path", "old_path"])
    got = drift.name_fields(pdf)
    assert got == ["status", "frame", "frame.n", "status", "frame", "frame.n", "status", "status#2", "state", "state", "status#2"] + [None] * 3


def test_name_agreement():
    assert drift.name_agreement("rows_appended", "rowsAppended") == 1.0
    assert drift.name_agreement("frame.store_sha256", "store_sha256") == 1.0
    assert drift.name_agreement("status", "publication_status") > 0.5
    assert drift.name_agreement("source", "day") == 0.0
