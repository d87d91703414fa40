import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import readers, sinks
from tallyloom.streaming import pipelines


def test_coded_events_from_zip(spark, tmp_path):
    def row(**at):
        cells = [""] * 58
        for n, v in at.items():
            cells[readers.EVENT_FIELDS[n]] = str(v)
        return "\t".join(cells)

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", "\n".join([row(actor1="IND", actor2="PAK", quad_class=4, goldstein=-10, mentions=5), row(actor1="USÉ", goldstein="n/a"), "short\trow"]).encode("latin-1"))
    got = readers.coded_events(readers.zipped_lines(spark, str(tmp_path / "*.zip"))).collect()
    assert [(r.actor1, r.quad_class, r.goldstein, r.mentions) for r in got] == [("IND", 4, -10.0, 5), ("USÉ", None, None, None)]


def test_wide_cells(spark):
    rows = [("POL", "Iraq", "4", "0", "NA", "1,200", "-", "x")]
    got = {r.member: (r.quantity, r.status) for r in readers.wide_cells(spark.createDataFrame(rows, ["c", "country", "a", "b", "d", "e", "f", "g"]), ["c", "country"], list("abdefg")).collect()}
    assert got == {"a": (4.0, "positive"), "b": (0.0, "zero"), "d": (None, "missing"), "e": (1200.0, "positive"), "f": (0.0, "zero"), "g": (None, "unreadable")}


def test_html_and_feed(spark, tmp_path):
    page = "<table><tr><th>Item</th><td> <b>1,2</b>&nbsp;3 </td></tr></table>"
    assert spark.createDataFrame([(page,)], "h string").select(readers.html_cells(F.col("h"))).first()[0] == ["Item", "1,2 3"]
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>A</title><link>u</link><pubDate>Mon, 01 Jan 2024 05:00:00 GMT</pubDate></item><item><title>B</title><link>v</link><pubDate>soon</pubDate></item></channel></rss>")
    got = [(r.title, str(r.published)) for r in readers.feed_items(spark, str(tmp_path / "f.xml")).orderBy("title").collect()]
    assert got[0][0] == "A" and got[0][1].startswith("2024-01-01") and got[1] == ("B", "None")


def test_chunk_source(spark, tmp_path):
    q = "coast guard"
    (tmp_path / (readers.chunk_name(q, "2024-01-01", "2024-01-10") + ".json")).write_text(json.dumps([{"date": "20240101T010000Z", "value": 2.0}, {"date": "20240101T000000Z", "value": 1.0}]))
    (tmp_path / (readers.chunk_name(q, "2024-01-21", "2024-01-25") + ".json")).write_text(json.dumps([{"date": "20240121T000000Z", "value": 3.0}]))
    spark.dataSource.register(readers.ChunkSource)
    df = spark.read.format("timeline_chunks").options(folder=str(tmp_path), query=q, start="2024-01-01", end="2024-01-25", days="10").load()
    assert df.count() == 3
    assert [(str(r.d), r.value) for r in readers.first_of_day(df).orderBy("d").collect()] == [("2024-01-01", 1.0), ("2024-01-21", 3.0)]


def test_archive_is_append_only(spark, tmp_path):
    path = str(tmp_path / "archive")
    day = lambda d: spark.createDataFrame([(d, 1)], "d string, v int")
    sinks.append_day(spark, path, day("2024-01-01"))
    sinks.append_day(spark, path, day("2024-01-02"))
    with pytest.raises(sinks.ArchiveError):
        sinks.append_day(spark, path, day("2024-01-02"))
    with pytest.raises(sinks.ArchiveError):
        sinks.append_day(spark, path, day("2024-01-03").union(day("2024-01-04")))
    assert spark.read.parquet(path).count() == 2
    assert sinks.rolling_archive(day("2024-01-01").union(day("2024-01-05")), 3).count() == 1


def test_bundle_seal_and_manifest(spark, tmp_path):
    assert sinks.bundle({"b": b"2", "a": b"1"}) == sinks.bundle({"a": b"1", "b": b"2"})
    s = sinks.seal({"x": 1, "y": "é"})
    assert sinks.sealed(s) and not sinks.sealed(s | {"x": 2})
    with pytest.raises(ValueError):
        sinks.canonical_json({"x": float("nan")})
    (tmp_path / "f.bin").write_bytes(b"abc")
    assert sinks.byte_manifest(spark, str(tmp_path)).first().sha256.startswith("ba7816bf")
    assert json.loads(sinks.parallel_arrays(spark.createDataFrame([(2, "b"), (1, "a")], "i int, v string"), "i", ["v"]).first().payload) == {"i": [1, 2], "v": ["a", "b"]}


def events(spark, tmp_path, rows, name):
    path = str(tmp_path / name)
    for i, part in enumerate(rows):
        spark.createDataFrame(part, "user_id bigint, ts string, event_type string, high boolean").withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(f"{path}")
    return pipelines.event_time(pipelines.read_events(spark, path), "1 hour")


def test_windows_and_sessions_close_behind_the_watermark(spark, tmp_path):
    rows = [[(1, "2024-01-01 00:05:00", "a", True), (1, "2024-01-01 00:20:00", "a", True)], [(1, "2024-01-01 02:00:00", "b", False)], [(2, "2024-01-03 00:00:00", "a", False)]]
    s = events(spark, tmp_path, rows, "w")
    got = {(str(r.start), r.event_type, r.n) for r in pipelines.run_available(pipelines.tumbling_counts(s), "t_windows").collect()}
    assert ("2024-01-01 00:00:00", "a", 2) in got and not any(x[0].startswith("2024-01-03") for x in got)
    got = {(r.user_id, r.n) for r in pipelines.run_available(pipelines.sessions(s, "1 hour"), "t_sessions").collect()}
    assert got == {(1, 2), (1, 1)}


def test_first_deliveries_and_alerts(spark, tmp_path):
    rows = [[(1, "2024-01-01 00:05:00", "a", True), (1, "2024-01-01 00:06:00", "a", True)], [(1, "2024-01-01 00:10:00", "a", False), (2, "2024-01-01 00:10:00", "b", False)]]
    s = events(spark, tmp_path, rows, "d")
    assert pipelines.run_available(pipelines.first_deliveries(s, "user_id"), "t_first").count() == 2
    got = pipelines.run_available(pipelines.level_alerts(s), "t_alerts").orderBy("user_id", "ts").collect()
    assert [(r.user_id, r.state) for r in got] == [(1, True), (1, False), (2, False)]


def test_only_complete_days_are_promoted(spark, tmp_path):
    rows = [[(1, f"2024-01-01 {h:02d}:{m:02d}:00", "a", True) for h in range(24) for m in (0, 30)], [(1, "2024-01-02 00:00:00", "a", True)], [(1, "2024-01-04 00:00:00", "a", True)]]
    s = events(spark, tmp_path, rows, "p")
    sink = pipelines.promote_days(str(tmp_path / "slots"), str(tmp_path / "final"))
    q = pipelines.day_slots(s).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [str(r.d) for r in spark.read.parquet(str(tmp_path / "final")).collect()] == ["2024-01-01"]
