"""Streams over stored files, batch by batch: state across batches, late rows, upserts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from scholarlake.operators import hosts
from scholarlake.sources import readers, writers
from scholarlake.streaming import refusals


def _run(spark, place, batches, schema, make, mode="append"):
    """Each batch as a file of its own, read one at a time."""
    folder = place / "in"
    folder.mkdir()
    for i, rows in enumerate(batches):
        (folder / f"{i}.json").write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(folder / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))  # the order in which they are read
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    out = make(stream)
    query = out.writeStream.format("parquet").option("checkpointLocation", f"{place}/checkpoint").option("path", f"{place}/out").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{place}/out").collect()


def test_refusals_keep_their_window_across_batches(spark, tmp_path):
    times = [0.0, 1000.0, 100_000.0, 8 * 86_400.0, 8 * 86_400.0 + 5]
    batches = [[{"host": "a.org", "at": t} for t in times[:2]], [{"host": "a.org", "at": times[2]}, {"host": "b.org", "at": 7.0}], [{"host": "a.org", "at": t} for t in times[3:]]]
    got = _run(spark, tmp_path, batches, "host string, at double", refusals.refusal_stream)
    rows = spark.createDataFrame([(x["host"], x["at"]) for b in batches for x in b], "host string, at double")
    whole = hosts.refusal_ladder(rows).collect()
    key = lambda r: (r.host, r.at, r.recent, r.cooloff, r.blocked_until, r.newly)
    assert sorted(map(key, got)) == sorted(map(key, whole))


def test_ingest_drops_repeats_of_an_id_and_keeps_rows_without(spark, tmp_path):
    at = "2026-01-01T00:0{}:00Z".format
    batches = [
        [{"cat": "a", "paperId": "p", "fetched_at": at(0)}, {"cat": "a", "paperId": None, "fetched_at": at(0)}, {"cat": "a", "paperId": " ", "fetched_at": at(0)}],
        [{"cat": "a", "paperId": "p", "fetched_at": at(1)}, {"cat": "b", "paperId": "p", "fetched_at": at(1)}, {"cat": "a", "paperId": None, "fetched_at": at(1)}],
    ]
    got = _run(spark, tmp_path, batches, "cat string, paperId string, fetched_at timestamp", refusals.ingest)
    assert sorted((r.cat, r.paperId or "") for r in got) == [("a", ""), ("a", ""), ("a", " "), ("a", "p"), ("b", "p")]


def test_windows_count_late_rows_until_the_watermark(spark, tmp_path):
    rows = lambda *times: [{"ts": f"2026-01-01T{t}:00Z", "kind": "k"} for t in times]
    batches = [rows("00:10", "00:50"), rows("01:05", "00:58"), rows("03:00"), rows("03:05"), rows("00:20"), rows("05:00")]
    got = _run(spark, tmp_path, batches, "ts timestamp, kind string", lambda s: refusals.windowed_counts(s, "ts", "kind"))
    counts = {r.start.hour: r.n for r in got}
    # 00:58 came within ten minutes of 01:05; 00:20 after 03:00 did not
    assert counts[0] == 3 and counts[1] == 1 and counts[3] == 2


@pytest.mark.parametrize("fold_after", [2, 100])
def test_upserts_keep_the_latest_row(spark, tmp_path, fold_after):
    path = f"{tmp_path}/t"
    batches = [[("a", 1, "x"), ("b", 1, "x")], [("a", 3, "y"), ("a", 2, "z")], [("c", 1, "x")], [("b", 0, "late")]]
    for rows in batches:
        refusals.upsert(spark.createDataFrame(rows, "k string, at int, v string"), path, ["k"], "at", fold_after)
    assert sorted(tuple(r) for r in refusals.current(spark, path, ["k"], "at").collect()) == [("a", 3, "y"), ("b", 1, "x"), ("c", 1, "x")]
    bases = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("b")]
    assert bool(bases) == (fold_after == 2)
    (tmp_path / "t" / "v99").mkdir()  # a write that was lost
    assert refusals.current(spark, path, ["k"], "at").count() == 3
    with pytest.raises(ValueError):
        refusals.current(spark, f"{tmp_path}/none", ["k"], "at")


def test_documents_are_replaced_whole(spark, tmp_path):
    for value in ({"a": 1}, {"a": "é"}):
        writers.document(spark, f"{tmp_path}/d/x.json", value)
    assert json.loads((tmp_path / "d" / "x.json").read_text()) == {"a": "é"}
    assert not [p for p in (tmp_path / "d").iterdir() if p.name.endswith(".tmp")]


def test_query_files_and_refusals_on_any_path(spark, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps({"queries": {"a": {"query": "x", "year": 2020}}}))
    assert readers.queries(spark, f"file://{tmp_path}/q.json").first().params == {"year": "2020"}
    rows = spark.createDataFrame([("a", 0.0, "r"), ("b", 700_000.0, "r")], "host string, at double, reason string")
    writers.refusal_history(rows, f"{tmp_path}/r", 700_001.0)
    assert [r.host for r in spark.read.parquet(f"{tmp_path}/r").select(F.col("host")).collect()] == ["b"]
