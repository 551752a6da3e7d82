"""Streams of files against the table at once: gates, ends of runs by timers, late rows, restarts from the checkpoint."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from taxaloom.streaming import monitor

START = datetime(2024, 5, 1, tzinfo=timezone.utc)
EVENTS = "run string, ts timestamp, status string"


def at(hours):
    return START + timedelta(hours=hours)


def land(spark, folder, rows, name, schema=EVENTS):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder, schema=EVENTS):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def ends(df):
    """Rows in milliseconds, in which the stream counts."""
    ms = lambda t: int(t.timestamp() * 1000)
    return sorted((r["run"], ms(r["first"]), ms(r["last"]), r["events"], r["status"]) for r in df.collect())


def run(spark, tmp_path):
    query = monitor.write_once(monitor.run_ends(stream(spark, f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    return monitor.late_rows(query)


def test_runs_end_once_and_a_restart_goes_on(spark, tmp_path):
    land(spark, f"{tmp_path}/in", [("a", at(0), "running"), ("b", at(0.5), "running"), ("b", at(1), "completed"), ("b", at(1.2), "running"), ("c", at(1), "running")], "one")
    run(spark, tmp_path)
    out = lambda: ends(spark.read.schema(monitor.ENDS).parquet(f"{tmp_path}/out"))
    assert out() == []  # the watermark has not passed the end of b
    land(spark, f"{tmp_path}/in", [("c", at(3), "running"), ("d", at(3.5), "running"), ("c", at(2), "running")], "two")
    run(spark, tmp_path)
    assert [(r[0], r[3], r[4]) for r in out()] == [("b", 2, "completed")]
    land(spark, f"{tmp_path}/in", [("d", at(9), "failed"), ("d", at(10.2), "running"), ("a", at(10.5), "completed")], "three")
    run(spark, tmp_path)
    # a and c were silent for over six hours: their timers end them, and a's late terminal event changes nothing
    assert [(r[0], r[3], r[4]) for r in out()] == [("a", 1, "interrupted"), ("b", 2, "completed"), ("c", 3, "interrupted"), ("d", 2, "failed")]
    land(spark, f"{tmp_path}/in", [("a", at(2), "completed"), ("e", at(40), "running")], "four")
    assert run(spark, tmp_path) == 1  # the row at 2 h came after the watermark
    assert [(r[0], r[3], r[4]) for r in out()] == [("a", 1, "interrupted"), ("b", 2, "completed"), ("c", 3, "interrupted"), ("d", 2, "failed")]
    run(spark, tmp_path)  # nothing new: nothing is written twice
    assert len(out()) == 4


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_table(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(f"r{rng.randrange(12)}", at(rng.random() * 90), rng.choices(["running", "completed", "failed"], weights=[30, 1, 1])[0]) for _ in range(400)]
    rows = sorted(rows, key=lambda r: r[1] + timedelta(minutes=rng.random() * 50))  # within the watermark's delay
    for i in range(0, len(rows), 80):
        land(spark, f"{tmp_path}/in", rows[i : i + 80], f"part{i:04d}")
        run(spark, tmp_path)
    got = ends(spark.read.schema(monitor.ENDS).parquet(f"{tmp_path}/out"))
    table = monitor.run_status(spark.createDataFrame(rows, EVENTS))
    assert got == ends(table.where("status <> 'running'"))
    by_run, now = {}, max(r[1] for r in rows) - timedelta(hours=1)
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by_run.setdefault(r[0], []).append(r)
    want = []
    for name, own in by_run.items():
        for k, (_, t, s) in enumerate(own):
            after = own[k + 1][1] if k + 1 < len(own) else None
            silent = now > t + timedelta(hours=6) and (after is None or after > t + timedelta(hours=6))
            if (s != "running" and t <= now) or (s == "running" and silent):
                want.append((name, own[0][1], t, k + 1, "interrupted" if s == "running" else s))
                break
    assert [(r[0], r[3], r[4]) for r in got] == sorted((r[0], r[3], r[4]) for r in want)


def test_gate_and_dedupe_as_a_stream(spark, tmp_path):
    schema = "taxon_id string, seq string, ts timestamp"
    land(spark, f"{tmp_path}/in", [("a", "AC-GT", at(0)), ("b", "AC", at(0)), ("c", "ACGT", at(0.1))], "one", schema)
    land(spark, f"{tmp_path}/in", [("a", "ACGT", at(0.2)), ("d", "ACGTT", at(0.3))], "two", schema)
    gated = monitor.once(monitor.gate_sequences(stream(spark, f"{tmp_path}/in", schema), 4), "ts", ["taxon_id"]).select("taxon_id")
    monitor.write_once(gated, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    table = monitor.gate_sequences(spark.read.schema(schema).parquet(f"{tmp_path}/in/*"), 4)
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/out").select("taxon_id").collect()) == sorted(r[0] for r in table.select("taxon_id").distinct().collect()) == ["a", "c", "d"]


def test_a_batch_that_runs_again_replaces_what_it_wrote(spark, tmp_path):
    land(spark, f"{tmp_path}/in", [("a", at(0), "running")], "one")
    for checkpoint in ("lost", "new"):  # the checkpoint is lost, so the batch runs again
        monitor.write_once(stream(spark, f"{tmp_path}/in").select("run"), f"{tmp_path}/out", f"{tmp_path}/{checkpoint}").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").select(F.count("*")).first()[0] == 1
