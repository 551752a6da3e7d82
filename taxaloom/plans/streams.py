"""Queries H: what streams of the given tables' files give, and the same from the tables at once."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from taxaloom.plans import adapters as ad
from taxaloom.session import shared_folder, table
from taxaloom.streaming import monitor

FLOOR = 120


def _ran(spark, stream):
    """The table that a stream leaves when all that has landed is read."""
    place = f"{shared_folder(spark)}/{uuid4().hex}"
    monitor.write_once(stream, f"{place}/out", f"{place}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{place}/out").select(*stream.columns)


def h1_gate_sequences(spark, d):
    return monitor.gate_sequences(ad.sequences(spark, d), FLOOR).select("taxon_id")


def h1_gate_stream(spark, d):
    landed = monitor.landed(spark, f"{d}/documents.parquet", table(spark, d, "documents").schema)
    return _ran(spark, monitor.gate_sequences(ad.as_sequences(landed), FLOOR).select("taxon_id"))


def _events(e):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed").otherwise("running")
    return e.select(F.col("user_id").cast("string").alias("run"), F.col("ts").cast("timestamp").alias("ts"), status.alias("status"))


def _shown(df):
    return df.select("run", F.unix_millis("first").alias("first"), F.unix_millis("last").alias("last"), "events", "status")


def h2_run_status(spark, d):
    return _shown(monitor.run_status(_events(table(spark, d, "events"))))


def h2_run_ends_stream(spark, d):
    landed = monitor.landed(spark, f"{d}/events.parquet", table(spark, d, "events").schema)
    return _shown(_ran(spark, monitor.run_ends(_events(landed))))


QUERIES = {f.__name__: f for f in (h1_gate_sequences, h1_gate_stream, h2_run_status, h2_run_ends_stream)}

_GATE = f"WITH {ad.SEQUENCES} SELECT taxon_id FROM sequences WHERE length(seq) >= {FLOOR}"
_STATUS = f"""WITH e AS (SELECT user_id::VARCHAR AS run, epoch_us(ts) // 1000 AS t, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' ELSE 'running' END AS status FROM events),
now AS (SELECT max(t) - {monitor.HOUR} AS now FROM e),
placed AS (SELECT *, row_number() OVER w AS k, lead(t) OVER w AS after FROM e WINDOW w AS (PARTITION BY run ORDER BY t, status)),
ends AS (SELECT run, arg_min(k, k) AS k, arg_min(CASE WHEN status <> 'running' THEN status ELSE 'interrupted' END, k) AS status FROM placed, now
  WHERE (status <> 'running' AND t <= now) OR (status = 'running' AND now > t + {monitor.GAP} AND (after IS NULL OR after > t + {monitor.GAP})) GROUP BY run)
SELECT p.run, min(t) AS first, max(t) AS last, count(*) AS events, coalesce(any_value(e.status), 'running') AS status FROM placed p LEFT JOIN ends e USING (run) WHERE e.k IS NULL OR p.k <= e.k GROUP BY p.run"""
SQL = {"h1_gate_sequences": _GATE, "h1_gate_stream": _GATE, "h2_run_status": _STATUS, "h2_run_ends_stream": f"SELECT * FROM ({_STATUS}) WHERE status <> 'running'"}
