"""Streams: newly landed rows through fixed gates, the end of runs from their events, and writes that a repeated batch doesn't double."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from taxaloom.operators.alignment import ungap

TERMINAL = ("completed", "failed")
HOUR = 3_600_000
#: How long, in milliseconds, a run may be silent before it is interrupted, and a run that is over is remembered.
GAP, MEMORY = 6 * HOUR, 7 * 24 * HOUR
ENDS = "run string, first timestamp, last timestamp, events long, status string"
STATE = "first long, last long, events long, over boolean, waiting string"


def landed(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    """Parquet files of a folder (or one file) as a stream, some at a time."""
    pattern = f"{path[:-1]}[{path[-1]}]"  # of a pattern the source doesn't ask that it be a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(pattern)


def gate_sequences(stream: DataFrame, floor: int) -> DataFrame:
    """Rows of a stream (or table) of (taxon_id, seq) at or above a floor that a batch has set; a median that moves would decide
    old rows anew."""
    return stream.where(F.length(ungap("seq")) >= floor)


def once(stream: DataFrame, time: str, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Each key once within the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def write_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what is there, batch by batch, into a folder for each batch: a batch that runs again after a failure replaces what it wrote."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them, by the query's reports."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in json.loads(p.json)["stateOperators"])


def run_ends(events: DataFrame, delay: str = "1 hour", gap: int = GAP, memory: int = MEMORY) -> DataFrame:
    """run, first, last, events, status of each run of a stream (run, ts, status), once, when it is over: with its first terminal event, or
    interrupted, when no event came for ``gap`` after its last.

    Events wait until the watermark has passed them, so that order of arrival doesn't matter; those that the watermark has
    passed before are dropped, and counted (late_rows). What a run sends after it is over changes nothing; it is forgotten after
    ``memory``. State per run: a row, and its events within the watermark's delay.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, n, over, text = state.get if state.exists else (0, 0, 0, False, "[]")
        waiting = [tuple(x) for x in json.loads(text)]
        for b in batches:
            waiting += list(zip((b["ts"].astype("int64") if b["ts"].dtype.kind != "M" else b["ts"].astype("datetime64[ms]").astype("int64")).tolist(), b["status"].tolist(), strict=True))
        now = state.getCurrentWatermarkMs()
        if over:
            if state.hasTimedOut:
                state.remove()
            else:
                state.setTimeoutTimestamp(max(now + 1, last + memory))
            return
        waiting.sort()
        status = None
        while waiting and status is None:
            at, said = waiting[0]
            if n and at > last + gap and now > last + gap:
                status = "interrupted"
            elif at > now:
                break
            else:
                waiting.pop(0)
                first, last, n = (first if n else at), at, n + 1
                status = said if said in TERMINAL else None
        if status is None and n and not waiting and now > last + gap:
            status = "interrupted"
        state.update((first, last, n, status is not None, "[]" if status else json.dumps(waiting)))
        state.setTimeoutTimestamp(max(now + 1, last + memory if status else min([last + gap] * bool(n) + [w[0] for w in waiting[:1]])))
        if status:
            yield pd.DataFrame({"run": [key[0]], "first": pd.to_datetime([first], unit="ms"), "last": pd.to_datetime([last], unit="ms"), "events": [n], "status": [status]})

    keyed = events.select(F.col("run").cast("string").alias("run"), "ts", "status").withWatermark("ts", delay)
    return keyed.groupBy("run").applyInPandasWithState(step, ENDS, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def run_status(events: DataFrame, delay: str = "1 hour", gap: int = GAP) -> DataFrame:
    """What run_ends gives for a table, once all of it has come, and the runs still running.

    Events are summed up by spans of ``gap`` first, within which no run can be silent for too long, so that a run of very many
    events is a few rows where its spans are put in order. A run sends what it sends within the watermark's delay.
    """
    ms = lambda c: F.unix_millis(c)
    e = events.select(F.col("run").cast("string").alias("run"), "ts", "status")
    done = F.when(F.col("status").isin(*TERMINAL), F.struct("ts", "status"))
    spans = e.groupBy("run", F.floor(ms("ts") / gap).alias("span")).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.min(done).alias("done"))
    now = e.agg((F.max("ts") - F.expr(f"INTERVAL {delay}")).alias("now"))
    after = F.lead("lo").over(Window.partitionBy("run").orderBy("span"))
    judged = spans.withColumn("after", after).crossJoin(F.broadcast(now))  # one row
    told = F.col("done").isNotNull() & (F.col("done.ts") <= F.col("now"))
    silent = (ms("now") > ms("hi") + gap) & (F.col("after").isNull() | (ms("after") > ms("hi") + gap))
    end = F.when(told, F.struct("span", F.col("done.ts").alias("ts"), F.col("done.status").alias("status"))).when(F.col("done").isNull() & silent, F.struct("span", F.col("hi").alias("ts"), F.lit("interrupted").alias("status")))
    ends = judged.groupBy("run").agg(F.min(end).alias("e"))
    placed = e.join(ends, "run").where(F.col("e").isNull() | (F.struct("ts", "status") <= F.struct(F.col("e.ts"), F.when(F.col("e.status") == "interrupted", F.lit("￿")).otherwise(F.col("e.status")))))
    return placed.groupBy("run").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("events"), F.coalesce(F.max("e.status"), F.lit("running")).alias("status"))
