"""Keyed state over event streams: what each (run, stage) has come to, with a timer for stuck stages.

State is one row per key in Spark's state store, whatever the number of events.  Events that come again are
dropped by their id, and events older than the watermark are left out; both hold for as long as ``delay``.
A restart goes on from the checkpoint: a micro-batch that was cut off is run again with the same events and
state, and the table it writes takes each batch once.

``track`` calls Python for each key that a micro-batch has events of, and gives a row for each change, timers
included.  ``totals`` keeps the same state by Spark's own aggregation, without Python; what is stuck then follows from
the state as it stands (``stuck_now``).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources import published

KEYS = ("run", "stage")
CHANGE = "run long, stage string, status string, attempts long, first_us long, last_us long, n_events long, stuck boolean, change_no long"
STATE = "status string, status_us long, status_id long, attempts long, first_us long, last_us long, n_events long, change_no long"
#: Fold of nothing.
EMPTY = ("", -(2**63), -(2**63), 0, 2**63 - 1, -(2**63), 0, 0)


def fold(state: tuple, events: pd.DataFrame) -> tuple:
    """State after more events, in any order: the latest status (ties by event id), attempts and so on."""
    status, status_us, status_id, attempts, first, last, n, change = state
    us = events["us"].to_numpy()
    at = us.max()
    latest = events[us == at]
    latest = latest.loc[latest["event_id"].idxmax()]
    if (int(at), int(latest["event_id"])) > (status_us, status_id):
        status, status_us, status_id = latest["status"], int(at), int(latest["event_id"])
    return status, status_us, status_id, attempts + int((events["status"] == "started").sum()), min(first, int(us.min())), max(last, int(at)), n + len(events), change


def _whole(events: DataFrame, delay: str) -> DataFrame:
    """Events with a key, time and id, each once; those behind the watermark are left out."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    whole = timed.dropna(subset=[*KEYS, "ts", "event_id"]).withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    return whole.select("run", "stage", "ts", "event_id", F.coalesce("status", F.lit("")).alias("status"), F.unix_micros("ts").alias("us"))


def track(events: DataFrame, *, delay: str = "1 day", stuck_after: str = "1 day") -> DataFrame:
    """A row for each change of a key's state: status, attempts, first and last event, number of events.

    ``events`` is a stream of (run, stage, ts, event_id, status).  ``change_no`` counts the changes of a key; the
    highest is its state now.  ``stuck`` is set by a timer when a started stage had no event for ``stuck_after``
    by the watermark, and unset by its next event.  Rows without a key, time or id are left out.
    """
    rows = _whole(events, delay)
    wait = int(pd.Timedelta(stuck_after).total_seconds() * 1000)

    def follow(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        now: tuple[Any, ...] = held.get if held.exists else EMPTY
        stuck = held.hasTimedOut
        if not stuck:
            for events in frames:
                now = fold(now, events)
        now = (*now[:-1], now[-1] + 1)
        held.update(now)
        if not stuck and now[0] == "started":
            held.setTimeoutTimestamp(max(now[5] // 1000 + wait, held.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"run": [key[0]], "stage": [key[1]], "status": [now[0]], "attempts": [now[3]], "first_us": [now[4]], "last_us": [now[5]], "n_events": [now[6]], "stuck": [stuck], "change_no": [now[7]]})

    out = rows.groupBy(*KEYS).applyInPandasWithState(follow, CHANGE, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    times = [F.timestamp_micros(f"{x}_us").alias(f"{x}_ts") for x in ("first", "last")]
    return out.select(*KEYS, "status", "attempts", *times, "n_events", "stuck", "change_no")


def totals(events: DataFrame, *, delay: str = "1 day") -> DataFrame:
    """The state of each key that a micro-batch has events of, as ``track`` has it but for ``stuck``.

    ``change_no`` is the number of the key's events, which grows with each change.
    """
    latest = F.max(F.struct("us", "event_id", "status"))
    out = _whole(events, delay).groupBy(*KEYS).agg(latest["status"].alias("status"), F.count_if(F.col("status") == "started").alias("attempts"), F.min("us").alias("_first"), F.max("us").alias("_last"), F.count("*").alias("n_events"))
    times = [F.timestamp_micros(f"_{x}").alias(f"{x}_ts") for x in ("first", "last")]
    return out.select(*KEYS, "status", "attempts", *times, "n_events", F.col("n_events").alias("change_no"))


def stuck_now(kept: DataFrame, *, delay: str = "1 day", stuck_after: str = "1 day") -> DataFrame:
    """The states that ``totals`` has led to, with ``stuck``: started last, and without an event for ``stuck_after`` by
    the watermark, which is ``delay`` behind the last event of all."""
    both = int((pd.Timedelta(delay) + pd.Timedelta(stuck_after)).total_seconds() * 1000)
    end = kept.agg(F.unix_millis(F.max("last_ts")).alias("_end"))  # one row
    late = F.unix_millis("last_ts") + both < F.col("_end")
    return kept.crossJoin(F.broadcast(end)).withColumn("stuck", (F.col("status") == "started") & late).drop("_end")


def keep_state(changes: DataFrame, path: str, checkpoint: str, *, buckets: int = 32, mode: str = "append", tasks: int | None = None) -> StreamingQuery:
    """Process what is there, keep the newest change of each key in a published table, and stop.

    A batch that was published before it was marked as done is not taken twice: versions carry its number.
    ``mode`` is ``append`` for ``track`` and ``update`` for ``totals``.  ``tasks`` is the number of parts that the state is
    dealt into, which stays what it was when the checkpoint was made: each part costs files in each batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version = published.current(spark, path)
        if version and version["note"] and int(version["note"]) >= number:
            return
        value = F.struct(*[c for c in batch.columns if c not in KEYS])
        newest = batch.groupBy(*KEYS).agg(F.max_by(value, "change_no").alias("_v")).select(*KEYS, "_v.*")
        published.upsert(newest, path, keys=KEYS, buckets=buckets, note=str(number))
        published.vacuum(spark, path)

    conf, wide = changes.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(wide)
    try:
        conf.set(wide, str(tasks or before))  # a stream has its own copy of the session from its start on
        return changes.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(wide, before)


def state_now(spark: SparkSession, path: str) -> DataFrame:
    return published.read(spark, path)
