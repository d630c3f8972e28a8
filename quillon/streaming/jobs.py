"""Streams over the same expressions as the batch jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.scalar import FOUR_LAYER, combine, finite
from ..sources import published


def score_rows(rows: DataFrame) -> DataFrame:
    """The row-wise part of scoring: combine the layers, mark rows that lack one."""
    ok = None
    for c in FOUR_LAYER:
        here = finite(F.col(c)).isNotNull()
        ok = here if ok is None else ok & here
    return rows.withColumn("final_score", F.when(ok, combine(FOUR_LAYER))).withColumn("status", F.when(ok, "ok").otherwise("failed:missing_layer"))


def stream_scores(spark: SparkSession, folder: str, schema: StructType, *, key: str, seen: str, delay: str = "1 hour", cache: DataFrame | None = None) -> DataFrame:
    """Scores of a drop folder's rows as they come; repeated keys within the delay are dropped.

    ``cache`` has target-independent layers and is joined as a static table.
    """
    rows = spark.readStream.schema(schema).parquet(folder).withWatermark(seen, delay).dropDuplicatesWithinWatermark([key])
    if cache is not None:
        rows = rows.join(cache, "part_key", "left")
    return score_rows(rows)


def stage_state(events: DataFrame) -> DataFrame:
    """Latest status, attempts, start and finish per (run, stage); for batches and streams alike.

    Of events at one time the largest id counts as the latest.
    """
    latest = F.max(F.struct("ts", "event_id", "status"))
    return events.groupBy("run", "stage").agg(
        latest["status"].alias("status"), F.count_if(F.col("status") == "started").alias("attempts"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n_events")
    )


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop; a restart goes on from the checkpoint."""
    return df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def attach_layers(rows: DataFrame, layers: str, out: str, parked: str, checkpoint: str, *, key: str, score: Callable[[DataFrame], DataFrame] = score_rows) -> StreamingQuery:
    """Join a stream with the published table ``layers``, which changes meanwhile, and process what is there.

    Each micro-batch reads the newest version of ``layers``.  Rows that find their key are scored and written to
    ``out``, a folder for each batch; the others are parked in a published table and tried again with every
    later batch.  A batch that is run again replaces its own folder, and parked rows carry the number of the batch
    they were left by, so nothing is scored twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        waiting = published.current(spark, parked)
        if waiting and int(waiting["note"]) >= number:
            return
        both = batch.unionByName(published.read(spark, parked)) if waiting else batch
        known = published.read(spark, layers).withColumn("_known", F.lit(True))
        found = both.join(known, key, "left")
        score(found.filter("_known")).drop("_known").write.mode("overwrite").parquet(f"{out}/batch={number:09d}")
        published.publish(found.filter("_known is null").select(*batch.columns), parked, note=str(number))
        published.vacuum(spark, parked, keep=1)

    return rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
