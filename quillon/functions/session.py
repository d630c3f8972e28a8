"""What jobs need of the session: the shared folder, and Arrow batches for wide rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes that a Python worker gets at once; the session's defaults suit narrow rows.
BATCH_ROWS, BATCH_BYTES = 1000, "8m"
#: Rows and shuffled bytes of a task.
TASK_ROWS, TASK_BYTES = 250_000, 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``.

    A temporary folder is taken only where the session names none (tests on one machine).
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else has."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and kept when executors are lost."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches for rows with long texts, unless they are smaller already."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def enough_partitions(df: DataFrame) -> DataFrame:
    """``df``, with the session's shuffles wide enough for its rows: a task's share, and with it the memory of its
    sorts, stays the same however large the input.  ``df`` is a table as it lies in files, so rows are counted in footers.

    More partitions are set where there are fewer, and adaptive execution joins small ones up to TASK_BYTES only.
    """
    conf, rows = df.sparkSession.conf, df.count()
    parts = -(-rows // TASK_ROWS)
    if parts > int(conf.get("spark.sql.shuffle.partitions")):
        conf.set("spark.sql.shuffle.partitions", str(parts))
    if rows > TASK_ROWS:
        conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
    return df
