"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..functions.session import new_path, small_batches

__all__ = ["drop", "free_name", "save", "scratch", "small_batches", "tidy"]


#: Paths of saved tables, as they were made.
_paths: list[str] = []


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs the rows of its running tasks only, and
    Python stages aren't run again.  Unlike ``checkpoint()`` it computes the plan once, and the
    planner knows the size of what it reads back.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = new_path(spark, name)
    df.write.parquet(path)
    _paths.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop(saved: DataFrame) -> None:
    """Delete a table that ``save`` made and nothing reads any more."""
    _paths.remove(saved._saved_at)
    _delete(saved.sparkSession, saved._saved_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables saved within are deleted at its end, but those that are put into the list it gives."""
    before, kept = len(_paths), []
    try:
        yield kept
    except BaseException:
        kept = []  # a stage that failed leaves nothing
        raise
    finally:
        keep = {x._saved_at for x in kept}
        for path in [p for p in _paths[before:] if p not in keep]:
            _paths.remove(path)
            _delete(spark, path)


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores before it until no column of ``taken`` has it (whatever its case)."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which at its end gives freed memory back to the system: Python workers stay alive between
    tasks, and what they keep counts against the executor."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
        if trim:
            trim(0)

    return tidied
