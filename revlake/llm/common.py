"""What the operators of this subpackage share: the folder all executors see, stored steps, Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes that an Arrow batch sent to Python has at most; a row over the bytes is a batch of its own. They are the same for all operators.
BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where that is unset a local master gets a folder of its own; a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run of an operator under the shared one. The caller may delete it when the result is read."""
    return f"{shared_dir(spark)}/revlake-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the lineage, survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound what one Python worker holds at a time. Spark has these limits by session only and reads them when a plan runs, so
    they stay set; limits that the user has set lower stay as they are."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        found = int(re.sub(r"\D", "", spark.conf.get(name)) or 0)
        if not 0 < found <= most:
            spark.conf.set(name, str(most))


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; at its end the worker, which Spark uses again, gives its free memory back to the system."""

    @wraps(run)
    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return within


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
