"""Tables kept in the shared folder between the steps of an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billsift.session import new_path


def kept(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it from there.

    A lost executor then costs no second run of what made it, and the plan of
    what follows stays short.
    """
    path = new_path(frame.sparkSession, f"llm-{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


BROADCAST_IDS = 1_000_000


def small(ids: DataFrame) -> DataFrame:
    """A written table of ids, to be sent to all tasks if it is short; else joins shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session have at most ``BATCH_ROWS`` rows.

    Rows here are texts or packed blocks, and the default of 10,000 of them takes more
    memory on both sides of a Python worker than the work. A lower setting is kept.
    """
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
