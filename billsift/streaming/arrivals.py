"""Documents that keep arriving.

Extraction needs no state, so the batch operator runs unchanged on a stream of
new document files. Records and failures go to one append-only table, which a
load reads like the staged output of a batch run.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from billsift import schemas
from billsift.operators.extract import read_documents


def read_arrivals(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Read all document files not seen before, then stop.

    ``checkpoint`` and ``out`` must be on storage all executors share; together
    they give each file exactly one place in the output.
    """
    arrivals = spark.readStream.schema(schemas.DOCUMENTS).parquet(folder)
    return (
        read_documents(arrivals)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
