"""One run: documents to the loaded table, with quarantine and audit row."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from billsift import schemas
from billsift.operators import extract, metrics
from billsift.session import discard, new_path
from billsift.sources import tables


@dataclass
class Store:
    """Where a run keeps its results; all folders must be shared by the executors."""

    processed: str
    failed: str
    run_log: str


def stage(read: DataFrame, path: str) -> DataFrame:
    """Write the extraction once to the shared folder and read it from there.

    Records, failures and all counts then read a few columns of a written
    table. Losing executors costs no second extraction.
    """
    read.write.parquet(path)
    return read.sparkSession.read.schema(schemas.READ).parquet(path)


def run(documents: DataFrame, store: Store, incremental: bool = False) -> DataFrame:
    """Extract, set failures aside, load, log; errors are raised, not swallowed.

    Returns the run log. A run without any readable document loads nothing.
    """
    started, clock = datetime.now(timezone.utc), time.perf_counter()
    spark = documents.sparkSession
    run_id = tables.next_run_id(spark, store.run_log)
    staged = new_path(spark, "read")
    read = stage(extract.read_documents(documents), staged)
    entry = metrics.run_summary(read).first().asDict()
    tables.write_failures(extract.failures(read), store.failed, run_id, incremental)
    entry["invoices_loaded"] = 0
    if entry["invoices_found"] > entry["invoices_failed"]:
        entry["invoices_loaded"] = tables.load_batch(extract.records(read), store.processed, incremental)
    else:
        entry["notes"] = "No readable documents."
    discard(spark, staged)
    times = {"id": run_id, "run_at": started, "duration_seconds": round(time.perf_counter() - clock, 3)}
    return tables.append_run_log(spark, store.run_log, entry | times)
