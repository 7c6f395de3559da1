"""Bench: prints one JSON line with seconds per query.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. The document table
is rendered and written first (timed as ``render_documents``); every other
query then runs from written tables, as on a cluster. Everything is run twice
and the better time is kept, so that starting the JVM and compiling a plan for
the first time are not what is measured.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from billsift.plans import registry  # noqa: E402
from billsift.plans.run import Store, run  # noqa: E402
from billsift.session import local_session, new_path  # noqa: E402
from billsift.sources import corpus  # noqa: E402

HEADLINE = [
    "extract_records",
    "extract_tax_total",
    "extract_vendor",
    "page_assembly",
    "dedup_first_wins",
    "load_counts",
    "surrogate_id",
    "load_full_refresh",
    "load_incremental",
    "csv_roundtrip_extracted",
    "extraction_summary",
    "kpi_summary",
    "spend_by_vendor_top10",
    "spend_timeline",
    "explorer_view",
    "review_queue",
    "accuracy_join",
    "match_rate",
    "accuracy_by_field",
    "accuracy_mismatches",
]
RUNS = 2


def _seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cores, app="billsift-bench", shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")

    rendered = corpus.invoice_documents
    first = _seconds(lambda: rendered(spark, sf_dir).write.parquet(new_path(spark, "warm-up")))
    seconds = {"render_documents": min(first, _seconds(lambda: registry.document_table(spark, sf_dir)))}
    documents = registry.document_table(spark, sf_dir)
    n_documents = documents.count()

    def whole_run() -> None:
        base = new_path(spark, "run")
        run(documents, Store(f"{base}/processed", f"{base}/failed", f"{base}/log"))

    seconds["documents_to_loaded_table"] = min(_seconds(whole_run) for _ in range(RUNS))
    for table in (registry.read_table, registry.processed_table, registry.truth_table):
        table(spark, sf_dir)
    for name in HEADLINE:
        query = registry.QUERIES[name]
        seconds[name] = min(
            _seconds(lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save())
            for _ in range(RUNS)
        )
    print(
        json.dumps(
            {
                "metric": "billsift_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "documents": n_documents,
                "extract_documents_per_sec": round(n_documents / seconds["extract_records"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
