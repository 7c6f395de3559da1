"""A whole run, its repetition, and the same extraction on a stream."""

from pathlib import Path

import pytest

from billsift import schemas
from billsift.operators import extract
from billsift.plans.run import Store, run
from billsift.session import new_path, shared_root
from billsift.sources import tables
from billsift.streaming.arrivals import read_arrivals

GOOD = "Acme Works\nTAX INVOICE\nInvoice No: {0}\nDate: 01-02-2024\nSubtotal: 100\nGST (18%): 18\nGrand Total: {1}"


def batch(spark, rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schemas.DOCUMENTS)


ROWS = [
    ("a.pdf", GOOD.format("INV-1", 118), None),
    ("b.pdf", "  \n ", GOOD.format("INV-2", 218)),
    ("c.pdf", GOOD.format("INV-1", 118), "ignored"),
    ("d.pdf", None, " "),
    ("e.pdf", "Plain words", None),
]


@pytest.fixture
def store(spark):
    base = new_path(spark, "store")
    return Store(f"{base}/processed", f"{base}/failed", f"{base}/log")


def test_full_run(spark, store):
    log = run(batch(spark, ROWS), store).first()
    assert (log.id, log.invoices_found, log.invoices_loaded, log.invoices_failed) == (1, 5, 3, 1)
    assert (log.n_high_conf, log.n_low_conf, log.n_missing_conf, log.notes) == (3, 0, 1, "SUCCESS")
    assert log.duration_seconds > 0
    rows = tables.read_processed(spark, store.processed).orderBy("id").collect()
    assert [(r.id, r.source_file, r.invoice_id, r.extraction_method, r.validation_passed) for r in rows] == [
        (1, "a.pdf", "INV-1", "text_layer", 1),
        (2, "b.pdf", "INV-2", "ocr", 0),
        (3, "e.pdf", None, "text_layer", 1),
    ]
    failed = spark.read.parquet(store.failed).collect()
    assert [(r.source_file, r.reason, r.run_id) for r in failed] == [("d.pdf", extract.NO_TEXT, 1)]


def test_incremental_run_after_full_run(spark, store):
    run(batch(spark, ROWS[:1]), store)
    log = run(batch(spark, ROWS), store, incremental=True).orderBy("id").collect()
    assert [(r.id, r.invoices_found, r.invoices_loaded) for r in log] == [(1, 1, 1), (2, 5, 2)]


def test_a_run_leaves_no_scratch_tables(spark, store):
    scratch = lambda: {p.name for p in Path(shared_root(spark)).iterdir() if p.name.startswith(("read-", "ordered-"))}
    before = scratch()
    run(batch(spark, ROWS), store)
    run(batch(spark, ROWS), store, incremental=True)
    assert scratch() == before


def test_incremental_runs_from_nothing(spark, store):
    run(batch(spark, ROWS[:1]), store, incremental=True)
    log = run(batch(spark, ROWS), store, incremental=True).orderBy("id").collect()
    assert [(r.id, r.invoices_found, r.invoices_loaded, r.invoices_failed) for r in log] == [(1, 1, 1, 0), (2, 5, 2, 1)]


def test_quarantine_over_runs(spark, store):
    failed = lambda: sorted((r.source_file, r.run_id) for r in spark.read.parquet(store.failed).collect())
    run(batch(spark, ROWS), store)
    run(batch(spark, [("x.pdf", "", None)]), store, incremental=True)
    assert failed() == [("d.pdf", 1), ("x.pdf", 2)]
    run(batch(spark, ROWS[:1]), store)
    assert failed() == []


def test_run_without_readable_documents_loads_nothing(spark, store):
    log = run(batch(spark, ROWS[3:4]), store).first()
    assert (log.invoices_found, log.invoices_loaded, log.invoices_failed) == (1, 0, 1)
    assert log.notes == "No readable documents."


def test_stream_reads_each_file_once(spark):
    folder, out, checkpoint = (new_path(spark, n) for n in ("in", "out", "checkpoint"))
    batch(spark, ROWS[:3]).write.parquet(folder)
    read_arrivals(spark, folder, out, checkpoint).awaitTermination(120)
    batch(spark, ROWS[3:]).write.mode("append").parquet(folder)
    read_arrivals(spark, folder, out, checkpoint).awaitTermination(120)
    streamed = spark.read.schema(schemas.READ).parquet(out)
    expected = extract.read_documents(batch(spark, ROWS))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, expected.collect()))
