"""Registered queries: each operator over whole tables.

Field operators run on the document table, which is rendered from the order
tables and written once per session to the shared folder. Analytics, accuracy
and table operators run on the loaded invoice table, also written once, as a
user of the engine would have them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billsift import schemas
from billsift.functions import fields
from billsift.functions.amounts import format_currency, parse_amount, plain_number
from billsift.functions.dates import parse_invoice_date
from billsift.operators import accuracy, analytics, extract, load, metrics
from billsift.session import new_path
from billsift.sources import corpus, csv_files, documents, tables

Query = Callable[[SparkSession, str], DataFrame]

_PATHS: dict[tuple[str, str, str], str] = {}
CUTOFF = "1998-01-01"  # invoices before this day form the first of two loads


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a table that is written the first time a session asks for it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _PATHS:
        path = new_path(spark, name)
        write(path)
        _PATHS[key] = path
    return _PATHS[key]


def document_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _once(
        spark, sf_dir, "documents", lambda p: corpus.invoice_documents(spark, sf_dir).write.parquet(p)
    )
    return documents.read_document_table(spark, path)


def read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _once(
        spark, sf_dir, "read", lambda p: extract.read_documents(document_table(spark, sf_dir)).write.parquet(p)
    )
    return spark.read.schema(schemas.READ).parquet(path)


def record_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.records(read_table(spark, sf_dir))


def processed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _once(
        spark, sf_dir, "processed", lambda p: tables.load_full_refresh(record_table(spark, sf_dir), p)
    )
    return tables.read_processed(spark, path)


def truth_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _once(spark, sf_dir, "truth", lambda p: corpus.ground_truth(spark, sf_dir).write.parquet(p))
    return spark.read.schema(schemas.GROUND_TRUTH).parquet(path)


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.route_text(document_table(spark, sf_dir)).filter(F.col("reason").isNull())


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy.accuracy_join(
        truth_table(spark, sf_dir), tables.core_columns(processed_table(spark, sf_dir))
    )


def _without_time(processed: DataFrame) -> DataFrame:
    return _day_as_text(processed.drop("loaded_at"))


def _day_as_text(frame: DataFrame) -> DataFrame:
    return frame.withColumn("invoice_dt", F.date_format("invoice_dt", "yyyy-MM-dd"))


# --- documents ---------------------------------------------------------------


def doc_scan(spark, sf_dir):
    return document_table(spark, sf_dir).select(
        "doc_id",
        "source_file",
        F.char_length("text").alias("text_chars"),
        F.coalesce(F.char_length("ocr_text"), F.lit(-1)).alias("ocr_chars"),
    )


def invoice_corpus(spark, sf_dir):
    return corpus.invoice_documents(spark, sf_dir)


def invoice_line_items(spark, sf_dir):
    return corpus.line_items(spark, sf_dir)


def invoice_totals(spark, sf_dir):
    return corpus.invoice_totals(spark, sf_dir).select(
        "doc_id",
        "n_items",
        "n_units",
        *(F.col(c).cast("double").alias(c) for c in ("subtotal", "tax", "total")),
    )


def ground_truth(spark, sf_dir):
    return corpus.ground_truth(spark, sf_dir)


def page_assembly(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return documents.assemble_pages(pages, "conv_id", "turn")


def text_routing(spark, sf_dir):
    return extract.route_text(document_table(spark, sf_dir)).select(
        "source_file", "extraction_method", "text", "reason"
    )


# --- fields --------------------------------------------------------------------


def _field_query(name: str, *columns: str) -> Query:
    return lambda spark, sf_dir: extract.read_fields(_routed(spark, sf_dir), name).select("source_file", *columns)


def parse_amount_query(spark, sf_dir):
    raw = _routed(spark, sf_dir).select("source_file", fields.grand_total(F.col("text"))["value"].alias("raw"))
    return raw.withColumn("amount", parse_amount(F.col("raw")))


def extract_records(spark, sf_dir):
    return extract.extract_records(document_table(spark, sf_dir))


def failed_documents(spark, sf_dir):
    return extract.failures(extract.route_text(document_table(spark, sf_dir)))


def overall_confidence(spark, sf_dir):
    graded = extract.with_quality(record_table(spark, sf_dir))
    return graded.select(
        "source_file",
        "invoice_id_confidence",
        "grand_total_confidence",
        "tax_amount_confidence",
        "overall_confidence",
    )


def validate_totals(spark, sf_dir):
    graded = extract.with_quality(record_table(spark, sf_dir))
    return graded.select("source_file", "validation_passed", "validation_note")


def parse_invoice_date_query(spark, sf_dir):
    dated = record_table(spark, sf_dir).select(
        "source_file", "invoice_date", parse_invoice_date(F.col("invoice_date")).alias("invoice_dt")
    )
    return _day_as_text(dated)


def format_currency_query(spark, sf_dir):
    return processed_table(spark, sf_dir).select(
        "source_file", format_currency(F.col("grand_total")).alias("grand_total_text")
    )


# --- load and tables -------------------------------------------------------------


def dedup_first_wins(spark, sf_dir):
    return load.dedup_first_wins(record_table(spark, sf_dir)).select("invoice_id", "source_file", "grand_total")


def load_counts(spark, sf_dir):
    return load.load_counts(record_table(spark, sf_dir))


def surrogate_id(spark, sf_dir):
    firsts = load.dedup_first_wins(record_table(spark, sf_dir)).select("invoice_id", "source_file")
    return load.with_surrogate_ids(firsts)


def load_full_refresh(spark, sf_dir):
    loaded = tables.load_full_refresh(record_table(spark, sf_dir), new_path(spark, "full"))
    return _without_time(loaded)


def load_incremental(spark, sf_dir):
    """Into a table that is not there yet: the years before the cutoff, then all documents."""
    everything = record_table(spark, sf_dir)
    early = everything.filter(parse_invoice_date(F.col("invoice_date")) < F.lit(CUTOFF).cast("date"))
    path = new_path(spark, "incremental")
    tables.load_incremental(early, path)
    return tables.load_incremental(everything, path).select("id", "invoice_id", "source_file")


def processed_scan(spark, sf_dir):
    return _without_time(processed_table(spark, sf_dir))


def processed_core_columns(spark, sf_dir):
    return tables.core_columns(processed_table(spark, sf_dir))


def csv_roundtrip_extracted(spark, sf_dir):
    path = new_path(spark, "extracted-csv")
    csv_files.write_csv(_awkward(record_table(spark, sf_dir)), path)
    return csv_files.read_records_csv(spark, path)


def _awkward(records: DataFrame) -> DataFrame:
    """Dates over three lines, with a backslash, a quote and a comma in between."""
    return records.withColumn("invoice_date", F.replace("invoice_date", F.lit("-"), F.lit('\n\\",\\n\r')))


def _spoiled_csv(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The invoice table as CSV in which every seventh id's total is not a number."""
    path = new_path(spark, "spoiled-csv")
    table = processed_table(spark, sf_dir)
    total = F.when(F.col("id") % 7 == 0, F.lit("n/a")).otherwise(plain_number(F.col("grand_total")))
    csv_files.write_csv(table.withColumn("grand_total", total), path)
    return csv_files.read_csv_split(spark, path, schemas.PROCESSED, new_path(spark, "csv-staged"), schemas.REQUIRED_COLUMNS)


def csv_rejects(spark, sf_dir):
    """Lines of a CSV file that do not parse, by the id that starts them, with the reason."""
    _, rejects = _spoiled_csv(spark, sf_dir)
    return rejects.select(F.split("line", ",")[0].cast("long").alias("id"), "reason")


def csv_rejects_kept(spark, sf_dir):
    """The lines of the same file that parse: records, none lost with the bad ones."""
    records, _ = _spoiled_csv(spark, sf_dir)
    return records.select("id", "invoice_id", "grand_total")


def load_rejects(spark, sf_dir):
    """Values of a batch that the load cannot cast: every fifth total, every eleventh check."""
    table = processed_table(spark, sf_dir)
    batch = table.select(
        "source_file",
        "invoice_id",
        F.when(F.col("id") % 5 == 0, F.lit("n/a")).otherwise(plain_number(F.col("grand_total"))).alias("grand_total"),
        F.when(F.col("id") % 11 == 0, F.lit("maybe")).otherwise(F.col("validation_passed").cast("string")).alias("validation_passed"),
    )
    return load.rejected_values(batch)


def ground_truth_csv(spark, sf_dir):
    path = new_path(spark, "truth-csv")
    csv_files.write_ground_truth_csv(truth_table(spark, sf_dir), path)
    return csv_files.read_ground_truth_csv(spark, path)


def quarantine_runs(spark, sf_dir):
    """A full run's failures, then those of an incremental run over the same documents."""
    path, failed = new_path(spark, "quarantine"), extract.failures(read_table(spark, sf_dir))
    tables.write_failures(failed, path, run_id=1)
    return tables.write_failures(failed, path, run_id=2, incremental=True)


def csv_source_checked(spark, sf_dir):
    path = new_path(spark, "checked-csv")
    csv_files.write_csv(record_table(spark, sf_dir), path)
    return load.conform(csv_files.read_records_csv(spark, path)).select(
        *schemas.REQUIRED_COLUMNS, "validation_passed"
    )


def export_processed(spark, sf_dir):
    path = new_path(spark, "processed-csv")
    csv_files.write_csv(_awkward(processed_table(spark, sf_dir)), path)
    return _without_time(csv_files.read_records_csv(spark, path))


def source_fallback(spark, sf_dir):
    path = new_path(spark, "fallback-csv")
    csv_files.write_csv(processed_table(spark, sf_dir), path)
    return _without_time(tables.processed_or_fallback(spark, "billsift_no_such_table", path))


def run_log(spark, sf_dir):
    """The log after two runs, without their times."""
    path, entry = new_path(spark, "run-log"), metrics.run_summary(read_table(spark, sf_dir)).first().asDict()
    tables.append_run_log(spark, path, entry)
    return tables.append_run_log(spark, path, entry).drop("run_at", "duration_seconds")


# --- analytics -------------------------------------------------------------------


def _on_processed(operator) -> Query:
    return lambda spark, sf_dir: operator(processed_table(spark, sf_dir))


def spend_timeline(spark, sf_dir):
    return _day_as_text(analytics.spend_timeline(processed_table(spark, sf_dir)))


def explorer_view(spark, sf_dir):
    return _without_time(analytics.explorer_view(processed_table(spark, sf_dir)))


def review_queue(spark, sf_dir):
    return analytics.review_queue(processed_table(spark, sf_dir), passed=0).select(
        "invoice_id", "vendor_name", "grand_total", "validation_note", "source_file"
    )


def review_queue_by_date(spark, sf_dir):
    """What a quarter's invoices leave to check, whatever form their dates have."""
    queue = analytics.review_queue(
        processed_table(spark, sf_dir), passed=1, since=date(1995, 4, 1), until=date(1995, 6, 30)
    )
    return _day_as_text(queue.select("invoice_id", "invoice_dt", "grand_total", "source_file"))


def review_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _once(spark, sf_dir, "review", lambda p: tables.write_review_table(processed_table(spark, sf_dir), p))
    return tables.read_review_table(spark, path)


def review_queue_pruned(spark, sf_dir):
    """The quarter of ``review_queue_by_date`` from the table laid out by month."""
    queue = analytics.review_queue(review_table(spark, sf_dir), passed=1, since=date(1995, 4, 1), until=date(1995, 6, 30))
    return _day_as_text(queue.select("invoice_id", "invoice_dt", "grand_total", "source_file"))


def review_queue_scanned(spark, sf_dir):
    return analytics.review_queue(processed_table(spark, sf_dir), confidence="HIGH", method="ocr").select(
        "invoice_id", "vendor_name", "grand_total", "source_file"
    )


def extraction_summary(spark, sf_dir):
    return metrics.extraction_summary(read_table(spark, sf_dir))


# --- accuracy ----------------------------------------------------------------------


def _on_joined(operator) -> Query:
    return lambda spark, sf_dir: operator(_joined(spark, sf_dir))


def accuracy_overall(spark, sf_dir):
    return accuracy.accuracy_overall(accuracy.accuracy_by_field(_joined(spark, sf_dir)))


def mismatch_report(spark, sf_dir):
    return accuracy.mismatch_report(accuracy.accuracy_mismatches(_joined(spark, sf_dir)))


def mismatch_counts(spark, sf_dir):
    return accuracy.mismatch_counts(accuracy.accuracy_mismatches(_joined(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "doc_scan": doc_scan,
    "page_assembly": page_assembly,
    "invoice_corpus": invoice_corpus,
    "invoice_line_items": invoice_line_items,
    "invoice_totals": invoice_totals,
    "ground_truth": ground_truth,
    "text_routing": text_routing,
    "failed_documents": failed_documents,
    "extract_invoice_id": _field_query("invoice_id", "invoice_id", "invoice_id_confidence"),
    "extract_invoice_date": _field_query("invoice_date", "invoice_date", "invoice_date_confidence"),
    "extract_vendor": _field_query("vendor_name", "vendor_name", "vendor_name_confidence"),
    "extract_subtotal": _field_query("subtotal", "subtotal", "subtotal_confidence"),
    "extract_grand_total": _field_query("grand_total", "grand_total", "grand_total_confidence"),
    "extract_tax_components": _field_query("tax", "cgst", "sgst", "igst"),
    "extract_tax_generic": _field_query("tax", "generic_tax"),
    "extract_tax_total": _field_query("tax", "tax_total", "tax_amount", "tax_amount_confidence"),
    "parse_amount": parse_amount_query,
    "parse_invoice_date": parse_invoice_date_query,
    "format_currency": format_currency_query,
    "extract_records": extract_records,
    "overall_confidence": overall_confidence,
    "validate_totals": validate_totals,
    "dedup_first_wins": dedup_first_wins,
    "load_counts": load_counts,
    "surrogate_id": surrogate_id,
    "load_full_refresh": load_full_refresh,
    "load_incremental": load_incremental,
    "processed_scan": processed_scan,
    "processed_core_columns": processed_core_columns,
    "csv_roundtrip_extracted": csv_roundtrip_extracted,
    "ground_truth_csv": ground_truth_csv,
    "csv_rejects": csv_rejects,
    "load_rejects": load_rejects,
    "csv_rejects_kept": csv_rejects_kept,
    "quarantine_runs": quarantine_runs,
    "csv_source_checked": csv_source_checked,
    "export_processed": export_processed,
    "source_fallback": source_fallback,
    "run_log": run_log,
    "extraction_summary": extraction_summary,
    "load_summary": _on_processed(metrics.load_summary),
    "kpi_summary": _on_processed(analytics.kpi_summary),
    "financial_summary": _on_processed(analytics.financial_summary),
    "spend_by_vendor_top10": _on_processed(analytics.spend_by_vendor),
    "spend_by_vendor_top5": _on_processed(lambda processed: analytics.spend_by_vendor(processed, top=5)),
    "spend_timeline": spend_timeline,
    "explorer_view": explorer_view,
    "review_queue": review_queue,
    "review_queue_by_date": review_queue_by_date,
    "review_queue_pruned": review_queue_pruned,
    "review_queue_scanned": review_queue_scanned,
    "accuracy_join": _joined,
    "match_rate": _on_joined(accuracy.match_rate),
    "accuracy_by_field": _on_joined(accuracy.accuracy_by_field),
    "accuracy_overall": accuracy_overall,
    "accuracy_mismatches": _on_joined(accuracy.accuracy_mismatches),
    "mismatch_report": mismatch_report,
    "mismatch_counts": mismatch_counts,
}
