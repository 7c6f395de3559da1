"""Table schemas. Readers always pass one; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _DOUBLE, _INT, _LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


DOCUMENTS = _schema(doc_id=_LONG, source_file=_STRING, text=_STRING, ocr_text=_STRING)

# Column names and order of the invoice table.
EXTRACTED = _schema(
    invoice_id=_STRING,
    invoice_id_confidence=_STRING,
    invoice_date=_STRING,
    invoice_date_confidence=_STRING,
    vendor_name=_STRING,
    vendor_name_confidence=_STRING,
    subtotal=_DOUBLE,
    subtotal_confidence=_STRING,
    tax_amount=_DOUBLE,
    tax_amount_confidence=_STRING,
    cgst=_DOUBLE,
    sgst=_DOUBLE,
    igst=_DOUBLE,
    grand_total=_DOUBLE,
    grand_total_confidence=_STRING,
    extraction_method=_STRING,
    overall_confidence=_STRING,
    validation_passed=_INT,
    validation_note=_STRING,
    source_file=_STRING,
)
RECORD_COLUMNS = EXTRACTED.fieldNames()
PROCESSED = T.StructType(
    [
        T.StructField("id", _LONG, True),
        *EXTRACTED.fields,
        T.StructField("invoice_dt", T.DateType(), True),  # the printed date, read once at load
        T.StructField("loaded_at", T.TimestampType(), True),
    ]
)
# An extraction's output: records, and failures by their reason.
READ = T.StructType([*EXTRACTED.fields, T.StructField("reason", _STRING, True)])
FAILED = _schema(source_file=_STRING, reason=_STRING, run_id=_LONG)
GROUND_TRUTH = _schema(
    invoice_id=_STRING,
    invoice_date=_STRING,
    vendor_name=_STRING,
    subtotal=_DOUBLE,
    tax_amount=_DOUBLE,
    grand_total=_DOUBLE,
    source_file=_STRING,
)
RUN_LOG = _schema(
    id=_LONG,
    run_at=T.TimestampType(),
    invoices_found=_LONG,
    invoices_loaded=_LONG,
    invoices_failed=_LONG,
    n_high_conf=_LONG,
    n_low_conf=_LONG,
    n_missing_conf=_LONG,
    duration_seconds=_DOUBLE,
    notes=_STRING,
)
# Columns a file must have to be loaded.
REQUIRED_COLUMNS = [
    "invoice_id", "invoice_date", "vendor_name", "subtotal", "tax_amount", "grand_total", "source_file",
]
