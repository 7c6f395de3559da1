"""From documents to invoice records, one narrow pass and no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billsift import schemas
from billsift.functions import fields, scoring
from billsift.functions.amounts import captured_amount
from billsift.functions.text import MISSING, confidence_of, fold, has_text, strip

# Fixed values, as stored in the tables.
TEXT_LAYER, OCR = "text_layer", "ocr"
NO_TEXT = "ValueError: PDF produced no text even after OCR attempt."


def route_text(documents: DataFrame) -> DataFrame:
    """Pick the text to read: the text layer, or recognised text if that is blank.

    A document with neither gets a ``reason`` and keeps a NULL text; it stays
    in the frame and never stops the others.
    """
    return (
        documents.withColumn("_layer", has_text(F.col("text")))
        .withColumn("_recognised", ~F.col("_layer") & has_text(F.col("ocr_text")))
        .withColumn("text", strip(F.when(F.col("_layer"), F.col("text")).when(F.col("_recognised"), F.col("ocr_text"))))
        .withColumn("extraction_method", F.when(F.col("_layer"), TEXT_LAYER).otherwise(OCR))
        .withColumn("reason", F.when(~F.col("_layer") & ~F.col("_recognised"), NO_TEXT))
        .drop("_layer", "_recognised", "ocr_text")
    )


FINDERS = {
    "invoice_id": fields.invoice_id,
    "invoice_date": fields.invoice_date,
    "vendor_name": fields.vendor_name,
    "subtotal": fields.subtotal,
    "tax": fields.tax,
    "grand_total": fields.grand_total,
}


def find_fields(routed: DataFrame, names: list[str]) -> DataFrame:
    """Replace the text by what was found in it, ``<name>_hit`` for each field.

    All searches share one projection; what follows no longer carries the text.
    """
    kept = [c for c in routed.columns if c != "text"]
    text, folded = F.col("text"), F.col("_folded")
    hits = (FINDERS[name](text, folded).alias(f"{name}_hit") for name in names)
    return routed.withColumn("_folded", fold(text)).select(*kept, *hits)


def _decode_text(found: DataFrame, name: str) -> DataFrame:
    hit = F.col(f"{name}_hit")
    return found.withColumns({name: hit["value"], f"{name}_confidence": confidence_of(hit)})


def _decode_amount(found: DataFrame, name: str) -> DataFrame:
    """A field whose text is no number counts as missing."""
    hit = F.col(f"{name}_hit")
    return found.withColumn(name, captured_amount(hit["value"])).withColumn(
        f"{name}_confidence", F.when(F.col(name).isNotNull(), confidence_of(hit)).otherwise(MISSING)
    )


def _decode_tax(found: DataFrame, name: str) -> DataFrame:
    """Tax by component, or by a general label where no component is printed.

    A total of zero is stored as NULL while its confidence stays as found.
    """
    components, generic = F.col(f"{name}_hit.components"), F.col("generic_tax")
    kinds = {kind: fields.component_sum(components, kind) for kind in ("cgst", "sgst", "igst")}
    summed = found.withColumns({**kinds, "generic_tax": F.col(f"{name}_hit.generic")})
    return summed.withColumn("tax_total", fields.tax_total(*(F.col(k) for k in kinds), generic)).withColumns(
        {
            "tax_amount": F.nullif(F.col("tax_total"), F.lit(0.0)),
            "tax_amount_confidence": fields.tax_confidence(F.size(components), generic),
        }
    )


DECODERS = {
    "invoice_id": _decode_text,
    "invoice_date": _decode_text,
    "vendor_name": _decode_text,
    "subtotal": _decode_amount,
    "tax": _decode_tax,
    "grand_total": _decode_amount,
}


def read_fields(routed: DataFrame, *names: str) -> DataFrame:
    """The named fields of routed documents, with their confidences."""
    frame = find_fields(routed, list(names))
    for name in names:
        frame = DECODERS[name](frame, name).drop(f"{name}_hit")
    return frame


def with_quality(frame: DataFrame) -> DataFrame:
    """Overall confidence and the arithmetic check."""
    overall = scoring.overall_confidence(
        *(F.col(f"{c}_confidence") for c in ("invoice_id", "grand_total", "tax_amount"))
    )
    subtotal, tax, total = (F.col(c) for c in ("subtotal", "tax_amount", "grand_total"))
    expected = F.col("_expected")
    return (
        frame.withColumn("overall_confidence", overall)
        .withColumn("_expected", scoring.expected_total(subtotal, tax))
        .withColumn("validation_passed", scoring.totals_agree(total, expected))
        .withColumn("validation_note", scoring.validation_note(subtotal, tax, total, expected))
        .drop("_expected")
    )


def read_documents(documents: DataFrame) -> DataFrame:
    """Every document as a record, unreadable ones with a ``reason``.

    This is the one expensive pass. Write its result once, then split it with
    ``records`` and ``failures``.
    """
    return with_quality(read_fields(route_text(documents), *FINDERS)).select(*schemas.RECORD_COLUMNS, "reason")


def records(read: DataFrame) -> DataFrame:
    return read.filter(F.col("reason").isNull()).select(*schemas.RECORD_COLUMNS)


def failures(read: DataFrame) -> DataFrame:
    return read.filter(F.col("reason").isNotNull()).select("source_file", "reason")


def extract_records(documents: DataFrame) -> DataFrame:
    """Records of all readable documents."""
    return records(read_documents(documents))
