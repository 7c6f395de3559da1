"""Counts of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billsift.functions.amounts import exact_mean, exact_sum
from billsift.functions.text import HIGH, LOW, MISSING
from billsift.operators.extract import OCR


def _readable():
    return F.col("reason").isNull()


def _with_confidence(level: str):
    return F.count_if(_readable() & (F.col("overall_confidence") == level))


def extraction_summary(read: DataFrame) -> DataFrame:
    """One row about an extraction, from the frame with readable and failed documents."""
    return read.agg(
        F.count_if(_readable()).alias("total"),
        _with_confidence(HIGH).alias("n_high"),
        _with_confidence(LOW).alias("n_low"),
        _with_confidence(MISSING).alias("n_missing"),
        F.count_if(_readable() & (F.col("validation_passed") == 0)).alias("n_flagged"),
        F.count_if(_readable() & (F.col("extraction_method") == OCR)).alias("n_ocr"),
        F.count_if(~_readable()).alias("n_failed"),
    )


def run_summary(read: DataFrame, notes: str = "SUCCESS") -> DataFrame:
    """The audit row of a full load, apart from its id and times."""
    return read.agg(
        F.count(F.lit(1)).alias("invoices_found"),
        (
            F.count_distinct(F.when(_readable(), F.col("invoice_id")))
            + F.count_if(_readable() & F.col("invoice_id").isNull())
        ).alias("invoices_loaded"),
        F.count_if(~_readable()).alias("invoices_failed"),
        _with_confidence(HIGH).alias("n_high_conf"),
        _with_confidence(LOW).alias("n_low_conf"),
        _with_confidence(MISSING).alias("n_missing_conf"),
    ).withColumn("notes", F.lit(notes))


def load_summary(processed: DataFrame) -> DataFrame:
    """Rows, total and mean of the loaded table; zeros if it is empty."""
    zero = F.lit(0.0)
    return processed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(exact_sum(F.col("grand_total")), zero).alias("total_expenditure"),
        F.coalesce(exact_mean(F.col("grand_total")), zero).alias("average_invoice"),
    )
