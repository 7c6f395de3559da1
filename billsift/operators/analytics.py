"""Spending questions over the loaded table.

Every group-by combines partially before its shuffle, so a vendor or day with a
large share of the rows costs one row per map task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billsift.functions.amounts import exact_mean, exact_sum
from billsift.functions.dates import parse_invoice_date


def with_invoice_day(processed: DataFrame) -> DataFrame:
    """The table with ``invoice_dt``; loaded tables have it and are not parsed again."""
    if "invoice_dt" in processed.columns:
        return processed
    return processed.withColumn("invoice_dt", parse_invoice_date(F.col("invoice_date")))


def _spend() -> Column:
    """Sum of totals, zero for a group that has none."""
    return F.coalesce(exact_sum(F.col("grand_total")), F.lit(0.0))


def kpi_summary(processed: DataFrame) -> DataFrame:
    """Total spend, total tax and the number of all rows, checked or not."""
    return processed.agg(
        _spend().alias("total_spend"),
        F.coalesce(exact_sum(F.col("tax_amount")), F.lit(0.0)).alias("total_tax"),
        F.count(F.lit(1)).alias("invoice_count"),
    )


def spend_by_vendor(processed: DataFrame, top: int = 10) -> DataFrame:
    """The vendors with the highest spend; ties by name."""
    return (
        processed.filter(F.col("vendor_name").isNotNull())
        .groupBy("vendor_name")
        .agg(_spend().alias("total_spend"))
        .orderBy(F.desc("total_spend"), "vendor_name")
        .limit(top)
    )


def spend_timeline(processed: DataFrame) -> DataFrame:
    """Spend per day, in order of days; rows without a readable date are left out."""
    return (
        with_invoice_day(processed)
        .filter(F.col("invoice_dt").isNotNull())
        .groupBy("invoice_dt")
        .agg(_spend().alias("daily_spend"))
        .orderBy("invoice_dt")
    )


def financial_summary(processed: DataFrame) -> DataFrame:
    """Total and mean of the invoice totals."""
    return processed.agg(
        _spend().alias("total_expenditure"), exact_mean(F.col("grand_total")).alias("average_invoice")
    )


def explorer_view(processed: DataFrame) -> DataFrame:
    """The whole table, latest invoices first, undated ones last.

    The file name ends the sort key, so that the range partitions stay even
    when many invoices share a day.
    """
    return with_invoice_day(processed).orderBy(F.desc_nulls_last("invoice_dt"), "invoice_id", "source_file")


def review_queue(
    processed: DataFrame,
    passed: int | None = None,
    confidence: str | None = None,
    method: str | None = None,
    vendor: str | None = None,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Rows that match all given conditions; each is pushed to the file scan.

    Days are those of ``invoice_dt``, both included, however the date was printed.
    On the review table (``write_review_table``) they also select its month folders.
    """
    wanted = {
        "validation_passed": passed,
        "overall_confidence": confidence,
        "extraction_method": method,
        "vendor_name": vendor,
    }
    for column, value in wanted.items():
        if value is not None:
            processed = processed.filter(F.col(column) == value)
    months = "invoice_month" in processed.columns
    if since is not None:
        processed = processed.filter(F.col("invoice_dt") >= F.lit(since))
        if months:  # the same condition on the partition column prunes folders
            processed = processed.filter(F.col("invoice_month") >= F.trunc(F.lit(since), "month"))
    if until is not None:
        processed = processed.filter(F.col("invoice_dt") <= F.lit(until))
        if months:
            processed = processed.filter(F.col("invoice_month") <= F.trunc(F.lit(until), "month"))
    return processed
