"""Accuracy of extracted fields against ground truth."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billsift.functions.amounts import amounts_agree, plain_number, texts_agree

# Field, and how its two values are compared. Add an entry to score a field.
COMPARATORS: dict[str, Callable[[Column, Column], Column]] = {
    "invoice_date": texts_agree,
    "vendor_name": texts_agree,
    "subtotal": amounts_agree,
    "tax_amount": amounts_agree,
    "grand_total": amounts_agree,
}
REPORT_ROWS = 10


def accuracy_join(truth: DataFrame, extracted: DataFrame) -> DataFrame:
    """Every truth row with the extracted values of the same invoice id.

    ``found`` tells whether the id was extracted at all. An id that is NULL
    names no invoice, so it finds nothing; Spark drops such extracted rows
    before the shuffle.
    """
    found = extracted.select(
        "invoice_id", *(F.col(f).alias(f"{f}_extracted") for f in COMPARATORS), F.lit(1).alias("_found")
    )
    known = truth.select("invoice_id", "source_file", *(F.col(f).alias(f"{f}_truth") for f in COMPARATORS))
    return (
        known.join(found, "invoice_id", "left")
        .withColumn("found", F.coalesce("_found", F.lit(0)))
        .drop("_found")
    )


def _matches(field: str) -> Column:
    return COMPARATORS[field](F.col(f"{field}_truth"), F.col(f"{field}_extracted"))


def _scoreable(field: str) -> Column:
    """Only rows with a known truth are scored."""
    return F.col(f"{field}_truth").isNotNull()


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def _bar(percent: Column) -> Column:
    """One ``=`` for each full five per cent, in twenty places."""
    filled = F.rpad(F.repeat(F.lit("="), F.floor(percent / 5).cast("int")), 20, " ")
    return F.concat(F.lit("["), filled, F.lit("]"))


def accuracy_by_field(joined: DataFrame) -> DataFrame:
    """Correct, scoreable and per cent of each field.

    All counts come from one pass with one row of partial counts per task; only
    that one row is then turned into a row per field.
    """
    counts = joined.agg(
        *(F.count_if(_scoreable(f) & _matches(f)).alias(f"{f}_correct") for f in COMPARATORS),
        *(F.count_if(_scoreable(f)).alias(f"{f}_scoreable") for f in COMPARATORS),
    )
    per_field = F.array(
        *(
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"{f}_correct").alias("correct"),
                F.col(f"{f}_scoreable").alias("scoreable"),
            )
            for f in COMPARATORS
        )
    )
    percent = _percent(F.col("correct"), F.col("scoreable"))
    return (
        counts.select(F.inline(per_field))
        .withColumn("accuracy_pct", percent)
        .withColumn("bar", _bar(F.col("accuracy_pct")))
    )


def accuracy_overall(by_field: DataFrame) -> DataFrame:
    return by_field.agg(
        F.coalesce(F.sum("correct"), F.lit(0)).alias("total_correct"),
        F.coalesce(F.sum("scoreable"), F.lit(0)).alias("total_possible"),
    ).withColumn("overall_pct", _percent(F.col("total_correct"), F.col("total_possible")))


def match_rate(joined: DataFrame) -> DataFrame:
    """Truth rows, those found, and the share in per cent; NULL share for no rows."""
    return joined.agg(
        F.count(F.lit(1)).alias("total_invoices"),
        F.coalesce(F.sum("found"), F.lit(0)).alias("matched_invoices"),
    ).withColumn(
        "match_rate_pct",
        F.try_divide(F.col("matched_invoices") * F.lit(100.0), F.col("total_invoices")),
    )


def _shown(field: str, side: str, kind: str) -> Column:
    value = F.col(f"{field}_{side}")
    return F.coalesce(plain_number(value) if kind == "double" else value, F.lit("nan"))


def accuracy_mismatches(joined: DataFrame) -> DataFrame:
    """Rows with an issue, and their issues as text; no shuffle beyond the join."""
    kinds = dict(joined.dtypes)

    def issue(field: str) -> Column:
        kind = kinds[f"{field}_truth"]
        message = F.concat(
            F.lit(f"{field}: truth <"), _shown(field, "truth", kind),
            F.lit(">, read <"), _shown(field, "extracted", kind), F.lit(">"),
        )
        return F.when(_scoreable(field) & ~_matches(field), message)

    return (
        joined.withColumn("_issues", F.array_compact(F.array(*(issue(f) for f in COMPARATORS))))
        .filter(F.size("_issues") > 0)
        .select(
            "invoice_id",
            "source_file",
            F.size("_issues").alias("n_issues"),
            F.array_join("_issues", "; ").alias("issues"),
        )
    )


def mismatch_report(mismatches: DataFrame) -> DataFrame:
    """The first rows of the mismatches, as a report shows them."""
    return mismatches.orderBy("source_file", "invoice_id").limit(REPORT_ROWS)


def mismatch_counts(mismatches: DataFrame) -> DataFrame:
    """How many rows have an issue, and how many of them the report leaves out."""
    return mismatches.agg(F.count(F.lit(1)).alias("n_mismatched")).withColumn(
        "n_more", F.greatest(F.col("n_mismatched") - REPORT_ROWS, F.lit(0))
    )
