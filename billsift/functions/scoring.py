"""Confidence of a record and the check of its totals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billsift.functions.amounts import TOLERANCE, round_money, two_decimals
from billsift.functions.text import HIGH, LOW, MISSING

# Points of a confidence, and the points a record needs.
WEIGHTS = {HIGH: 2, LOW: 1}
HIGH_FROM, LOW_FROM = 5, 3


def overall_confidence(*confidences: Column) -> Column:
    points = F.lit(0)
    for confidence in confidences:
        points = points + F.when(confidence == HIGH, WEIGHTS[HIGH]).when(
            confidence == LOW, WEIGHTS[LOW]
        ).otherwise(0)
    return F.when(points >= HIGH_FROM, HIGH).when(points >= LOW_FROM, LOW).otherwise(MISSING)


def expected_total(subtotal: Column, tax: Column) -> Column:
    return round_money(subtotal + tax)


def missing_amounts(**amounts: Column) -> Column:
    """Names of the amounts that are NULL, as one text; empty if there are none."""
    return F.array_join(F.array(*(F.when(c.isNull(), name) for name, c in amounts.items())), ", ")


def totals_agree(total: Column, expected: Column) -> Column:
    """1 if the total is as expected or cannot be checked, else 0."""
    return F.when(F.abs(total - expected) > TOLERANCE, 0).otherwise(1)


def validation_note(subtotal: Column, tax: Column, total: Column, expected: Column) -> Column:
    """Why a record could not be checked or did not pass; empty if it passed.

    The wording is a fixed value, stored in the table.
    """
    missing = missing_amounts(subtotal=subtotal, tax_amount=tax, grand_total=total)
    mismatch = F.concat(
        F.lit("Total mismatch: grand_total="), two_decimals(total),
        F.lit(", subtotal("), two_decimals(subtotal),
        F.lit(") + tax("), two_decimals(tax),
        F.lit(") = "), two_decimals(expected),
        F.lit(", diff="), two_decimals(F.abs(total - expected)),
    )
    return (
        F.when(expected.isNull() | total.isNull(), F.concat(F.lit("Validation skipped — missing: "), missing))
        .when(totals_agree(total, expected) == 1, "")
        .otherwise(mismatch)
    )
