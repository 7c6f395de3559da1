"""Amounts: parsing, rounding, exact sums and printing."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from billsift.functions.text import strip

TOLERANCE = 1.00  # rupees by which printed amounts may differ and still agree

# Sums run in decimals, so that they do not depend on the order of rows.
SUM_TYPE = "decimal(28,6)"
_NUMBER = r"^[+\-]?(\d+\.?\d*|\.\d+)(e[+\-]?\d+)?$"


@lru_cache(maxsize=1)
def _digit_map() -> tuple[str, str]:
    """All decimal digits beyond ASCII, with the ASCII digit each stands for."""
    digits = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


def ascii_digits(text: Column) -> Column:
    source, target = _digit_map()
    return F.when(text.rlike(r"[^\x00-\x7f]"), F.translate(text, source, target)).otherwise(text)


def captured_amount(text: Column) -> Column:
    """As ``parse_amount``, for text that a label pattern has already shaped."""
    return F.replace(ascii_digits(text), F.lit(","), F.lit("")).try_cast("double")


def parse_amount(text: Column) -> Column:
    """A number with any comma grouping as double; NULL if it is none.

    The shape is tested first because a cast alone would also take ``12d``.
    """
    plain = ascii_digits(strip(F.replace(text, F.lit(","), F.lit(""))))
    return F.when(plain.rlike(f"(?i){_NUMBER}"), plain.try_cast("double"))


def two_decimals(amount: Column) -> Column:
    """The amount printed with two decimals, half to even on its exact value."""
    return F.replace(F.format_number(amount, 2), F.lit(","), F.lit(""))


def round_money(amount: Column) -> Column:
    """Round to paise by the value a double really holds: 2.675 becomes 2.67."""
    return F.coalesce(two_decimals(amount).try_cast("double"), amount)


def plain_number(amount: Column) -> Column:
    """A double as text without an exponent: 82244.4, 118000.0."""
    digits = F.regexp_replace(amount.try_cast(SUM_TYPE).cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(amount.try_cast(SUM_TYPE) == amount, digits).otherwise(amount.cast("string"))


def format_currency(amount: Column) -> Column:
    return F.concat(F.lit("Rs. "), F.format_number(amount, 2))


def exact_sum(amount: Column) -> Column:
    """Sum as double that is the same for every partitioning.

    Values too large for the decimal type can only be misread amounts. They are
    still added, as doubles, so that no row is lost and no cast fails. NULL for
    no values at all.
    """
    exact = amount.try_cast(SUM_TYPE)
    huge = F.sum(F.when(exact.isNull(), amount))
    total = F.sum(exact).cast("double")
    return F.when(huge.isNull(), total).otherwise(huge + F.coalesce(total, F.lit(0.0)))


def exact_mean(amount: Column) -> Column:
    """Mean over the non-null amounts, from the exact sum; NULL for none."""
    return F.try_divide(exact_sum(amount), F.count(amount))


def amounts_agree(left: Column, right: Column) -> Column:
    """Within the tolerance; a missing amount agrees with nothing."""
    return F.coalesce(F.abs(left - right) <= TOLERANCE, F.lit(False))


def texts_agree(left: Column, right: Column) -> Column:
    """Equal but for case and outer white space; NULL counts as empty."""
    clean = lambda c: F.lower(strip(F.coalesce(c, F.lit(""))))
    return clean(left) == clean(right)
