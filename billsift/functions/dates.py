"""Invoice dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billsift.functions import labels
from billsift.functions.amounts import ascii_digits
from billsift.functions.text import strip

# Day first, as invoices print them; tried in this order.
DATE_FORMATS = ["d-M-yyyy", "d-M-yy", "d MMMM yyyy", "d MMM yyyy"]


def parse_invoice_date(text: Column) -> Column:
    """The printed date as a date; NULL if it is none (such as 31-02-2024)."""
    plain = F.translate(ascii_digits(strip(text)), "/.", "--")
    plain = F.regexp_replace(plain, f"(?U){labels.BLANK}++", " ")
    return F.coalesce(*(F.try_to_date(plain, form) for form in DATE_FORMATS))
