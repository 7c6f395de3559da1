"""One column expression per invoice field.

All of them are narrow: they read one text and need no other row. ``folded`` is
``fold(text)``, worked out once by the caller for all fields; without it every
regex runs on every text, with the same result.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from billsift.functions import labels
from billsift.functions.amounts import captured_amount, round_money
from billsift.functions.text import HIGH, LOW, MISSING, bind, first_match, regex_hit, strip


def invoice_id(text: Column, folded: Column | None = None) -> Column:
    return first_match(text, labels.INVOICE_ID_BANK, folded)


def invoice_date(text: Column, folded: Column | None = None) -> Column:
    return first_match(text, labels.DATE_BANK, folded)


def subtotal(text: Column, folded: Column | None = None) -> Column:
    return first_match(text, labels.SUBTOTAL_BANK, folded)


def grand_total(text: Column, folded: Column | None = None) -> Column:
    return first_match(text, labels.GRAND_TOTAL_BANK, folded)


def vendor_name(text: Column, folded: Column | None = None) -> Column:
    """First line near the top that can be a company's name."""
    return regex_hit(
        text,
        labels.Labelled("", labels.VENDOR_LINE),
        lambda line: bind(
            strip(line),
            lambda name: F.struct(
                name.alias("value"),
                F.when(F.char_length(name) > 5, HIGH).otherwise(LOW).alias("confidence"),
            ),
        ),
    )


def _component(line: Column) -> Column:
    """``struct(kind, amount)`` of a tax line: one component per line at most.

    The first kind found takes the line, even if its amount turns out to be no
    number.
    """

    def of_kind(kind: str, pattern: labels.Labelled) -> Column:
        return regex_hit(
            line, pattern, lambda m: F.struct(F.lit(kind).alias("kind"), captured_amount(m).alias("amount"))
        )

    return F.coalesce(
        *(of_kind("cgst", p) for p in labels.CGST_BANK),
        *(of_kind("sgst", p) for p in labels.SGST_BANK),
        *(of_kind("igst", p) for p in labels.IGST_BANK),
    )


def tax_components(text: Column, folded: Column | None = None) -> Column:
    """Array of ``struct(kind, amount)``, one entry per line that adds to a tax.

    Two passes find the lines with a component label, as its first letters and
    the rest of the line; only those lines are matched.
    """
    first_letters, rest = (
        F.regexp_extract_all(text, F.lit(labels.COMPONENT_TAIL), F.lit(group)) for group in (1, 0)
    )
    if folded is not None:
        possible = reduce(or_, (F.contains(folded, F.lit(anchor)) for anchor in labels.COMPONENT_ANCHORS))
        first_letters, rest = (F.when(possible, found).otherwise(F.array()) for found in (first_letters, rest))
    lines = F.zip_with(first_letters, rest, lambda letters, tail: F.concat(letters, tail))
    return F.filter(F.transform(lines, _component), lambda c: c["amount"].isNotNull())


def component_sum(components: Column, kind: str) -> Column:
    """Sum of one kind in line order; NULL if the text has none of it."""
    return F.aggregate(
        F.filter(components, lambda c: c["kind"] == kind),
        F.lit(None).cast("double"),
        lambda total, c: F.coalesce(total, F.lit(0.0)) + c["amount"],
    )


def generic_tax(text: Column, folded: Column | None = None) -> Column:
    """Amount of the first general tax label whose amount is a number."""
    return F.coalesce(*(regex_hit(text, p, captured_amount, folded) for p in labels.GENERIC_TAX_BANK))


def tax(text: Column, folded: Column | None = None) -> Column:
    """``struct(components, generic)``; general labels are tried only without components."""
    return bind(
        tax_components(text, folded),
        lambda found: F.struct(
            found.alias("components"), F.when(F.size(found) == 0, generic_tax(text, folded)).alias("generic")
        ),
    )


def tax_confidence(hits: Column, generic: Column) -> Column:
    return (
        F.when(hits >= 2, HIGH).when((hits == 1) | generic.isNotNull(), LOW).otherwise(MISSING)
    )


def tax_total(cgst: Column, sgst: Column, igst: Column, generic: Column) -> Column:
    zero = F.lit(0.0)
    parts = F.coalesce(cgst, zero) + F.coalesce(sgst, zero) + F.coalesce(igst, zero)
    return round_money(F.when(parts != 0, parts).otherwise(F.coalesce(generic, zero)))
