"""Label banks: how invoices name their fields, and the regexes built from them.

A bank is tried in order. The first pattern of a bank is the standard way to
print the field (confidence HIGH), every later one is a fallback (LOW).

The regexes are Java regexes that stay linear on any text. After a label there
is only one way to read separator, currency and amount, so these parts are
possessive and a long run of blanks is never tried twice. Only the tax rate may
give digits back to the amount that follows it.
"""

from __future__ import annotations

import re
from typing import NamedTuple

# --- fixed values: labels as printed on invoices, in the order they are tried ---
# A blank stands for one or more white-space characters, line breaks included.
INVOICE_ID_LABELS = [
    r"Invoice No\.?",
    r"Tax Invoice No\.?",
    r"Invoice\s*#",
    r"Bill No\.?",
    r"Ref\.? No\.?",
]
SUBTOTAL_LABELS = [
    r"Sub[\s\-]?Total",
    r"Total Before Tax",
    r"Taxable (?:Value|Amount)",
    r"Amount Before (?:Tax|GST)",
    r"Subtotal",
]
GRAND_TOTAL_LABELS = [
    r"Grand Total",
    r"Total Amount (?:Due|Payable)",
    r"Net (?:Amount )?(?:Payable|Due)",
    r"Amount Payable",
    r"Total (?:Bill|Invoice) Amount",
]
# Printed alone on a line; tried after all labels above.
BARE_TOTAL_LABEL = r"Total"
# Each followed by a rate, then the amount.
CGST_LABELS = [r"CGST"]
SGST_LABELS = [r"[SU]TGST", r"SGST"]
IGST_LABELS = [r"IGST"]
# Used only when no component line was found. The first takes a bracketed rate.
GENERIC_GST_LABEL = r"GST"
GENERIC_TAX_LABELS = [r"Tax Amount", r"Output Tax"]

CURRENCIES = r"Rs\.?|₹|INR"
NUMERIC_DATE = r"\d{1,2}[\/\-\.]\d{1,2}[\/\-\.]\d{2,4}"
BARE_DATE = r"\d{1,2}[\/\-]\d{1,2}[\/\-]\d{4}"

# A line with one of these, in any case, is never the vendor name.
VENDOR_STOP_TOKENS = [
    "tax invoice", "invoice", "gstin", "bill", "receipt",
    "original", "duplicate", "triplicate", "copy", "page",
]
VENDOR_HEAD_LINES = 15
# --- end of fixed values ---

# Case-insensitive, and \s, \d by Unicode. \s leaves out the four ASCII
# separators that count as white space here, hence BLANK.
FLAGS = "(?iU)"
BLANK = r"[\s\x1c-\x1f]"
# White space within a line, for patterns tied to a line's start or end.
BLANK_IN_LINE = r"[\s\x1c-\x1f&&[^\n]]"
# Letters and digits; combining marks end a word.
WORD = r"[\p{L}\p{N}_]"
# Where a line ends, as seen by line-based fields. The plain class also splits
# inside "\r\n", which only adds an empty line; LINE_BREAK takes both as one.
LINE_END = r"[\n\r\x0b\f\x1c-\x1e\x85  ]"
LINE_BREAK = rf"{LINE_END}(?:(?<=\r)\n)?+"
IN_LINE = "[^" + LINE_END[1:]

_GAP = f"{BLANK}*+"
_AMOUNT = r"([\d,]++\.?+\d*+)"
_MONEY = f"{_GAP}(?:[:\\-]{_GAP})?+(?:(?:{CURRENCIES}){_GAP})?+{_AMOUNT}"
_RATE = r"\d+\.?\d*"


def _spaced(label: str) -> str:
    return label.replace(" ", f"{BLANK}++").replace(r"\s*", _GAP)


def id_pattern(label: str) -> str:
    # Both cases are spelled out: a range takes fewer odd letters than its letters do.
    tail = r"([A-Za-z0-9][A-Za-z0-9\-/]++)"
    separator = "" if label.endswith("#") else f"(?:[:#]{_GAP})?+"  # "#" is a separator itself
    return f"{FLAGS}{_spaced(label)}{_GAP}{separator}{tail}"


def amount_pattern(label: str) -> str:
    return f"{FLAGS}{_spaced(label)}{_MONEY}"


def bare_amount_pattern(label: str) -> str:
    return f"(?imdU)^{BLANK_IN_LINE}*+{label}{_MONEY}{BLANK_IN_LINE}*+$"


def rated_amount_pattern(label: str) -> str:
    return f"{FLAGS}{label}{_GAP}@?+{_GAP}{_RATE}{_GAP}%?+{_MONEY}"


def bracketed_rate_pattern(label: str) -> str:
    return f"{FLAGS}{label}{_GAP}\\(?+{_RATE}{_GAP}%?+\\)?+{_MONEY}"


def date_pattern(label: str, date: str) -> str:
    return f"{FLAGS}{label}{_GAP}(?:[:\\-]{_GAP})?+({date})"




class Labelled(NamedTuple):
    """A regex and a lower-case text without which it cannot match ('' for any).

    ``head`` is a lower-case text that every match starts with ('' for any); such a
    regex does not look at what is before its match.
    """

    anchor: str
    regex: str
    head: str = ""


def anchor_of(label: str) -> str:
    """The longest run of letters that every spelling of the label has."""
    fixed = re.sub(r"\(\?:.*?\)\??|\[.*?\]\??|\\.[*?]?|\w\?", " ", label)
    return max(re.findall("[a-z]+", fixed.lower()), key=len)


def head_of(label: str) -> str:
    """The letters that every spelling of the label starts with ('' if the first vary)."""
    letters = re.match("[A-Za-z]*", label).group().lower()
    return letters[:-1] if label[len(letters) : len(letters) + 1] in ("?", "*", "{") else letters


def _bank(build, *label_lists: list[str]) -> list[Labelled]:
    return [Labelled(anchor_of(label), build(label), head_of(label)) for labels in label_lists for label in labels]


INVOICE_ID_BANK = _bank(id_pattern, INVOICE_ID_LABELS)
SUBTOTAL_BANK = _bank(amount_pattern, SUBTOTAL_LABELS)
GRAND_TOTAL_BANK = _bank(amount_pattern, GRAND_TOTAL_LABELS) + [
    Labelled(anchor_of(BARE_TOTAL_LABEL), bare_amount_pattern(BARE_TOTAL_LABEL))  # looks for its line's start
]
# "Invoice Date" needs no entry of its own: it ends in "Date".
DATE_BANK = [
    Labelled("date", date_pattern("Date", NUMERIC_DATE), "date"),
    Labelled("date", date_pattern("Date", rf"\d{{1,2}}{BLANK}++{WORD}++{BLANK}++\d{{4}}"), "date"),
    Labelled("date", date_pattern("Dated?", NUMERIC_DATE), "date"),
    Labelled("", rf"(?U)(?<!{WORD})({BARE_DATE})(?!{WORD})"),
]
CGST_BANK = _bank(rated_amount_pattern, CGST_LABELS)
SGST_BANK = _bank(rated_amount_pattern, SGST_LABELS)
IGST_BANK = _bank(rated_amount_pattern, IGST_LABELS)
GENERIC_TAX_BANK = _bank(bracketed_rate_pattern, [GENERIC_GST_LABEL]) + _bank(amount_pattern, GENERIC_TAX_LABELS)
# Every component label ends in one of these.
COMPONENT_ANCHORS = ["cgst", "sgst", "igst", "tgst"]

# What follows the first component label of a line, up to the line's end; group 1
# is the letters before "GST". Every further label of the line is inside. The
# plain word comes first, and the look-behind after it, because a regex that
# starts with a literal is several times faster to search for.
_LINE_GAP = rf"[{BLANK}&&{IN_LINE}]*+"
COMPONENT_TAIL = rf"{FLAGS}GST(?<=([CSI]|[SU]T)GST){_LINE_GAP}@?+{_LINE_GAP}\d{IN_LINE}*+"


def vendor_line_pattern(head_lines: int, stop_tokens: list[str]) -> str:
    """Group 1 is the first of the head lines that can be a company's name.

    A name has no stop token, an ASCII letter, and three characters or more
    between its outer blanks. Each line is tested once.
    """
    solid = f"[^{BLANK[1:-1]}]"
    name = (
        f"(?!{IN_LINE}*(?i:{'|'.join(stop_tokens)}))"
        f"(?={IN_LINE}*?[A-Za-z])"
        f"(?={BLANK_IN_LINE}*+{solid}{IN_LINE}+{solid})"
    )
    return rf"(?U)\A(?:{IN_LINE}*+{LINE_BREAK}){{0,{head_lines - 1}}}?{name}({IN_LINE}++)"


VENDOR_LINE = vendor_line_pattern(VENDOR_HEAD_LINES, VENDOR_STOP_TOKENS)
