"""The possessive patterns against plain backtracking ones, on made-up texts.

The brute force is Python's ``re`` on the same banks with every possessive
quantifier turned back into a greedy one.
"""

import random
import re

from pyspark.sql import functions as F

from billsift.functions import fields, labels
from billsift.functions.text import first_match, fold

PIECES = [
    "Invoice", "Tax Invoice", "No", "No.", "#", ":", "-", " ", "  ", "\n", "\t", "\u00a0", "Bill", "Ref", "Date",
    "Dated", "12-03-2024", "1/2/23", "12 March 2024", "Sub Total", "Sub-Total", "Subtotal", "Total", "Grand", "Amount",
    "Due", "Payable", "Net", "Before", "Taxable", "Value", "Rs.", "Rs", "₹", "INR", "1,234.50", "18%", "(18%)", "9",
    "5.", ",", "AB-12/3", "x", "CGST", "SGST", "IGST", "UTGST", "GST", "@", "Output", "Tax", "५", "\r\n", "É",
    "İnvoice", "ınvoice No:", "ſub total", "Sub Total", "Bıll No:", "CGſT", "GST 5%", "Taxable",
]


def texts(count):
    rng = random.Random(7)
    for _ in range(count):
        yield "".join(
            rng.choice(PIECES) + rng.choice(["", " ", " ", ": "]) for _ in range(rng.randint(4, 40))
        )


def greedy(pattern):
    """Same pattern for another engine: greedy quantifiers, flags by name."""
    body = pattern
    for flags, own in (("(?iU)", "(?i)"), ("(?imdU)", "(?im)"), ("(?U)", "")):
        body = body.replace(flags, own)
    for quantifier in "*+?":
        body = body.replace(quantifier + "+", quantifier)
    return re.compile(body.replace("[\\s\\x1c-\\x1f&&[^\\n]]", "[^\\S\\n]").replace(labels.WORD, r"\w"))


def cascade(bank, text):
    for rank, pattern in enumerate(bank):
        found = pattern.search(text)
        if found:
            return found.group(1), "HIGH" if rank == 0 else "LOW"
    return None


def test_banks_match_like_greedy_ones(spark):
    samples = list(texts(1500))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(samples)], "i int, text string")
    banks = {
        "invoice_id": (fields.invoice_id, labels.INVOICE_ID_BANK),
        "invoice_date": (fields.invoice_date, labels.DATE_BANK),
        "subtotal": (fields.subtotal, labels.SUBTOTAL_BANK),
        "grand_total": (fields.grand_total, labels.GRAND_TOTAL_BANK),
    }
    folded = frame.withColumn("folded", fold(F.col("text")))
    finds = (f(F.col("text"), F.col("folded")).alias(n) for n, (f, _) in banks.items())
    rows = folded.select("i", *finds).collect()
    hits = 0
    for name, (_, bank) in banks.items():
        plain = [greedy(p.regex) for p in bank]
        for row in rows:
            expected = cascade(plain, samples[row.i])
            got = row[name] and tuple(row[name])
            assert got == expected, (name, samples[row.i])
            hits += expected is not None
    assert hits > 200


def test_components_match_line_by_line(spark):
    """Brute force: split into lines, try every component label on each."""
    samples = list(texts(600))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(samples)], "i int, text string")
    rows = frame.select("i", fields.tax_components(F.col("text"), fold(F.col("text"))).alias("c")).collect()
    banks = [
        (kind, greedy(p.regex))
        for kind, bank in (("cgst", labels.CGST_BANK), ("sgst", labels.SGST_BANK), ("igst", labels.IGST_BANK))
        for p in bank
    ]
    hits = 0
    for row in rows:
        expected = []
        for line in samples[row.i].splitlines():
            found = next(((k, m.group(1)) for k, p in banks if (m := p.search(line))), None)
            digits = found and found[1].replace(",", "")
            if digits:
                expected.append((found[0], float(digits)))
        assert [tuple(c) for c in row.c] == expected, samples[row.i]
        hits += len(expected)
    assert hits > 30


def test_anchors():
    banks = (labels.INVOICE_ID_BANK, labels.SUBTOTAL_BANK, labels.GRAND_TOTAL_BANK, labels.GENERIC_TAX_BANK)
    assert [[p.anchor for p in bank] for bank in banks] == [
        ["invoice", "invoice", "invoice", "bill", "ref"],
        ["total", "before", "taxable", "amount", "subtotal"],
        ["grand", "amount", "net", "payable", "amount", "total"],
        ["gst", "amount", "output"],
    ]


def test_letters_a_regex_takes_for_ascii(spark):
    """Whatever one letter a case-insensitive regex accepts must survive folding."""
    letters = [chr(c) for c in range(0xC0, 0x2200) if not chr(c).isspace()]
    frame = spark.createDataFrame([(c,) for c in letters], "c string")
    for plain in "abcdefghijklmnopqrstuvwxyz":
        odd = frame.filter(F.col("c").rlike(f"(?iU){plain}") & ~F.contains(fold(F.col("c")), F.lit(plain)))
        assert odd.isEmpty(), plain


def test_heads_start_every_match(spark):
    """A search that starts where a head stands finds what a search of the whole text does."""
    banks = {
        "invoice_id": labels.INVOICE_ID_BANK, "date": labels.DATE_BANK, "subtotal": labels.SUBTOTAL_BANK,
        "total": labels.GRAND_TOTAL_BANK, "tax": labels.GENERIC_TAX_BANK,
    }
    assert [p.head for p in labels.SUBTOTAL_BANK] == ["sub", "total", "taxable", "amount", "subtotal"]
    assert labels.GRAND_TOTAL_BANK[-1].head == "" and labels.head_of(r"Ab?c") == "a"
    odd = ["", "i̇İı ſK", "i̇" * 9, "\U0001F642₹ total net amount tax ref bill date gst sub grand\n"]
    lines = [
        "Sub-Total: 5", "ſub total 5", "Taxİnvoice No A1", "TAX INVOıCE NO. A1", "Ref. No: B2", "Date: 1/2/2003",
        "Dated 1 May 2003", "Total Amount Due 7", "Net Payable: 8", "Total: 9", "x Total: 9", "GST (18%): 4", "Tax Amount 3",
        "Total  Before Tax: 6", "Taxable Value 6", "AMOUNT PAYABLE 2", "Output Tax: 1", "Bill No 77",
    ]
    texts = [a + line + b for a in odd for line in lines for b in ("", "\nTotal: 11\nSub Total 12")]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("folded", fold(F.col("text")))
    text, folded = F.col("text"), F.col("folded")
    both = [first_match(text, bank, f).alias(f"{n}_{k}") for n, bank in banks.items() for k, f in enumerate((None, folded))]
    for row in frame.select("text", *both).collect():
        for name in banks:
            assert row[f"{name}_0"] == row[f"{name}_1"], (row["text"], name)
