"""Fields of single texts, all cases of a kind in one small frame."""

import pytest
from pyspark.sql import functions as F

from billsift.functions import amounts, dates
from billsift.operators import extract

NBSP = "\u00a0"


def read(spark, texts, *names):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return extract.read_fields(frame, *names).orderBy("i").collect()


def check_text(spark, name, cases):
    rows = read(spark, [case[0] for case in cases], name)
    for (text, value, confidence), row in zip(cases, rows, strict=True):
        assert (row[name], row[f"{name}_confidence"]) == (value, confidence), text


def test_parse_amount(spark):
    cases = {
        "1234.56": 1234.56,
        "1,234.56": 1234.56,
        "1,23,456.78": 123456.78,
        "50000": 50000.0,
        " 12.5 ": 12.5,
        "१,२३४.५०": 1234.5,
        "-3": -3.0,
        "": None,
        ",": None,
        ".": None,
        "N/A": None,
        "12d": None,
        "1.2.3": None,
    }
    frame = spark.createDataFrame([*((t,) for t in cases), (None,)], "t string")
    got = {r.t: r.a for r in frame.select("t", amounts.parse_amount(F.col("t")).alias("a")).collect()}
    assert got == {**cases, None: None}


def test_invoice_id(spark):
    check_text(
        spark,
        "invoice_id",
        [
            ("Invoice No: INV-00042\nDate: 12-03-2024", "INV-00042", "HIGH"),
            ("Tax Invoice No.: 2024-25/GST/0042", "2024-25/GST/0042", "HIGH"),
            ("Invoice # TXN/2024/00199", "TXN/2024/00199", "LOW"),
            ("Invoice#TXN/7", "TXN/7", "LOW"),
            ("Bill No.: BL-2024-001", "BL-2024-001", "LOW"),
            ("Ref. No: R-77", "R-77", "LOW"),
            ("Ref No # R-78", "R-78", "LOW"),
            ("Bill No: B-1\nInvoice No: I-1", "I-1", "HIGH"),
            ("Goods as ordered, paid in cash", None, "MISSING"),
            # the sign of this label is its separator: no other may follow
            ("Invoice #: TXN/1", None, "MISSING"),
            ("Invoice ## 77A", None, "MISSING"),
            ("Invoice #: TXN/1\nBill No: B-9", "B-9", "LOW"),
            # the label has no word end, and its parts may be on two lines
            ("Invoice Note ABC", "te", "HIGH"),
            ("TAX INVOICE\nNotes: paid", "tes", "HIGH"),
            ("INVOICE NO.\n\n  AB-9", "AB-9", "HIGH"),
            (f"Invoice{NBSP}No:{NBSP}X-1", "X-1", "HIGH"),
            ("Invoice No: A", None, "MISSING"),
        ],
    )


def test_invoice_date(spark):
    check_text(
        spark,
        "invoice_date",
        [
            ("Invoice Date: 12-03-2024", "12-03-2024", "HIGH"),
            ("Date: 05/11/2023", "05/11/2023", "HIGH"),
            ("Date- 5.11.23", "5.11.23", "HIGH"),
            ("Invoice Date: 12 March 2024", "12 March 2024", "LOW"),
            ("Dated: 12-03-2024", "12-03-2024", "LOW"),
            ("issued on 12/03/2024 in Pune", "12/03/2024", "LOW"),
            ("issued on 12/03/20245", None, "MISSING"),
            ("issued on 12.03.2024", None, "MISSING"),
            ("x12/03/2024", None, "MISSING"),
            ("Invoice No: INV-001\nVendor: ABC Ltd", None, "MISSING"),
        ],
    )


def test_vendor(spark):
    many_blank = "\n".join(["TAX INVOICE", *[""] * 13, "Late Traders"])
    check_text(
        spark,
        "vendor_name",
        [
            ("Reliance Industries Ltd\nGSTIN: 27\nInvoice No: 001", "Reliance Industries Ltd", "HIGH"),
            ("TAX INVOICE\nABC Private Limited\nGSTIN: 29", "ABC Private Limited", "HIGH"),
            ("12345\nABC Traders\nGSTIN: ...", "ABC Traders", "HIGH"),
            ("AB\n  A B  \nLonger Name", "A B", "LOW"),
            ("Billiton Minerals\nHomepage Ltd\nAcme Works", "Acme Works", "HIGH"),
            ("Acme\r\nInvoice", "Acme", "LOW"),
            ("12 34\n---\n₹₹₹\n", None, "MISSING"),
            ("TAX INVOICE\nकंपनी\nInvoice", None, "MISSING"),
            ("Invoice\u2028Unit Seven", "Unit Seven", "HIGH"),
            # line 15 is the last one looked at, and blank lines count
            (many_blank, "Late Traders", "HIGH"),
            ("\n" + many_blank, None, "MISSING"),
            (many_blank.replace("\n", "\r\n"), "Late Traders", "HIGH"),
        ],
    )


def check_amount(spark, name, cases):
    rows = read(spark, [case[0] for case in cases], name)
    for (text, value, confidence), row in zip(cases, rows, strict=True):
        assert (row[name], row[f"{name}_confidence"]) == (value, confidence), text


def test_subtotal(spark):
    check_amount(
        spark,
        "subtotal",
        [
            ("Sub Total: 25000.00", 25000.0, "HIGH"),
            ("Sub-Total Rs 1,00,000", 100000.0, "HIGH"),
            ("SUBTOTAL - INR 7.5", 7.5, "HIGH"),
            ("Total Before Tax: Rs. 9", 9.0, "LOW"),
            ("Taxable Value: Rs. 50,000.00", 50000.0, "LOW"),
            ("Taxable\nAmount\n₹ 12", 12.0, "LOW"),
            ("Amount Before GST: 3", 3.0, "LOW"),
            # the first pattern that matches ends the search, number or not
            ("Subtotal: ,\nTaxable Value: 5", None, "MISSING"),
            ("nothing here", None, "MISSING"),
        ],
    )


def test_grand_total(spark):
    check_amount(
        spark,
        "grand_total",
        [
            ("Grand Total: Rs. 59,000.00", 59000.0, "HIGH"),
            ("Grand Total: ₹59,000.00", 59000.0, "HIGH"),
            (f"Grand{NBSP}Total{NBSP}५००", 500.0, "HIGH"),
            ("Total Amount Due: Rs. 1,18,000.00", 118000.0, "LOW"),
            ("Net Payable: Rs. 29,500.00", 29500.0, "LOW"),
            ("Net Amount Due 8", 8.0, "LOW"),
            ("Amount Payable: 6", 6.0, "LOW"),
            ("Total Invoice Amount: 4", 4.0, "LOW"),
            ("Sub\n  Total: 29500.00  \nThanks", 29500.0, "LOW"),
            ("Total: 5 only", None, "MISSING"),
            ("My Total: 5", None, "MISSING"),
            ("Grand Total:" + " " * 20000 + "none", None, "MISSING"),
        ],
    )


def test_tax(spark):
    lines = "\n".join
    cases = [
        (lines(["Subtotal: Rs. 50,000.00", "GST (18%): Rs. 9,000.00", "Grand Total: Rs. 59,000.00"]),
         (None, None, None, 9000.0, "LOW")),
        (lines(["Taxable Value: Rs. 50,000.00", "CGST @ 9%: Rs. 4,500.00", "SGST @ 9%: Rs. 4,500.00"]),
         (4500.0, 4500.0, None, 9000.0, "HIGH")),
        ("IGST @ 18%: Rs. 18,000.00", (None, None, 18000.0, 18000.0, "LOW")),
        (lines(["CGST @ 2.5%: Rs. 500.00", "SGST @ 2.5%: Rs. 500.00", "CGST @ 9%: Rs. 2,700.00", "SGST @ 9%: Rs. 2,700.00"]),
         (3200.0, 3200.0, None, 6400.0, "HIGH")),
        ("Invoice No: 001\nAmount: Rs. 5,000", (None, None, None, None, "MISSING")),
        (lines(["Sub Total: 25000.00", "Tax Amount: 4500.00", "Total: 29500.00"]), (None, None, None, 4500.0, "LOW")),
        ("Output Tax ₹ 12.50", (None, None, None, 12.5, "LOW")),
        ("UTGST 9% 30\nSTGST 9% 12", (None, 42.0, None, 42.0, "HIGH")),
        # a component needs a rate right after its label; the general label then reads the line
        ("IGST: Rs. 18000.00", (None, None, None, None, "MISSING")),
        ("IGST 18000.00", (None, None, 0.0, None, "LOW")),
        ("IGST 18%", (None, None, 8.0, 8.0, "LOW")),
        ("CGST (9%): 100", (None, None, None, 100.0, "LOW")),
        # one component per line, in the order CGST, SGST, IGST
        ("SGST @ 9%: 5 CGST @ 9%: 7", (7.0, None, None, 7.0, "LOW")),
        ("IGST 5%: 5 SGST 5%: 6", (None, 6.0, None, 6.0, "LOW")),
        # an amount that is no number uses its line up, and is no hit
        ("CGST 9% ,\nTax Amount: 3", (None, None, None, 3.0, "LOW")),
        ("GST (18%): ,\nTax Amount: 3", (None, None, None, 3.0, "LOW")),
        # a component does not reach over a line end, a general label does
        ("CGST\n9 CGST @ 9%: 100", (100.0, None, None, 100.0, "LOW")),
        ("Tax\nAmount\n:\n8", (None, None, None, 8.0, "LOW")),
        ("cgst@9%:1.10\x0bsgst@9%:2.20", (1.1, 2.2, None, 3.3, "HIGH")),
    ]
    rows = read(spark, [case[0] for case in cases], "tax")
    for (text, expected), row in zip(cases, rows, strict=True):
        got = (row.cgst, row.sgst, row.igst, row.tax_amount, row.tax_amount_confidence)
        assert got == expected, text
    assert rows[4].tax_total == 0.0


def test_validation(spark):
    cases = [
        (50000.0, 9000.0, 59000.0, 1, ""),
        (10000.01, 1800.0, 11800.0, 1, ""),
        (100.0, 18.0, 119.0, 1, ""),
        (100.0, 18.0, 119.01, 0,
         "Total mismatch: grand_total=119.01, subtotal(100.00) + tax(18.00) = 118.00, diff=1.01"),
        (50000.0, 9000.0, 60000.0, 0,
         "Total mismatch: grand_total=60000.00, subtotal(50000.00) + tax(9000.00) = 59000.00, diff=1000.00"),
        (50000.0, None, 59000.0, 1, "Validation skipped — missing: tax_amount"),
        (None, None, None, 1, "Validation skipped — missing: subtotal, tax_amount, grand_total"),
        (1.0, 2.0, None, 1, "Validation skipped — missing: grand_total"),
    ]
    frame = spark.createDataFrame(
        [(i, *c[:3], "HIGH", "HIGH", "LOW") for i, c in enumerate(cases)],
        "i int, subtotal double, tax_amount double, grand_total double,"
        "invoice_id_confidence string, grand_total_confidence string, tax_amount_confidence string",
    )
    rows = extract.with_quality(frame).orderBy("i").collect()
    for case, row in zip(cases, rows, strict=True):
        assert (row.validation_passed, row.validation_note) == case[3:]
        assert row.overall_confidence == "HIGH"


@pytest.mark.parametrize(
    "levels, overall",
    [
        (("HIGH", "HIGH", "LOW"), "HIGH"),
        (("HIGH", "LOW", "LOW"), "LOW"),
        (("LOW", "LOW", "LOW"), "LOW"),
        (("HIGH", "MISSING", "LOW"), "LOW"),
        (("HIGH", "MISSING", "MISSING"), "MISSING"),
        ((None, "odd", "LOW"), "MISSING"),
    ],
)
def test_overall_confidence(spark, levels, overall):
    from billsift.functions.scoring import overall_confidence

    row = spark.createDataFrame([levels], "a string, b string, c string").select(
        overall_confidence(F.col("a"), F.col("b"), F.col("c")).alias("o")
    )
    assert row.first().o == overall


def test_rounding_follows_the_held_value(spark):
    values = [2.675, 0.125, 0.375, 1.005, 100.005, 1e7, 59000.0]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    rows = frame.select("x", amounts.round_money(F.col("x")).alias("r"), amounts.two_decimals(F.col("x")).alias("t"))
    for row in rows.collect():
        assert row.r == round(row.x, 2) and row.t == f"{row.x:.2f}"


def test_dates_are_day_first(spark):
    cases = {
        "12-03-2024": "2024-03-12",
        "05/11/2023": "2023-11-05",
        "5.1.23": "2023-01-05",
        "8-4-23": "2023-04-08",
        "12 March 2024": "2024-03-12",
        "12  mar\n2024": "2024-03-12",
        "१२-०३-२०२४": "2024-03-12",
        "31-02-2024": None,
        "13-13-2024": None,
        "12-03-202": None,
        "12 Foo 2024": None,
    }
    frame = spark.createDataFrame([*((t,) for t in cases), (None,)], "t string")
    rows = frame.select("t", dates.parse_invoice_date(F.col("t")).cast("string").alias("d")).collect()
    assert {r.t: r.d for r in rows} == {**cases, None: None}


def test_sums_are_exact_and_whole(spark):
    values = [0.1] * 1000 + [1e25, None]
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
    assert frame.filter("x < 1").agg(amounts.exact_sum(F.col("x")).alias("s")).first().s == 100.0
    assert frame.agg(amounts.exact_sum(F.col("x")).alias("s")).first().s == 1e25 + 100.0
    empty = frame.filter("x < 0").agg(
        amounts.exact_sum(F.col("x")).alias("s"), amounts.exact_mean(F.col("x")).alias("m")
    )
    assert tuple(empty.first()) == (None, None)


def test_printing(spark):
    frame = spark.createDataFrame([(1234567.5,), (118000.0,), (12345678.25,)], "x double")
    rows = frame.select(amounts.format_currency(F.col("x")), amounts.plain_number(F.col("x"))).collect()
    assert [tuple(r) for r in rows] == [
        ("Rs. 1,234,567.50", "1234567.5"),
        ("Rs. 118,000.00", "118000.0"),
        ("Rs. 12,345,678.25", "12345678.25"),
    ]
