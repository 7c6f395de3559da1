"""Accuracy and spending reports on small frames."""

from datetime import date

from billsift import schemas
from billsift.operators import accuracy, analytics, metrics

CORE = "invoice_id string, invoice_date string, vendor_name string, subtotal double, tax_amount double, grand_total double"


def joined(spark, truth, extracted):
    truth_rows = spark.createDataFrame([(*t, f"{i}.pdf") for i, t in enumerate(truth)], schemas.GROUND_TRUTH)
    return accuracy.accuracy_join(truth_rows, spark.createDataFrame(extracted, CORE))


TRUTH = [
    ("A", "01-01-2024", "Acme", 100.0, 18.0, 118.0),
    ("B", "02-01-2024", "Beta", 100.0, None, 12345678.0),
    ("C", "03-01-2024", None, 1.0, 1.0, 2.0),
    (None, "04-01-2024", "Nil", 1.0, 1.0, 2.0),
    ("A", "01-01-2024", "Acme", 100.0, 18.0, 118.0),
]
EXTRACTED = [
    ("A", " 01-01-2024", "ACME ", 101.0, 19.01, 118.0),
    ("B", "02-01-2024", None, None, 5.0, 12345678.9),
    (None, "04-01-2024", "Nil", 1.0, 1.0, 2.0),
]


def test_join_keeps_every_truth_row_once_per_match(spark):
    rows = joined(spark, TRUTH, EXTRACTED).collect()
    assert sorted((r.invoice_id or "", r.found) for r in rows) == [("", 0), ("A", 1), ("A", 1), ("B", 1), ("C", 0)]


def test_scores(spark):
    frame = joined(spark, TRUTH, EXTRACTED)
    by_field = {r.field: r for r in accuracy.accuracy_by_field(frame).collect()}
    scores = {f: (r.correct, r.scoreable) for f, r in by_field.items()}
    assert scores == {
        "invoice_date": (3, 5),
        "vendor_name": (2, 4),
        "subtotal": (2, 5),
        "tax_amount": (0, 4),
        "grand_total": (3, 5),
    }
    assert by_field["invoice_date"].accuracy_pct == 60.0
    assert by_field["invoice_date"].bar == "[" + "=" * 12 + " " * 8 + "]"
    overall = accuracy.accuracy_overall(accuracy.accuracy_by_field(frame)).first()
    assert (overall.total_correct, overall.total_possible) == (10, 23)
    rate = accuracy.match_rate(frame).first()
    assert tuple(rate) == (5, 3, 60.0)


def test_mismatches(spark):
    issues = {r.source_file: r.issues for r in accuracy.accuracy_mismatches(joined(spark, TRUTH, EXTRACTED)).collect()}
    assert issues["0.pdf"] == "tax_amount: truth <18.0>, read <19.01>"
    assert issues["1.pdf"] == "vendor_name: truth <Beta>, read <nan>; subtotal: truth <100.0>, read <nan>"
    assert set(issues) == {"0.pdf", "1.pdf", "2.pdf", "3.pdf", "4.pdf"}


def test_report_shows_ten_and_counts_the_rest(spark):
    truth = [(f"I{i:02d}", "x", "v", 1.0, 1.0, 2.0) for i in range(13)]
    mismatches = accuracy.accuracy_mismatches(joined(spark, truth, []))
    assert accuracy.mismatch_report(mismatches).count() == 10
    assert tuple(accuracy.mismatch_counts(mismatches).first()) == (13, 3)


def test_no_truth(spark):
    frame = joined(spark, [], EXTRACTED)
    assert tuple(accuracy.match_rate(frame).first()) == (0, 0, None)
    assert {r.accuracy_pct for r in accuracy.accuracy_by_field(frame).collect()} == {0.0}


def processed(spark, rows):
    return spark.createDataFrame(
        rows, "invoice_id string, invoice_date string, vendor_name string, tax_amount double, grand_total double,"
        "source_file string",
    )


ROWS = [
    ("A", "02-01-2024", "Zed", 1.0, 10.1, "1"),
    ("B", "1 January 2024", "Amy", None, 10.1, "2"),
    ("C", "bad", None, 2.0, 99.0, "3"),
    (None, "02/01/2024", "Nul", 0.5, None, "4"),
]


def test_spending(spark):
    table = processed(spark, ROWS)
    assert tuple(analytics.kpi_summary(table).first()) == (119.2, 3.5, 4)
    assert tuple(analytics.financial_summary(table).first()) == (119.2, 119.2 / 3)
    assert tuple(metrics.load_summary(table).first()) == (4, 119.2, 119.2 / 3)
    top = [tuple(r) for r in analytics.spend_by_vendor(table, top=3).collect()]
    assert top == [("Amy", 10.1), ("Zed", 10.1), ("Nul", 0.0)]
    days = [tuple(r) for r in analytics.spend_timeline(table).collect()]
    assert days == [(date(2024, 1, 1), 10.1), (date(2024, 1, 2), 10.1)]
    order = [r.source_file for r in analytics.explorer_view(table).collect()]
    assert order == ["4", "1", "2", "3"]


def test_spending_of_nothing(spark):
    table = processed(spark, [])
    assert tuple(analytics.kpi_summary(table).first()) == (0.0, 0.0, 0)
    assert tuple(analytics.financial_summary(table).first()) == (0.0, None)
    assert tuple(metrics.load_summary(table).first()) == (0, 0.0, 0.0)
    assert analytics.spend_by_vendor(table).isEmpty()
