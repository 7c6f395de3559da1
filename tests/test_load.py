"""Dedup, ids, inserts and the table on small frames."""

import pytest

from billsift import schemas
from billsift.operators import load
from billsift.session import new_path
from billsift.sources import tables


def records(spark, rows):
    """Records from (invoice_id, source_file, grand_total)."""
    frame = spark.createDataFrame(rows, "invoice_id string, source_file string, grand_total double")
    return load.conform(frame)


def brute_force_firsts(rows):
    seen, kept = set(), []
    for row in sorted(rows, key=lambda r: r[1]):
        if row[0] is None or row[0] not in seen:
            kept.append(row)
            seen.add(row[0])
    return kept


@pytest.fixture(scope="module")
def skewed():
    """One id holds a third of the rows, another third has none."""
    rows = [("HOT", f"f{i:05d}.pdf", float(i)) for i in range(0, 3000, 3)]
    rows += [(None, f"f{i:05d}.pdf", float(i)) for i in range(1, 3000, 3)]
    rows += [(f"INV-{i % 400}", f"f{i:05d}.pdf", float(i)) for i in range(2, 3000, 3)]
    return rows


def test_first_wins_under_skew(spark, skewed):
    frame = records(spark, skewed).repartition(9)
    got = load.dedup_first_wins(frame).select("invoice_id", "source_file", "grand_total").collect()
    expected = brute_force_firsts(skewed)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected
    counts = load.load_counts(frame).first()
    assert (counts.inserted, counts.skipped) == (len(expected), len(skewed) - len(expected))


def test_counts_of_nothing(spark):
    counts = load.load_counts(records(spark, [])).first()
    assert (counts.inserted, counts.skipped) == (0, 0)


def test_ids_follow_file_names_without_gaps(spark, skewed):
    firsts = load.dedup_first_wins(records(spark, skewed))
    numbered = load.with_surrogate_ids(firsts, start=10).select("id", "source_file").collect()
    expected = [row[1] for row in brute_force_firsts(skewed)]
    assert [r.source_file for r in sorted(numbered)] == expected
    assert [r.id for r in sorted(numbered)] == list(range(11, 11 + len(expected)))


def test_conform_defaults_and_casts(spark):
    frame = spark.createDataFrame(
        [("007", "12.5", "bad", "", None), ("8", None, "3", "note", "0")],
        "invoice_id string, subtotal string, tax_amount string, validation_note string, validation_passed string",
    )
    table = load.conform(frame)
    assert table.schema.fieldNames() == schemas.RECORD_COLUMNS
    first, second = table.orderBy("invoice_id").collect()
    assert (first.invoice_id, first.subtotal, first.tax_amount) == ("007", 12.5, None)
    assert (first.validation_note, first.validation_passed, first.overall_confidence) == (None, 1, None)
    assert (second.validation_note, second.validation_passed, second.tax_amount) == ("note", 0, 3.0)


def test_full_refresh_replaces(spark):
    path = new_path(spark, "table")
    tables.load_full_refresh(records(spark, [("A", "1.pdf", 1.0), ("B", "2.pdf", 2.0)]), path)
    table = tables.load_full_refresh(records(spark, [("C", "3.pdf", 3.0)]), path)
    assert [(r.id, r.invoice_id) for r in table.collect()] == [(1, "C")]
    assert table.columns == schemas.PROCESSED.fieldNames()
    assert table.filter("loaded_at IS NULL").isEmpty()


def test_incremental_is_idempotent_for_known_ids(spark):
    path = new_path(spark, "table")
    tables.load_full_refresh(records(spark, [("A", "1.pdf", 1.0), (None, "2.pdf", 2.0)]), path)
    batch = [("A", "3.pdf", 9.0), ("B", "5.pdf", 5.0), ("B", "4.pdf", 4.0), (None, "6.pdf", 6.0)]
    table = tables.load_incremental(records(spark, batch), path)
    rows = [(r.id, r.invoice_id, r.source_file) for r in table.orderBy("id").collect()]
    assert rows == [(1, "A", "1.pdf"), (2, None, "2.pdf"), (3, "B", "4.pdf"), (4, None, "6.pdf")]
    again = tables.load_incremental(records(spark, [r for r in batch if r[0]]), path)
    assert again.count() == 4


def test_incremental_without_news(spark):
    path = new_path(spark, "table")
    tables.load_full_refresh(records(spark, [("A", "1.pdf", 1.0)]), path)
    assert tables.load_incremental(records(spark, []), path).count() == 1


def test_run_log_appends(spark):
    path = new_path(spark, "log")
    tables.append_run_log(spark, path, {"invoices_found": 3, "notes": "SUCCESS"})
    log = tables.append_run_log(spark, path, {"invoices_found": 4, "notes": "SUCCESS"})
    assert [(r.id, r.invoices_found) for r in log.orderBy("id").collect()] == [(1, 3), (2, 4)]


def test_quarantine_is_kept_per_run(spark):
    path = new_path(spark, "failed")
    failed = spark.createDataFrame([("a.pdf", "no text")], "source_file string, reason string")
    rows = lambda frame: sorted(map(tuple, frame.collect()))
    assert rows(tables.write_failures(failed, path, run_id=1)) == [("a.pdf", "no text", 1)]
    both = tables.write_failures(failed, path, run_id=2, incremental=True)
    assert rows(both) == [("a.pdf", "no text", 1), ("a.pdf", "no text", 2)]
    assert rows(tables.write_failures(failed.limit(0), path, run_id=3, incremental=True)) == rows(both)
    assert rows(tables.write_failures(failed.limit(0), path, run_id=4)) == []


def test_records_without_id_or_file_are_all_kept(spark):
    frame = records(spark, [(None, None, 1.0), (None, None, 1.0), (None, "a.pdf", 2.0), ("A", None, 3.0), ("A", "b.pdf", 4.0)])
    assert load.dedup_first_wins(frame).count() == 4
    counts = load.load_counts(frame).first()
    assert (counts.inserted, counts.skipped) == (4, 1)


def test_first_batch_makes_the_table(spark):
    path = new_path(spark, "table")
    assert tables.load_batch(records(spark, [("A", "1.pdf", 1.0), (None, "2.pdf", 2.0)]), path, incremental=True) == 2
    assert tables.load_batch(records(spark, [("A", "3.pdf", 1.0), ("B", "4.pdf", 2.0)]), path, incremental=True) == 1
    table = tables.read_processed(spark, path).orderBy("id").collect()
    assert [(r.id, r.invoice_id, r.source_file) for r in table] == [(1, "A", "1.pdf"), (2, None, "2.pdf"), (3, "B", "4.pdf")]


def test_amounts_in_text_are_read_like_printed_ones(spark):
    frame = spark.createDataFrame([("1,23,456.78",), ("12d",), (None,)], "grand_total string")
    assert [r.grand_total for r in load.conform(frame).collect()] == [123456.78, None, None]


def test_failed_refresh_leaves_the_old_table(spark):
    from pyspark.sql import functions as F

    path = new_path(spark, "table")
    tables.load_full_refresh(records(spark, [("A", "1.pdf", 1.0), ("B", "2.pdf", 2.0)]), path)
    rows = [(f"N{i}", f"{i:04d}.pdf", float(i)) for i in range(500)]
    # The write fails half-way: one row's total raises once the tasks run.
    spoiled = records(spark, rows).withColumn(
        "grand_total", F.when(F.col("invoice_id") == "N250", F.raise_error(F.lit("bad row"))).otherwise(F.col("grand_total"))
    )
    with pytest.raises(Exception, match="bad row"):
        tables.load_full_refresh(spoiled, path)
    kept = tables.read_processed(spark, path)
    assert sorted((r.id, r.invoice_id) for r in kept.collect()) == [(1, "A"), (2, "B")]
    parent, name = path.rsplit("/", 1)
    import os

    assert [f for f in os.listdir(parent) if f.startswith(name + ".")] == []


def files_read(frame):
    """Files the scan of a frame read, from its metric after a run."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.length()) if "Scan" in leaves.apply(i).nodeName()]
    return sum(scan.metrics().apply("numFiles").value() for scan in scans)


def test_review_table_prunes_months_and_keeps_rows(spark, tmp_path):
    import datetime

    from pyspark.sql import functions as F

    from billsift.operators import analytics

    rows = [(f"I{i}", f"{i:04d}.pdf", float(i)) for i in range(600)]
    dated = records(spark, rows).withColumn(
        "invoice_dt", F.date_add(F.lit(datetime.date(1995, 1, 1)), (F.substring("invoice_id", 2, 4).cast("int") % 365))
    ).withColumn("validation_passed", (F.substring("invoice_id", 2, 4).cast("int") % 2).cast("int"))
    dated = dated.unionByName(records(spark, [("U", "u.pdf", 1.0)]).withColumn("invoice_dt", F.lit(None).cast("date"))
                              .withColumn("validation_passed", F.lit(1)))
    path = str(tmp_path / "review")
    tables.write_review_table(dated, path)
    table = tables.read_review_table(spark, path)
    assert table.count() == dated.count()
    queue = analytics.review_queue(table, passed=1, since=datetime.date(1995, 4, 1), until=datetime.date(1995, 6, 30))
    plan = queue._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(invoice_month" in plan and "invoice_month#" in plan
    assert files_read(queue) < files_read(table) == len(table.inputFiles())
    expected = dated.where("validation_passed = 1 AND invoice_dt BETWEEN DATE'1995-04-01' AND DATE'1995-06-30'")
    assert sorted(r.invoice_id for r in queue.collect()) == sorted(r.invoice_id for r in expected.collect())
    # Dynamic overwrite: writing April again replaces April only.
    tables.write_review_table(dated.where("month(invoice_dt) = 4"), path)
    assert tables.read_review_table(spark, path).count() == dated.count()


def test_rejected_values_are_named(spark):
    frame = spark.createDataFrame(
        [("a.pdf", "1,234.50", "1", "x"), ("b.pdf", "n/a", "maybe", None), ("c.pdf", " ", None, "y"), (None, None, "2x", "z")],
        "source_file string, grand_total string, validation_passed string, invoice_id string",
    )
    got = sorted((tuple(r) for r in load.rejected_values(frame).collect()), key=repr)
    want = [("b.pdf", "grand_total", "n/a"), ("b.pdf", "validation_passed", "maybe"), (None, "validation_passed", "2x")]
    assert got == sorted(want, key=repr)
    assert load.rejected_values(frame.select("invoice_id")).count() == 0
