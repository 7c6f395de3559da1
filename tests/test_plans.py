"""Plans: what must and must not be in them."""

import re

import pytest

from billsift import schemas
from billsift.functions import labels
from billsift.operators import accuracy, analytics, extract, load
from billsift.session import new_path
from billsift.sources import tables


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def documents(spark):
    path = new_path(spark, "documents")
    spark.createDataFrame([(1, "a.pdf", "Invoice No: A-1", None)], schemas.DOCUMENTS).write.parquet(path)
    return spark.read.schema(schemas.DOCUMENTS).parquet(path)


@pytest.fixture(scope="module")
def processed(spark, documents):
    path = new_path(spark, "processed")
    return tables.load_full_refresh(extract.extract_records(documents), path)


def test_extraction_is_narrow_and_stays_in_the_engine(documents):
    plan = plan_of(extract.extract_records(documents))
    for banned in ("Exchange", "Python", "ArrowEval", "Join", "Sort"):
        assert banned not in plan
    assert "doc_id" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_every_pattern_runs_once(documents):
    plan = plan_of(extract.read_documents(documents))
    banks = (labels.INVOICE_ID_BANK, labels.DATE_BANK, labels.SUBTOTAL_BANK, labels.GRAND_TOTAL_BANK)
    components = (labels.CGST_BANK, labels.SGST_BANK, labels.IGST_BANK, labels.GENERIC_TAX_BANK, [labels.VENDOR_LINE])
    assert plan.count("regexp_extract(") == sum(map(len, banks + components))
    assert plan.count("regexp_extract_all(") == 2


def test_dedup_limits_copies_before_the_shuffle(documents):
    plan = plan_of(load.dedup_first_wins(extract.extract_records(documents)))
    assert plan.count("Exchange hashpartitioning") == 1
    before, after = plan.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_top_vendors_need_one_shuffle_and_no_full_sort(processed):
    plan = plan_of(analytics.spend_by_vendor(processed))
    assert "TakeOrderedAndProject" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("HashAggregate") == 2
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert schema == "struct<vendor_name:string,grand_total:double>"


def test_review_filters_reach_the_scan(processed):
    plan = plan_of(analytics.review_queue(processed, passed=0, confidence="LOW", vendor="Acme"))
    pushed = plan[plan.index("PushedFilters") :]  # Spark cuts the list off after 100 characters
    for column in ("validation_passed", "overall_confidence", "vendor_name"):
        assert f"IsNotNull({column})" in pushed
    assert "EqualTo(val" in pushed


def test_accuracy_scores_rows_without_multiplying_them(spark, processed):
    truth = spark.createDataFrame([], schemas.GROUND_TRUTH)
    joined = accuracy.accuracy_join(truth, tables.core_columns(processed))
    plan = plan_of(accuracy.accuracy_by_field(joined))
    assert "Expand" not in plan
    assert plan.index("Generate") < plan.index("HashAggregate")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_incremental_load_cuts_the_target_down_first(spark, processed):
    batch = load.conform(spark.createDataFrame([("A", "a.pdf")], "invoice_id string, source_file string"))
    plan = plan_of(load.new_records(batch, processed))
    assert "LeftSemi" in plan and "LeftAnti" in plan
    schemas_read = re.findall(r"ReadSchema: (.*)", plan)
    assert "struct<invoice_id:string>" in schemas_read


def test_days_are_read_from_the_table_and_pushed_down(processed):
    from datetime import date

    plan = plan_of(analytics.review_queue(processed, since=date(2024, 3, 1), until=date(2024, 3, 31)))
    assert "invoice_dt" in plan[plan.index("PushedFilters") :]
    for frame in (analytics.spend_timeline(processed), analytics.explorer_view(processed)):
        assert "gettimestamp" not in plan_of(frame).lower() and "to_date" not in plan_of(frame).lower()
