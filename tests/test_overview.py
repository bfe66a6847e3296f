from __future__ import annotations

import re
from collections import Counter

import pytest

from basketry.plans import bundle, overview, persons, quality, rfm
from basketry.sources.testdata import open_tables

SF_DIR = "/root/testdata/sf0.001"


def scans(df) -> Counter:
    """How often each test table is scanned, scalar subqueries included."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert plan
    # A subquery that is used again is printed again.
    text = re.split(r"ReusedSubquery", text)[0]
    return Counter(re.findall(r"FileScan parquet [^\n]*?/(\w+)\.parquet", text))


def test_summary_scans_each_table_once(spark):
    found = scans(quality.dq_summary(open_tables(spark, SF_DIR)))
    # lineitem stands for items, payments and reviews, part for products and translations.
    assert found == {"customer": 1, "nation": 1, "orders": 1, "lineitem": 3, "part": 2}


def test_parts_scan_each_relation_at_most_once(spark):
    t = open_tables(spark, SF_DIR)
    assert scans(overview.visits(t)) == {"orders": 1, "lineitem": 1, "customer": 1, "nation": 1}
    parts = overview.all_reports(t)
    for name, expected in {
        "deliveries": {},
        "items": {"lineitem": 1, "part": 2},
        "reviews": {"lineitem": 1},
        "segments": {},
        "retention": {},
    }.items():
        assert scans(parts[name]) == expected, name


def test_bundle_is_the_same_from_stored_deliveries(tables):
    straight = bundle.bundle_of(tables).first().analysis_summary
    stored = tables.with_stored(overview.VISITS, overview.visits(tables))
    assert bundle.bundle_of(stored).first().analysis_summary == straight


def test_deliveries_without_customer_or_method(spark, extracts):
    """Orders of nobody count in the reports over orders only, as in the single reports."""
    from basketry.plans import cohorts, reports
    from basketry.sources.extracts import read_extracts

    extracts.append("orders", "o5,nobody,delivered,2021-04-01 10:00:00,,2021-04-03 10:00:00,2021-04-09 10:00:00")
    extracts.append("order_payments", "o5,1,,1,5.0")
    extracts.append("order_items", "o5,1,gone,seller1,2021-01-01 10:00:00,1.0,")
    extracts.append("order_reviews", "r5,o5,1,,,2021-02-10,2021-02-11")
    extracts.append("order_reviews", "r6,o1,4,,,2021-02-10,2021-02-11")
    t = read_extracts(spark, str(extracts))
    whole = bundle.bundle_of(t).first().analysis_summary
    parts = bundle.analysis_bundle(
        {name: report(t) for name, report in reports.BUSINESS_REPORTS.items()},
        rfm.rfm_segments(rfm.rfm_customers(t)),
        cohorts.cohort_retention(t),
        reports.revenue_reconciliation(t),
    )
    assert whole == parts.first().analysis_summary


def test_person_files_are_of_a_size(spark, tmp_path):
    rows = [(f"u{k}", "Lost" if k % 50 else "Champions", float(k % 97)) for k in range(20_000)]
    people = spark.createDataFrame(rows, "customer_unique_id string, segment string, monetary double")
    path = tmp_path / "people"
    persons.write_persons(people, str(path), rows_per_file=400)
    files = {}
    for part in path.glob("segment=*/*.parquet"):
        df = spark.read.parquet(str(part))
        order = [(-row["monetary"], row["customer_unique_id"]) for row in df.collect()]
        assert order == sorted(order)
        files.setdefault(part.parent.name, []).append(len(order))
    assert len(files["segment=Lost"]) == 49 and len(files["segment=Champions"]) == 1
    sizes = [n for some in files.values() for n in some]
    assert max(sizes) <= 2 * min(sizes) and sum(sizes) == 20_000
    assert persons.read_persons(spark, str(path), people).columns == people.columns


def test_person_sink_without_persons(spark, tmp_path):
    people = spark.createDataFrame([], "customer_unique_id string, segment string, monetary double")
    persons.write_persons(people, str(tmp_path / "people"))
    assert persons.read_persons(spark, str(tmp_path / "people"), people).count() == 0


def test_gate_names_checks_with_their_counts(spark):
    summary = spark.createDataFrame(
        [("orders_missing_customer", 3), ("payments_missing_order", 12)],
        "check_name string, violation_count bigint",
    )
    with pytest.raises(quality.ValidationPolicyError) as error:
        quality.enforce_policy(summary)
    found = "(orders_missing_customer in 3 rows; payments_missing_order in 12 rows)"
    assert found in str(error.value)
