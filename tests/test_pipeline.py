from __future__ import annotations

import json

import pytest

from basketry.plans import bundle, pipeline, quality
from basketry.plans.reports import BUSINESS_REPORTS

ARTIFACTS = {
    "rfm_customers",
    "rfm_segments",
    "cohort_retention",
    "revenue_reconciliation",
    *BUSINESS_REPORTS,
    "charts/monthly_revenue",
    "charts/payment_method_revenue",
    "charts/delivery_by_state",
    "charts/rfm_segments",
    "charts/rfm_revenue",
    "charts/cohort_retention",
    "analysis_summary.json",
}


def document(path) -> str:
    [part] = path.glob("part-*")
    return part.read_text(encoding="utf-8")


def arguments(extracts, tmp_path) -> list[str]:
    return [
        f"--data-dir={extracts}",
        f"--tables-dir={tmp_path / 'tables'}",
        f"--output-dir={tmp_path / 'outputs'}",
    ]


def test_job_publishes_everything_and_reports_warnings(spark, extracts, tmp_path, capsys):
    extracts.replace("category_translation", "perfumaria,perfume\n", "")
    assert pipeline.main(arguments(extracts, tmp_path)) == 0
    printed = capsys.readouterr().out
    assert printed.count("wrote ") == len(ARTIFACTS)
    assert "check orders_missing_customer = 0\n" in printed
    assert "check products_without_category_translation = 1\n" in printed

    outputs = tmp_path / "outputs"
    assert all((outputs / name / "_SUCCESS").exists() for name in ARTIFACTS)
    people = spark.read.parquet(str(outputs / "rfm_customers"))
    assert people.count() == 2
    assert {path.name for path in (outputs / "rfm_customers").glob("segment=*")} == {
        "segment=Champions",
        "segment=Lost",
    }

    text = document(outputs / "analysis_summary.json")
    summary = json.loads(text)
    assert summary["schema_version"] == 1
    assert set(summary["business_queries"]) == set(BUSINESS_REPORTS)
    assert summary["business_queries"]["payment_method"][0] == {
        "orders": 1,
        "payment_method": "boleto",
        "revenue": 23.0,
    }
    assert summary["rfm_segments"] == [
        {"customers": 1, "revenue": 35.0, "segment": "Champions"},
        {"customers": 1, "revenue": 16.0, "segment": "Lost"},
    ]
    assert summary["cohort_retention"][1] == {
        "active_customers": 1,
        "cohort_customers": 2,
        "cohort_index": 1,
        "cohort_month": "2021-01",
        "retention_rate": 0.5,
    }
    assert summary["revenue_reconciliation"] == {
        "item_revenue": 51.0,
        "paid_delivered_orders": 3,
        "payment_item_variance": 0.0,
        "payment_revenue": 51.0,
        "untranslated_item_rows": 1,
    }
    assert "u1" not in text and "u2" not in text
    # Keys are in order at every level.
    assert text.strip() == json.dumps(
        json.loads(text, parse_float=_Literal), sort_keys=True, separators=(",", ":"), default=str
    ).replace('"<', "").replace('>"', "")
    # The document does not depend on the row order of what it is made from.
    def published(name):
        return spark.read.parquet(str(outputs / name)).repartition(3)

    again = bundle.analysis_bundle(
        {name: published(name) for name in BUSINESS_REPORTS},
        published("rfm_segments"),
        published("cohort_retention"),
        published("revenue_reconciliation"),
    )
    assert again.first().analysis_summary == text.strip()


class _Literal(str):
    """A number kept as written, marked so that its quotes can be taken off again."""

    def __new__(cls, text):
        return super().__new__(cls, f"<{text}>")


def test_fatal_check_stops_the_job_before_any_output(extracts, tmp_path, capsys):
    extracts.append("order_items", "missing,999,p1,seller1,2021-01-01 10:00:00,10.0,2.0")
    assert pipeline.main(arguments(extracts, tmp_path)) == 2
    printed = capsys.readouterr()
    assert "check order_items_missing_order = 1\n" in printed.out
    assert "order_items_missing_order" in printed.err
    assert not (tmp_path / "outputs").exists()
    assert (tmp_path / "tables" / "data_quality" / "_SUCCESS").exists()


def test_unknown_check_stops_the_job(spark, extracts, tmp_path, monkeypatch):
    unknown = spark.createDataFrame(
        [("future_check", 0)], "check_name string, violation_count bigint"
    )
    monkeypatch.setattr(quality, "dq_summary", lambda t: unknown)
    with pytest.raises(quality.ValidationPolicyError, match="future_check"):
        pipeline.run_pipeline(
            spark, str(extracts), str(tmp_path / "tables"), str(tmp_path / "outputs")
        )
    assert not (tmp_path / "outputs").exists()


def test_bundle_straight_from_the_tables(tables):
    summary = json.loads(bundle.bundle_of(tables).first().analysis_summary)
    assert [row["month"] for row in summary["business_queries"]["monthly_revenue"]] == [
        "2021-01",
        "2021-02",
    ]
    assert [row["customer_state"] for row in summary["business_queries"]["delivery_by_state"]] == [
        "SP",
        "RJ",
    ]
