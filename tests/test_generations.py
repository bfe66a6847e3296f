from __future__ import annotations

import pytest

from basketry.operators import audit
from basketry.operators.audit import key_audit, repeated_keys
from basketry.operators.views import register_catalog
from basketry.sources import extracts as loading
from basketry.sources import load
from basketry.sources.extracts import load_tables, stored_tables
from basketry.sources.generations import Generations, NothingPublished
from basketry.sources.model import MODEL


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "tables")


def counts(t):
    return {name: df.count() for name, df in t.items()}


def test_failing_write_leaves_the_old_tables_whole(spark, extracts, folder, monkeypatch):
    load_tables(spark, str(extracts), folder)
    before = counts(stored_tables(spark, folder))
    extracts.append("customers", "c9,u9,1000,Sao Paulo,SP")
    extracts.append("orders", "o9,c9,canceled,2021-03-01 10:00:00,,,")
    written, write = [], loading._written

    def failing(name, df, path):
        if len(written) == 3:
            raise OSError("no space left")
        write(name, df, path)
        written.append(name)

    monkeypatch.setattr(loading, "_written", failing)
    with pytest.raises(OSError, match="no space"):
        load_tables(spark, str(extracts), folder)
    assert written == list(MODEL)[:3]
    assert counts(stored_tables(spark, folder)) == before
    assert Generations(spark, folder).versions() == [1]
    monkeypatch.undo()
    load_tables(spark, str(extracts), folder)
    after = counts(stored_tables(spark, folder))
    assert (after["customers"], after["orders"]) == (before["customers"] + 1, before["orders"] + 1)


def test_refused_load_removes_what_it_wrote(spark, extracts, folder, tmp_path):
    load_tables(spark, str(extracts), folder)
    kept = sorted(p.name for p in (tmp_path / "tables" / "_generations").iterdir() if p.is_dir())
    extracts.append("orders", "o1,c1,delivered,2021-01-01 10:00:00,,,")
    with pytest.raises(ValueError, match="duplicate key"):
        load_tables(spark, str(extracts), folder)
    now = sorted(p.name for p in (tmp_path / "tables" / "_generations").iterdir() if p.is_dir())
    assert now == kept and len(kept) == 1


def test_readers_of_an_older_version_go_on(spark, extracts, folder):
    load_tables(spark, str(extracts), folder)
    reader = stored_tables(spark, folder)
    extracts.append("customers", "c9,u9,1000,Sao Paulo,SP")
    load_tables(spark, str(extracts), folder)
    assert reader.customers.count() == 3
    assert stored_tables(spark, folder, version=1).customers.count() == 3
    assert stored_tables(spark, folder).customers.count() == 4
    manifest = Generations(spark, folder).read(1)
    assert manifest.version == 1 and manifest.counts["customers"] == 3


def test_nothing_published(spark, extracts, folder):
    with pytest.raises(NothingPublished, match="no a version|holds no"):
        stored_tables(spark, folder)
    load_tables(spark, str(extracts), folder)
    with pytest.raises(NothingPublished, match="version 7"):
        stored_tables(spark, folder, version=7)


def test_version_taken_by_another_load_is_not_overwritten(spark, folder, monkeypatch):
    generations = Generations(spark, folder)
    generations.publish("first", {"t": 1})
    # Another load published between looking and renaming.
    monkeypatch.setattr(Generations, "versions", lambda self: [])
    with pytest.raises(FileExistsError, match="version 1"):
        generations.publish("second", {"t": 2})
    monkeypatch.undo()
    assert generations.read().generation == "first"
    with pytest.raises(ValueError, match="is published"):
        generations.abandon("first")


def test_load_command_prints_the_counts(extracts, folder, capsys):
    arguments = [f"--data-dir={extracts}", f"--tables-dir={folder}"]
    assert load.main(arguments) == 0
    assert capsys.readouterr().out.splitlines()[:2] == ["customers: 3 rows", "orders: 4 rows"]
    extracts.append("orders", "o1,c1,delivered,2021-01-01 10:00:00,,,")
    assert load.main(arguments) == 2
    printed = capsys.readouterr()
    assert printed.out == "" and "duplicate key" in printed.err


def test_catalog_tables_have_statistics(spark, extracts, folder, rows):
    load_tables(spark, str(extracts), folder)
    names = register_catalog(spark, folder, "shop")
    assert names == [f"shop.{name}" for name in MODEL]
    described = {
        row["col_name"]: row["data_type"]
        for row in spark.sql("DESCRIBE EXTENDED shop.orders").collect()
    }
    assert "4 rows" in described["Statistics"]
    column = {
        row["info_name"]: row["info_value"]
        for row in spark.sql("DESCRIBE EXTENDED shop.orders order_id").collect()
    }
    assert column["distinct_count"] == "4"
    joined = """
        SELECT c.customer_state, count(*) AS orders
        FROM shop.orders o JOIN shop.customers c USING (customer_id)
        GROUP BY ALL ORDER BY customer_state"""
    assert rows(spark.sql(joined)) == [("RJ", 2), ("SP", 2)]
    # A join is sized from the rows of its sides, not from the size of files.
    spark.conf.set("spark.sql.cbo.enabled", True)
    try:
        cost = spark.sql("EXPLAIN COST " + joined).first()[0]
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
    assert "rowCount=4" in cost
    extracts.append("orders", "o9,c1,canceled,2021-03-01 10:00:00,,,")
    load_tables(spark, str(extracts), folder)
    register_catalog(spark, folder, "shop")
    assert spark.table("shop.orders").count() == 5


REPEATED = {"orders": 0, "order_items": 2, "customers": 1}


def with_repeats(tables):
    return tables.replaced(
        order_items=tables.order_items.unionAll(tables.order_items.limit(2)),
        customers=tables.customers.unionAll(tables.customers.limit(1)),
    )


def found_repeats(t):
    found = {row["table_name"]: row["duplicate_keys"] for row in repeated_keys(t).collect()}
    assert found.keys() == MODEL.keys()
    return {name: found[name] for name in REPEATED}


def test_repeated_keys_are_counted(tables):
    assert found_repeats(with_repeats(tables)) == REPEATED
    audits = {row["table_name"]: row for row in key_audit(with_repeats(tables)).collect()}
    assert audits["customers"]["row_count"] == 4
    assert audits["customers"]["duplicate_keys"] == 1


def test_fingerprints_that_collide_change_nothing(tables, monkeypatch):
    real = audit.fingerprint
    for same in (1, 2):
        monkeypatch.setattr(audit, "fingerprint", lambda keys: real(keys) % same)
        assert found_repeats(with_repeats(tables)) == REPEATED


def test_many_fingerprints_meet_by_a_join(tables, monkeypatch):
    monkeypatch.setattr(audit, "SENT", 0)
    assert found_repeats(with_repeats(tables)) == REPEATED


def test_keys_themselves_are_not_exchanged(spark, tables):
    """The first look moves 16 bytes a key and no text."""
    plan = audit.met_twice(tables)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "print" in exchanges[0]
    assert "order_id" not in exchanges[0] and "customer_id" not in exchanges[0]
