"""One Spark session for the suite and a small, relationally complete set of extracts."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from basketry.sources.extracts import load_tables, stored_tables  # noqa: E402
from basketry.sources.model import MODEL  # noqa: E402

# The rows of the published fixture, whose results are known (see FIXTURES.md).
EXTRACTS = {
    "customers": """\
customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,1000,Sao Paulo,SP
c2,u1,1001,Campinas,SP
c3,u2,2000,Rio,RJ
""",
    "orders": """\
order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,\
order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2021-01-01 10:00:00,2021-01-01 10:05:00,2021-01-05 10:00:00,2021-01-10 10:00:00
o2,c2,delivered,2021-02-01 10:00:00,2021-02-01 10:05:00,2021-02-09 10:00:00,2021-02-08 10:00:00
o3,c3,delivered,2021-01-15 10:00:00,2021-01-15 10:05:00,2021-01-20 10:00:00,2021-01-25 10:00:00
o4,c3,canceled,2021-03-01 10:00:00,,,
""",
    "order_items": """\
order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,seller1,2021-01-01 10:00:00,10.0,2.0
o2,1,p2,seller1,2021-02-01 10:00:00,20.0,3.0
o3,1,p3,seller2,2021-01-15 10:00:00,15.0,1.0
""",
    "order_payments": """\
order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,1,10.0
o1,2,voucher,1,2.0
o2,1,boleto,1,23.0
o3,1,credit_card,1,16.0
""",
    "order_reviews": """\
review_id,order_id,review_score,review_comment_title,review_comment_message,\
review_creation_date,review_answer_timestamp
r1,o1,5,great,,2021-01-06,2021-01-07
r2,o2,3,ok,,2021-02-10,2021-02-11
""",
    "products": """\
product_id,product_category_name,product_name_lenght,product_description_lenght,\
product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,perfumaria,10,10,10,10,10,10,10
p2,beleza_saude,10,10,10,10,10,10,10
p3,esporte_lazer,10,10,10,10,10,10,10
""",
    "category_translation": """\
product_category_name,product_category_name_english
perfumaria,perfume
beleza_saude,health_beauty
esporte_lazer,sports_leisure
""",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("basketry-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.driver.memory", "4g")
        # Compiling each plan costs more than running it on a handful of rows.
        .config("spark.sql.codegen.wholeStage", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Extracts:
    """A directory of extracts that a test may edit."""

    def __init__(self, directory: Path) -> None:
        self.directory = directory
        for name, text in EXTRACTS.items():
            self.path(name).write_text(text, encoding="utf-8")

    def __str__(self) -> str:
        return str(self.directory)

    def path(self, name: str) -> Path:
        return self.directory / MODEL[name].file_name

    def replace(self, name: str, old: str, new: str) -> None:
        text = self.path(name).read_text(encoding="utf-8")
        assert old in text
        self.path(name).write_text(text.replace(old, new), encoding="utf-8")

    def append(self, name: str, line: str) -> None:
        with self.path(name).open("a", encoding="utf-8") as extract:
            extract.write(line + "\n")


@pytest.fixture
def extracts(tmp_path) -> Extracts:
    directory = tmp_path / "extracts"
    directory.mkdir()
    return Extracts(directory)


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """The unedited extracts, loaded once."""
    directory = tmp_path_factory.mktemp("extracts")
    stored = str(tmp_path_factory.mktemp("tables"))
    load_tables(spark, str(Extracts(directory)), stored)
    return stored_tables(spark, stored)


@pytest.fixture
def rows():
    """Rows as plain tuples, in the order of the result."""
    return lambda df: [tuple(row) for row in df.collect()]
