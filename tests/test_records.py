from __future__ import annotations

import random

import pytest

from basketry.sources.extracts import read_text_columns
from basketry.sources.records import begun_inside, _lines, whole_records


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("300", "0")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def quoted(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


def extract(dice, rows: int, end: str) -> str:
    pieces = ["plain", 'a "quote"', "a,comma", "two\nlines", "\n", '"', '\n"\n', "é", " ", "x" * 40]
    lines = ["id,title,text"]
    for k in range(rows):
        title = dice.choice(["short", '5" disk', "", quoted("".join(dice.choices(pieces, k=2)))])
        text = quoted("".join(dice.choices(pieces, k=dice.randint(1, 6))))
        lines.append(f"{k},{title},{text}")
    return end.join(lines) + end


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_a_serial_read(spark, tmp_path, small_splits, end):
    folder = tmp_path / "extract.csv"
    folder.mkdir()
    dice = random.Random(len(end))
    for part in range(2):
        text = extract(dice, 60, end)
        (folder / f"part-{part}.csv").write_text(text, encoding="utf-8", newline="")
    path = str(folder)
    serial = spark.read.options(header=True, escape='"', multiLine=True).csv(path)
    names = serial.columns
    found = read_text_columns(spark, path, True)
    assert _lines(spark, path).rdd.getNumPartitions() > 8
    assert begun_inside(_lines(spark, path))
    assert sorted(map(str, found.select(*names).collect())) == sorted(map(str, serial.collect()))
    assert found.where("_malformed").count() == 0
    assert found.count() == 120


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    path = tmp_path / "one.csv"
    long = "\n".join(f"line {k}, and more" for k in range(200))
    path.write_text(f'id,text\n1,"{long}"\n2,short\n')
    found = read_text_columns(spark, str(path), True).select("id", "text").orderBy("id").collect()
    assert [tuple(row) for row in found] == [("1", long), ("2", "short")]


def test_surplus_fields_and_other_headers_are_seen(spark, tmp_path):
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('id,text\n1,"x\ny",z\n')
    found = read_text_columns(spark, str(folder), True)
    assert found.where("_malformed").count() == 1
    (folder / "b.csv").write_text('text,id\n1,"x\ny"\n')
    with pytest.raises(ValueError, match="header"):
        read_text_columns(spark, str(folder), True)


def test_quote_that_is_never_closed_and_empty_files(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('id,text\n1,"x\ny\n')
    assert [row["record"] for row in whole_records(spark, str(path)).where("not first").collect()] == [
        '1,"x\ny'
    ]
    path.write_text("id,text\n")
    assert read_text_columns(spark, str(path), True).count() == 0
