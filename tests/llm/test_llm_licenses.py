"""Licence signatures against a search in plain Python."""

from __future__ import annotations

import random
import re

import pytest

from basketry.llm import licenses, queries

RULES = licenses.rules()
PIECES = [
    "MIT License",
    "the GNU Lesser General Public License, version 2.1",
    "GNU General Public License",
    "licensed under the Apache License, Version 2.0",
    "Apache license",
    "SPDX-License-Identifier: BSD-3-Clause",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "All rights reserved.",
    "https://www.apache.org/licenses/LICENSE-2.0.txt",
    "released under CC-BY-NC 4.0",
    "mit der Lizenz",
    "general public",
    "license",
    "words é without İ meaningK",
    "\n\t--\x00",
    "x2",
]


def words_of(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plainly(text):
    """The row that a text must give, by loops over words and places."""
    words = words_of(text)
    line = " ".join(words)
    base = []
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        for at in range(len(words)):
            if words[at : at + len(parts)] == parts:
                base.append((at, label))
    places = []
    for rule in RULES:
        for match in re.finditer(rule["pattern"], line):
            first = line[: match.start()].count(" ")
            places.append((first, first + match[0].count(" "), rule))
    kept = []
    for first, last, rule in places:
        def covers(other):
            a, b, by = other
            if not (a <= first and last <= b):
                return False
            if by["class"] != rule["class"]:
                return by["class"] < rule["class"]
            return (a, b) != (first, last) or by["rule"] < rule["rule"]

        if not any(covers(other) for other in places):
            kept.append((first, last, rule))
    base_labels = {label for _, label in base}
    strength = [licenses.STRENGTHS[rule["class"]] for _, _, rule in kept]
    at = [first for first, _ in base]
    return (
        len(words),
        len(base),
        min(at, default=None),
        max(at, default=None),
        ",".join(sorted(base_labels)),
        ",".join(sorted(base_labels | {rule["label"] for _, _, rule in kept})),
        max([0.0, *strength, *([0.5] if base else [])]),
        sorted((first, last, rule["rule"]) for first, last, rule in kept),
    )


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def found(df):
    return [
        (
            row["doc_id"],
            tuple(row[c] for c in COLUMNS)
            + (sorted((d["first_word"], d["last_word"], d["rule"]) for d in row["detections"]),),
        )
        for row in df.collect()
    ]


def test_there_are_hundreds_of_rules_with_their_keywords():
    assert len(RULES) > 250
    assert [rule["class"] for rule in RULES] == sorted(rule["class"] for rule in RULES)
    assert [rule["rule"] for rule in RULES] == list(range(len(RULES)))


def test_licences_match_a_plain_search(spark):
    dice = random.Random(13)
    texts = [None, "", " ", "license " * 3000, "a mit license mit license", "MIT LICENSE" * 2]
    texts += [
        dice.choice([" ", ", ", "\n", " - "]).join(dice.choices(PIECES, k=dice.randint(1, 9)))
        for _ in range(150)
    ]
    texts.append("MIT License; GNU General Public License v3 " * 1500)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = found(licenses.scanned(docs))
    assert len(rows) == len(texts)
    for doc, row in rows:
        if len(texts[doc] or "") < 10_000:
            assert row == plainly(texts[doc])
    long = dict(rows)[len(texts) - 1]
    assert long[:4] == (1500 * 7, 3000, 0, 7 * 1499 + 3) and len(long[-1]) == 3000


def test_longer_licence_hides_the_name_within_it(spark):
    text = "GNU Lesser General Public License version 2.1 or MIT License"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = licenses.scanned(docs).collect()[0]
    assert row["base_labels"] == "gpl,mit"
    assert [d["label"] for d in row["detections"]] == ["lgpl-2.1", "mit"]
    assert row["labels"] == "gpl,lgpl-2.1,mit"


@pytest.mark.parametrize("kind", ["long", "string"])
def test_odd_tables(spark, kind):
    rows = [(None, "MIT License", 1), (None, "MIT License", 1), (1, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words int")
    docs = docs.selectExpr(f"cast(doc_id as {kind}) doc_id", "text", "words", "words as keywords")
    found = licenses.scanned(docs)
    assert sorted(row["labels"] for row in found.collect()) == ["", "mit", "mit"]
    empty = licenses.scanned(docs.limit(0))
    assert empty.count() == 0 and empty.columns == found.columns


def test_query_returns_every_document(spark):
    found = queries.QUERIES["op13_license_signatures"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", *COLUMNS]
    texts = dict(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    )
    rows = found.collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row)[1:] == plainly(texts[row["doc_id"]])[:-1]
