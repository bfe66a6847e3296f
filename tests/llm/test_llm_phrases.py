"""Collocations against counting in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from basketry.llm import phrases, queries


def plainly(rows, least, longest=5, top=2000, percent=100):
    """The first phrases of each language, by counting all phrases of all lengths."""
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            for size in range(1, longest + 1):
                count[lang].update(words[k : k + size] for k in range(len(words) - size + 1))
    out = []
    for lang, f in count.items():
        often = {p: n for p, n in f.items() if n >= least and len(p) > 1}
        gone = set()
        for p, n in often.items():
            for size in range(2, len(p)):
                for k in range(len(p) - size + 1):
                    inner = p[k : k + size]
                    if 100 * n >= percent * f[inner]:
                        gone.add(inner)
        n, rows = total[lang], []
        for p in often.keys() - gone:
            cut = min(
                (1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                for k in range(1, len(p))
            )
            rows.append((" ".join(p), f[p], cut[2], cut[3], n, cut[0]))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, rank, *row) for rank, row in enumerate(rows[:top], 1)]
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
SCHEMA = "lang string, text string"


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(row) for row in df.collect())


def texts(dice, n):
    words = ["the", "The", "of", "a", "é", "ée", "x-y", "'tis", "new", "york", "city", "\x00", "ﬁ"]
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "!?", ";", "\x0b", " "]
    out = [
        "".join(dice.choice(words) + dice.choice(marks) for _ in range(dice.randint(0, 40)))
        for _ in range(n)
    ]
    return out + ["new york city hall " * 30, "new york, new york", None, "", " ", "..."]


@pytest.mark.parametrize("least", [2, 9, 100])
def test_collocations_match_a_plain_count(spark, least):
    dice = random.Random(least)
    rows = [(dice.choice(["en", "en", "en", "de", "und", None, ""]), t) for t in texts(dice, 300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(phrases.collocations(docs, least)) == plainly(rows, least)


def test_small_chunks_hot_prefixes_and_full_bitmaps(spark, monkeypatch):
    for name, value in (("GATHERED", 50), ("SEGMENT", 60), ("HOT", 30), ("ROWS", 7)):
        monkeypatch.setattr(phrases, name, value)
    dice = random.Random(1)
    rows = [(dice.choice(["en", "fr"]), t) for t in texts(dice, 120)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for bits, cells in ((15, 20), (3, 3), (27, 10)):
        assert found(phrases.collocations(docs, 3, bits=bits, cells=cells)) == plainly(rows, 3)


def test_counts_beyond_a_byte_in_cells(spark):
    rows = [("en", "new york " * 100)] * 4 + [("en", "old york " * 299)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for least in (300, 400, 401):
        assert found(phrases.collocations(docs, least)) == plainly(rows, least)


def test_rank_and_subsumption_limits(spark):
    dice = random.Random(2)
    rows = [("en", t) for t in texts(dice, 200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(phrases.collocations(docs, 3, top=7)) == plainly(rows, 3, top=7)
    assert found(phrases.collocations(docs, 3, longest=3, percent=60)) == plainly(
        rows, 3, longest=3, percent=60
    )


def test_segments_of_long_texts_hold_each_run_once():
    dice = random.Random(4)
    for _ in range(200):
        text = "".join(dice.choices("ab cd. ", k=dice.randint(1, 300)))
        data = np.frombuffer(text.encode(), np.uint8)
        for overlap in (0, 1, 4):
            whole, pieces = Counter(), Counter()
            spans = list(phrases.borders(data, overlap, 20))
            for a, b, into in [(0, len(data), whole)] + [(a, b, pieces) for a, b in spans]:
                words = re.findall(r"[^\x20\x09.,;:!?\x0a-\x0d]+", text[a:b])
                into.update(tuple(words[k : k + overlap + 1]) for k in range(len(words) - overlap))
            assert whole == pieces


def test_big_numbers_stay_exact(spark):
    # Products of 10 ** 5 occurrences pass 2 ** 53 on the way.
    rows = [("en", "a b " * 100_000 + "c " * 50_000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(phrases.collocations(docs)) == plainly(rows, 100)


def test_odd_tables(spark):
    docs = spark.createDataFrame([("en", "new york " * 3)] * 4, SCHEMA)
    docs = docs.selectExpr("*", "1 as n", "2 as phrase", "3 as rank", "null as doc_id")
    assert found(phrases.collocations(docs, 5)) == plainly([("en", "new york " * 3)] * 4, 5)
    empty = phrases.collocations(docs.limit(0))
    assert empty.collect() == [] and empty.columns == COLUMNS


def test_query_matches_on_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()
    want = plainly([tuple(row) for row in rows], phrases.LEAST)
    assert want and found(queries.QUERIES["op11_phrase_collocations"](spark, folder)) == want


def test_rare_phrases_seldom_share_the_cells_of_frequent_ones(spark, monkeypatch):
    entries = spark.sparkContext.accumulator(0)
    whole = phrases._stripes

    def stripes(*options):
        def run(batches):
            for batch in whole(*options)(batches):
                entries.add(len(batch.column("words").flatten()))
                yield batch

        return run

    monkeypatch.setattr(phrases, "_stripes", stripes)
    dice = random.Random(3)
    pairs = [f"w{a} w{b}." for a in range(150) for b in range(150)]
    rows = [("en", " ".join(pairs))]
    rows += [("en", " ".join(dice.sample(pairs, 200)))] * 25
    found, _ = phrases.frequent_phrases(spark.createDataFrame(rows, SCHEMA).coalesce(1), 20, cells=12)
    assert found.where("words = 2").count() == 200
    assert entries.value < 500
