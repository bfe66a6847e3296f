"""Similar documents, repeated strings and near-duplicate vectors, against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import components, embeddings, jaccard, suffixes


def joined(nodes, links) -> dict[int, int]:
    """Smallest node of each node's component."""
    parent = {node: node for node in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in nodes}


def test_components(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 40)]
    links += [(60, 61), (62, 61), (62, 63), (63, 60), (5, 5), (60, 61)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    found = {row["id"]: row["component"] for row in components.components(df).collect()}
    expected = joined({x for link in links for x in link} - {5}, [p for p in links if p[0] != 5])
    assert found == expected


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def test_similar_components(spark, monkeypatch):
    # Few occurrences make a token frequent here, so that pairs of tokens are keys, too.
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    rng = random.Random(5)
    words = [f"W{k}" for k in range(30)]
    texts = ["", None, " \t", "One", "one", "one two", "ONE TWO", "one two three"]
    for size in (5, 9, 14, 60, 200):
        base = [rng.choice(words) for _ in range(size)]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2]) * max(1, size // 60)):
                own[rng.randrange(size)] = rng.choice(words)
            if rng.random() < 0.3:
                own = own[: rng.randrange(1, size + 1)]
            texts.append(" ".join(own))
    rows = [(k, text, "k", 0) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, n long")
    again = docs.where("doc_id = 20")
    found = {
        row["doc_id"]: (row["n_shingles"], row["component_id"])
        for row in jaccard.similar_components(docs.union(again).repartition(5)).collect()
    }
    sets = {k: shingles(text) for k, text in enumerate(texts)}
    links = [
        (a, b)
        for a in sets
        for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    of = joined(sets, links)
    assert found == {k: (len(sets[k]), of[k]) for k in sets}
    assert jaccard.similar_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("linking", [10, 1])
def test_near_copies_are_not_compared_all_with_all(spark, monkeypatch, linking):
    # No rounds before: what is left is compared across components at once. With 1 of 1 that has to
    # link, all are compared after the first that are drawn.
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    monkeypatch.setattr(jaccard, "LINKING", linking)
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", 3)
    compared = []
    tested = jaccard.verified

    def verified(pairs, *rest):
        compared.append(pairs.count())
        return tested(pairs, *rest)

    monkeypatch.setattr(jaccard, "verified", verified)
    rng = random.Random(9)
    base, texts = [f"w{k}" for k in range(200)], []
    for changed in [1] * 120 + [2] * 20 + [3] * 20:
        own = list(base)
        for at in rng.sample(range(200), changed):
            own[at] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(own))
    # Copies over several tasks are one row of a list.
    rows = [*enumerate(texts), *((1000 + k, texts[-1]) for k in range(100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    found = {row["doc_id"]: row["component_id"] for row in jaccard.similar_components(docs).collect()}
    sets = {k: shingles(text) for k, text in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if b < a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    assert found == joined(sets, links)
    assert sum(compared) < (2_500 if linking > 1 else 5_000)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 77, 500])
def test_keys_survive_the_loss_of_a_fifth(n):
    rng = np.random.default_rng(n)
    for often in (0.0, 0.3, 1.0):
        tokens = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
        frequent = rng.random(n) < often
        own = set(jaccard.keys_of(tokens, frequent).tolist())
        for lost in (0, n // 5):
            if n == 1 and often == 1.0:
                continue  # equal sets only, which link by their digest
            left = np.ones(n, bool)
            left[rng.permutation(n)[:lost]] = False
            left[: 0 if lost == 0 else 1] = False
            if (~left).sum() > n // 5:
                left[0] = True
            other = jaccard.keys_of(tokens[left], frequent[left])
            assert own & set(other.tolist())


def without(docs, length=50):
    first = {}
    for doc, text in sorted(docs, key=lambda row: row[0]):
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            first.setdefault(data[k : k + length], doc)
    out = {}
    for doc, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            if first[data[k : k + length]] < doc:
                gone[k : k + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(byte for byte, is_gone in zip(data, gone) if not is_gone)
        out[doc] = (len(data), int(gone.sum()), runs, kept)
    return out


@pytest.mark.parametrize("length", [3, 50])
def test_repeated_windows(length):
    rng = random.Random(length)
    for _ in range(15):
        bases = ["".join(rng.choice("ab") for _ in range(rng.randrange(60, 200))) for _ in range(4)]
        contents = []
        for _ in range(12):
            begin = rng.randrange(0, 50)
            own = rng.choice(bases)[begin : begin + rng.randrange(length, 140)]
            cut = rng.randrange(len(own))
            contents.append((own[:cut] + rng.choice("abc") + own[cut + 1 :]).encode())
        docs = np.array([rng.randrange(6) for _ in contents])
        first = {}
        for own, doc in zip(contents, docs):
            for k in range(len(own) - length + 1):
                window = own[k : k + length]
                first[window] = min(first.get(window, 99), doc)
        expected = {
            (at, k)
            for at, own in enumerate(contents)
            for k in range(len(own) - length + 1)
            if first[own[k : k + length]] < docs[at]
        }
        found = suffixes.repeated_windows(contents, docs, length)
        assert set(zip(*(x.tolist() for x in found))) == expected


def test_without_repeats(spark):
    rng = random.Random(1)
    parts = ["".join(rng.choice("abc é") for _ in range(rng.randrange(40, 120))) for _ in range(5)]
    parts += ["a" * 200, "ab" * 150]
    rows = [(100, None), (101, ""), (102, parts[0] * 2), (103, parts[0] * 2)]
    for k in range(50):
        own = ""
        for _ in range(rng.randrange(0, 5)):
            own += rng.choice(parts)[rng.randrange(0, 30) :]
            own += "".join(rng.choice("xyz") for _ in range(rng.randrange(0, 30)))
        rows.append((k * 37 % 53, own))
    docs = spark.createDataFrame([(*row, 0) for row in rows], "doc_id long, text string, key int")
    found = {
        row["doc_id"]: (row["n_bytes"], row["n_removed"], row["n_spans"], bytes(row["kept"]))
        for row in suffixes.without_repeats(docs.repartition(4)).collect()
    }
    assert found == without(rows)
    assert suffixes.without_repeats(docs.limit(0)).count() == 0
    cut = {row["doc_id"]: row["text"] for row in suffixes.cut_documents(docs).collect()}
    assert cut == {
        doc: kept.decode("utf-8", "ignore") if gone else text
        for (doc, text), (_, gone, _, kept) in zip(rows, without(rows).values())
    }


def test_repeated_rows_and_ids(spark):
    text = "x" * 30 + "y" * 40
    rows = [(1, text), (1, text), (2, text), (None, text), (3, "z" * 60), (3, "a" * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(
        (row["doc_id"] or 0, row["n_removed"]) for row in suffixes.without_repeats(docs).collect()
    )
    # Of the texts of 3 the smallest is the document, and where an id has two, rows of one are one.
    assert found == [(0, 0), (1, 0), (2, 70), (3, 0)]


def test_near_duplicate_vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 16))
    vectors = [c + rng.standard_normal(16) * s for c in centres for s in (0.05, 0.1, 0.2, 0.4) * 5]
    vectors += list(rng.standard_normal((40, 16)))
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    n = len(rows)
    rows += [
        (n, None),
        (n + 1, [0.0] * 16),
        (n + 2, [None, *[1.0] * 15]),
        (n + 3, [float("nan"), *[1.0] * 15]),
        (n + 4, [1e-30 * float(x) for x in vectors[0]]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {
        row["vec_id"]: row for row in embeddings.near_duplicates(df, block=8, tables=64).collect()
    }
    table = np.array([*vectors, vectors[0]], np.float32).astype(float)
    table /= np.linalg.norm(table, axis=1)[:, None]
    ids = [*range(n), n + 4]
    close = table @ table.T >= 0.9
    expected, links = defaultdict(int), []
    for i, j in zip(*np.nonzero(np.triu(close, 1))):
        expected[ids[i]] += 1
        expected[ids[j]] += 1
        links.append((ids[i], ids[j]))
    of = joined(found, links)
    assert {k: row["n_links"] for k, row in found.items()} == {k: expected[k] for k in found}
    assert {k: row["component_id"] for k, row in found.items()} == of
    assert all(row["kept"] == (of[k] == k) for k, row in found.items())
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_segments_of_other_keys_are_not_equal(monkeypatch):
    # Two segments whose content hashes collide and whose short runs differ.
    def collided(data, offsets, length, hasher):
        one = np.array([1, 1], np.int64)
        key = np.array([5 << 40, 9 << 40], np.uint64)
        return key, one.astype(np.uint64), one.astype(np.uint32), np.arange(2), one * 0, one

    monkeypatch.setattr(suffixes, "segments", collided)
    batch = pa.record_batch([pa.array([1, 2]), pa.array(["a" * 50, "b" * 50])], ["doc_id", "text"])
    (dealt,) = suffixes._dealt(50, 6)([batch])
    gone = [x for x in dealt.column("gone").to_pylist() if x]
    assert not any(np.frombuffer(x, np.int64).size for x in gone)


def test_segments_are_dealt_evenly():
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdefgh ", k=4_000)) for _ in range(50)]
    batch = pa.record_batch([pa.array(range(50)), pa.array(texts)], ["doc_id", "text"])
    (dealt,) = suffixes._dealt(50, 6)([batch])
    sizes = [len(windows) for windows in dealt.column("windows").to_pylist()]
    assert len(sizes) == 64 and max(sizes) < 2 * sum(sizes) / 64


def test_rows_of_an_id_with_other_texts(spark):
    rng = random.Random(4)
    a, b, c = ("".join(rng.choice("abcdefgh") for _ in range(120)) for _ in range(3))
    rows = [(1, a), (2, "A" + a + b), (2, "B" + c * 2), (2, "B" + c * 2), (3, b), (3, b), (None, a)]
    rows += [(4, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = sorted((r["doc_id"] or 0, r["text"]) for r in suffixes.cut_documents(docs).collect())
    # The other text of 2 is no document: it stays whole, and 4 keeps what only it has.
    expected = [(0, a), (1, a), (2, "A" + b), (2, "B" + c * 2), (2, "B" + c * 2), (3, ""), (3, "")]
    assert cut == [*expected, (4, c)]
    each = suffixes.each_without_repeats(docs).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["kept"]).decode()) for r in each) == cut
    # Repeated rows are each returned, with and without such an id elsewhere.
    some = suffixes.each_without_repeats(docs.where("doc_id in (1, 3)"))
    assert sorted(r["doc_id"] for r in some.collect()) == [1, 3, 3]


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(8)
    rows = [(0, [1.0, 2.0, 3.0]), (1, []), (2, [1.0, 2.0, 3.1])]
    for k in range(10, 30):
        rows.append((k, [float(x) for x in np.full(16, 1.0) + 0.01 * rng.standard_normal(16)]))
    for first in (rows, rows[1:] + rows[:1]):
        df = spark.createDataFrame(first, "vec_id long, embedding array<float>").coalesce(1)
        found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df).collect()}
        assert found == {0: (1, 0), 1: (0, 1), 2: (1, 0), **{k: (19, 10) for k in range(10, 30)}}


def test_recall_of_the_tables_in_use(spark):
    rng = np.random.default_rng(9)
    n, rows = 2000, []
    for k, cosine in enumerate(rng.uniform(0.9001, 0.905, n)):
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b)
        rows += [(2 * k, a.tolist()), (2 * k + 1, b.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    links = embeddings.near_duplicates(df).where("n_links > 0 and kept").count()
    print("recall", links / n)
    assert links >= 0.985 * n
