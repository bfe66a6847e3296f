"""Counting, packing and storing token ids, against the library on whole texts."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import counts, packing, planes, tokens

TEXTS = [
    (3, "The and attion to thanedble the, anea.\nEriner thanea. it's 'll don 't"),
    (1, None),
    (7, ""),
    (2, "a  b"),
    (9, " a\n b \n\n c \t"),
    (4, "x <|endoftext|> y<|endoftext|>"),
    (5, "é  b　c 12 34 .. !!   \r\n x.\ny z."),
    (6, "word " * 3000),
    (8, "same text"),
    (11, "same text"),
    (10, "NUL \0 in text"),
    (12, "tab\tand  two"),
]


@pytest.fixture(scope="module")
def encoded():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_path())
    return {
        doc: tokenizer.encode(text or "", add_special_tokens=False).ids for doc, text in TEXTS
    }


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(doc, text, "x", 1) for doc, text in TEXTS]
    # Extra columns with names that the operators use themselves.
    return spark.createDataFrame(rows, "doc_id long, text string, piece string, n long")


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_are_looked_up_once_and_encode_as_in_their_texts(monkeypatch):
    odd = [
        "", None, " ", "a", " a", "a  b", "a b ", "\n", "x\n\ny", "x\n y\t z", "a\0b", "a\u00a0b \u00a0c",
        "word$$$ <>|, it's 'quoted' a.$b don't!'s x'.", "\u00e9t\u00e9. \u00bd. 10$ \u00b2!", "  lead",
        "tab\there", "<s> </s> <unk> x", "x.,;\n%%% y", "_._ -. (a).", "ab'$s ab'. ab.'s ab&'ll a\nb$$",
    ]
    encoder = tokens.Encoder(tokens.default_path())
    encoder.known.clear()
    wanted = [encoder.tokenizer.encode(x or "", add_special_tokens=False).ids for x in odd]
    for texts, ids in [(odd, wanted), *(([x], [y]) for x, y in zip(odd, wanted))]:
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == ids
    # Runs that cannot be divided are encoded with something between their pieces.
    encoder.known.clear()
    encoder.blanks = np.zeros_like(encoder.blanks)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(odd)] == wanted

    lacking = []
    missing = tokens.Memory.__missing__
    monkeypatch.setattr(
        tokens.Memory, "__missing__", lambda self, piece: (lacking.append(piece), missing(self, piece))[1]
    )
    encoder = tokens.Encoder(tokens.default_path())
    encoder.known.clear()
    encoder.encode(["one two two two", "one two two", "one two"])
    assert sorted(lacking) == ["\0one", "two"]


def test_counts(docs, encoded):
    path = tokens.default_path()
    # Some pre-tokens by the broadcast table, the others by the join.
    for most in (200_000, 3, 0):
        found = {row["doc_id"]: row for row in counts.token_counts(docs, path, 5, most).collect()}
        assert {doc: row["n_tokens"] for doc, row in found.items()} == {
            doc: len(ids) for doc, ids in encoded.items()
        }
    assert {doc: row["n_bytes"] for doc, row in found.items()} == {
        doc: len((text or "").encode()) for doc, text in TEXTS
    }
    assert all(row["over_limit"] == (row["n_tokens"] > 5) for row in found.values())


def test_counts_of_repeated_rows_and_empty_tables(docs):
    path = tokens.default_path()
    twice = docs.where("doc_id = 8").union(docs.where("doc_id = 8"))
    assert [row["n_bytes"] for row in counts.token_counts(twice, path).collect()] == [18]
    assert counts.token_counts(docs.limit(0), path).count() == 0


def test_packing(docs, encoded):
    rows = packing.pack(docs, tokens.default_path(), 64, with_ids=True).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
        pieces[row["doc_id"]].append(row)
    for doc, ids in encoded.items():
        ids, at = [*ids, 2], 0
        own = sorted(pieces[doc], key=lambda row: row["piece"])
        assert [row["piece"] for row in own] == list(range(-(-len(ids) // 64)))
        for row in own:
            assert row["start"] == at
            at += row["length"]
            assert row["ids_crc32"] == crc(ids[row["start"] : at])
            assert row["ids"] == np.array(ids[row["start"] : at], "<u4").tobytes()
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    joined = packing.sequences(packing.pack(docs, tokens.default_path(), 64, with_ids=True))
    assert joined.agg(F.sum("n_tokens")).head()[0] == sum(len(i) + 1 for i in encoded.values())
    assert all(len(row["ids"]) == 4 * row["n_tokens"] for row in joined.collect())


def test_packing_of_repeated_rows_and_empty_tables(docs):
    path = tokens.default_path()
    some = docs.where("doc_id in (1, 8)")
    rows = packing.pack(some.union(some), path, 64).collect()
    assert Counter(row["doc_id"] for row in rows) == {1: 2, 8: 2}
    assert len({(row["sequence_id"], row["offset"]) for row in rows}) == 4
    assert packing.pack(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    random = np.random.default_rng(seed)
    capacity = 32
    sizes = Counter(random.integers(1, capacity + 1, 400).tolist())
    places = sorted(packing.plan(sizes, capacity))
    taken = defaultdict(set)
    for at, (size, rank, sequence, offset, together) in enumerate(places):
        following = places[at + 1 : at + 2]
        end = following[0][1] if following and following[0][0] == size else sizes[size]
        for k in range(end - rank):
            begin = offset + k % together * size
            own = set(range(begin, begin + size))
            assert not own & taken[sequence + k // together]
            assert begin + size <= capacity
            taken[sequence + k // together] |= own
    total = sum(size * n for size, n in sizes.items())
    assert sum(map(len, taken.values())) == total
    # Gapless from 0, and near the least number of sequences.
    assert all(max(used) + 1 == len(used) for used in taken.values())
    assert len(taken) <= -(-total // capacity) * 1.1 + 1


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    for n in (1, 7, 8, 1000):
        ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        assert (planes.from_planes(planes.to_planes(ids, bits), n) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_files_of_ids(spark, docs, encoded, bits):
    folder = planes.new_folder(spark)
    planes.write_ids(docs.repartition(3), tokens.default_path(), folder, block=16, bits=bits)
    found = {row["doc_id"]: row for row in planes.read_documents(spark, folder).collect()}
    at = 0
    for doc in sorted(encoded):
        ids = [*encoded[doc], 2]
        assert (found[doc]["start"], found[doc]["n_tokens"]) == (at, len(ids))
        assert found[doc]["ids_crc32"] == crc(ids)
        at += len(ids)
    index = spark.read.parquet(f"{folder}/index")
    assert index.agg(F.sum("n"), F.max("n")).head()[:] == (at, 16)


def test_files_of_an_empty_table(spark, docs):
    folder = planes.new_folder(spark)
    planes.write_ids(docs.limit(0), tokens.default_path(), folder)
    assert planes.read_documents(spark, folder).count() == 0
