"""Token counts of documents: each distinct pre-token is encoded once in the whole corpus.

1. Pre-tokens and how often they occur, counted per task and then summed.
2. The library encodes each distinct pre-token once; its number of tokens is stored.
3. Documents become pre-token frequencies. Pre-tokens of the most frequent kind, at most
   `most_frequent`, are met by a broadcast table of that size; the others by a join on the
   pre-token. Tokens are summed per document; ids are never kept.

A pre-token here is a piece of text that the library encodes alike alone and in its text
(see tokens.py).

Null text counts as empty. Rows with the same id, repeated rows among them, count together as one
document; a null id is a document id like any other. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.scratch import stored
from basketry.llm.tokens import Encoder, small_batches

FLUSHED = 400_000


def _occurrences(path: str):
    def run(batches):
        encoder, counted = Encoder(path), Counter()

        def taken():
            out = pa.record_batch(
                [pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())],
                names=["piece", "n"],
            )
            counted.clear()
            return out

        for batch in batches:
            for some in small_batches(batch):
                for text in some.column("text").to_pylist():
                    if text:
                        counted.update(encoder.pieces(text))
                if len(counted) > FLUSHED:
                    yield taken()
        if counted:
            yield taken()

    return run


def _lengths(path: str):
    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            pieces = batch.column("piece").to_pylist()
            tokens = encoder.lengths(pieces)
            yield pa.record_batch(
                [batch.column("piece"), batch.column("n"), pa.array(tokens, pa.int64())],
                names=["piece", "n", "tokens"],
            )

    return run


def _frequencies(path: str, frequent):
    """Per document one row with the tokens of its frequent pre-tokens, and one per other pre-token."""

    def run(batches):
        encoder, find = Encoder(path), frequent.value.get
        for batch in batches:
            for some in small_batches(batch):
                ids, pieces, counts, known = [], [], [], []
                for doc, text in zip(
                    some.column("doc_id").to_pylist(), some.column("text").to_pylist()
                ):
                    sure = 0
                    for piece, n in Counter(encoder.pieces(text or "")).items():
                        tokens = find(piece)
                        if tokens is None:
                            ids.append(doc)
                            pieces.append(piece)
                            counts.append(n)
                            known.append(0)
                        else:
                            sure += n * tokens
                    ids.append(doc)
                    pieces.append(None)
                    counts.append(len(text.encode()) if text else 0)
                    known.append(sure)
                yield pa.record_batch(
                    [
                        pa.array(ids, some.schema.field("doc_id").type),
                        pa.array(pieces, pa.string()),
                        pa.array(counts, pa.int64()),
                        pa.array(known, pa.int64()),
                    ],
                    names=["doc_id", "piece", "n", "known"],
                )

    return run


def pre_token_lengths(docs: DataFrame, path: str) -> DataFrame:
    """(piece, n, tokens): each distinct pre-token, its occurrences and its number of tokens."""
    found = (
        docs.select("text")
        .mapInArrow(_occurrences(path), "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
    )
    return stored(
        found.mapInArrow(_lengths(path), "piece string, n long, tokens long"), "pre-tokens"
    )


def frequent_from(lengths: DataFrame, most: int) -> int:
    """The smallest number of occurrences that at most `most` pre-tokens reach.

    Read from a histogram over eighths of powers of two, a few hundred rows at any size.
    """
    step = F.floor(F.log2(F.col("n")) * 8)
    histogram = lengths.groupBy(step.alias("step")).agg(
        F.count("*").alias("pieces"), F.min("n").alias("least")
    )
    reached, least = 0, 1 << 62
    for row in sorted(histogram.collect(), key=lambda r: -r["step"]):
        reached += row["pieces"]
        if reached > most:
            break
        least = row["least"]
    return least


def token_counts(
    docs: DataFrame, path: str, limit: int = 512, most_frequent: int = 200_000
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of documents (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    lengths = pre_token_lengths(docs, path)
    least = frequent_from(lengths, most_frequent)
    frequent = lengths.where(F.col("n") >= least).select("piece", "tokens").toArrow()
    shared = spark.sparkContext.broadcast(
        dict(zip(frequent.column(0).to_pylist(), frequent.column(1).to_pylist()))
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.mapInArrow(
        _frequencies(path, shared), f"doc_id {kind}, piece string, n long, known long"
    )
    # Rows without a pre-token meet nothing; their keys differ, so that no task gets them all.
    rows = rows.withColumn(
        "key", F.coalesce("piece", F.concat(F.lit("\0\0"), F.col("doc_id").cast("string")))
    )
    rest = lengths.where(F.col("n") < least).select(F.col("piece").alias("key"), "tokens")
    summed = rows.join(rest, "key", "left").select(
        "doc_id",
        F.when(F.col("piece").isNull(), F.col("n")).otherwise(0).alias("n_bytes"),
        F.when(F.col("piece").isNull(), F.col("known"))
        .otherwise(F.col("n") * F.col("tokens"))
        .alias("n_tokens"),
    )
    return (
        summed.groupBy("doc_id")
        .agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
