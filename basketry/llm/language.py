"""Language of texts by n-gram filters that answer for all languages at once.

Training takes documents with a known language that are not held out, at most `most` of each language
(all languages alike, by a hash of the id), and counts the n-grams of their letters. A language has an
n-gram if it is seen there at least twice and at least SHARE times as often as in the language that
has it most. The filter is a Bloom filter of SLOTS words, sliced by bits: bit k of a word belongs to
language k. An n-gram sets its language's bit at HASHES slots; the conjunction of the words at these
slots is the mask of all languages that have it.

Of a text, the n-grams of each language are counted. What the filter lets through by chance is known
from how full each slice is, and is taken off the count. The language with the largest share wins, the
first in alphabetical order of equal ones; the score is its part of all shares.

Texts are read in lower case; everything but letters separates, one n-gram has no two separators.
Null text and text without a letter are `und` with score 0, as is everything if no language was
learned. Null languages, empty table: nothing is learned, no rows. Rows with a null id are never held
out and are not learned from. Rows with the same id are predicted each. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.hashing import BASE, mixed
from basketry.llm.scratch import stored

SLOTS = 1 << 20
HASHES = 3
GRAM = 4
SHARE = 0.05
MOST = 3_000
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
# ASCII letters in lower case, bytes of other characters as they are, all else a separator.
LETTERS = np.full(256, 32, np.uint8)
LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
LETTERS[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
LETTERS[128:] = np.arange(128, 256)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(match[0].isalpha() for match in LETTER.finditer(text))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, text of each): GRAM bytes as one number."""
    data = [f" {text.lower()} ".encode() for text in texts]
    sizes = np.array([len(d) for d in data])
    bytes_ = LETTERS[np.frombuffer(b"".join(data), np.uint8)]
    n = len(bytes_) - GRAM + 1
    gram = np.zeros(max(n, 0), np.uint32)
    blanks = np.zeros(max(n, 0), np.uint8)
    for k in range(GRAM):
        gram |= bytes_[k : k + n].astype(np.uint32) << np.uint32(8 * k)
        blanks += bytes_[k : k + n] == 32
    owner = np.repeat(np.arange(len(texts)), sizes)[: max(n, 0)]
    # Two separators at most: at both ends of a word.
    good = blanks < 2
    if GRAM > 2:
        outer = (bytes_[:n] == 32) & (bytes_[GRAM - 1 : GRAM - 1 + n] == 32)
        good |= (blanks == 2) & outer
    return gram[good], owner[good]


def slots(gram: np.ndarray) -> list[np.ndarray]:
    """The places of each n-gram in the filter."""
    hashed = mixed(gram.astype(np.uint64) * BASE)
    return [
        ((hashed >> np.uint64(20 * k)) & np.uint64(SLOTS - 1)).astype(np.int64)
        for k in range(HASHES)
    ]


def _counted(batches):
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").to_pylist()
        for lang in sorted(set(langs)):
            own = [text for text, is_in in zip(texts, langs) if is_in == lang and text]
            for at in range(0, len(own), 500):
                found, n = np.unique(grams(own[at : at + 500])[0], return_counts=True)
                yield pa.record_batch(
                    [
                        pa.array([lang] * len(found), pa.string()),
                        pa.array(found.astype(np.int64)),
                        pa.array(n, pa.int64()),
                    ],
                    names=["lang", "gram", "n"],
                )


def held_out():
    """Documents that are predicted only: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame, most: int = MOST) -> tuple[list[str], np.ndarray]:
    """The languages and the filter, from at most about `most` documents of each language."""
    known = docs.where("lang is not null and text is not null and doc_id is not null").where(
        ~held_out()
    )
    sizes = known.groupBy("lang").count()
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000))
    sample = (
        known.join(F.broadcast(sizes), "lang")
        .where(drawn * F.col("count") < most * 1_000_000)
        .select("lang", "text")
    )
    counted = sample.mapInArrow(_counted, "lang string, gram long, n long")
    counted = stored(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    total = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counted.join(F.broadcast(total), "lang").withColumn("share", F.col("n") / F.col("total"))
    # The sample is bounded, and so are the n-grams that come to the driver.
    largest = shares.groupBy("gram").agg(F.max("share").alias("largest"))
    has = (
        shares.join(largest, "gram")
        .where((F.col("n") > 1) & (F.col("share") >= SHARE * F.col("largest")))
        .select("lang", "gram")
        .toArrow()
    )
    langs = sorted(set(has.column("lang").to_pylist()))
    if len(langs) > 64:
        raise ValueError("a word of the filter has 64 bits, one for each language")
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if len(langs) <= 8 * k().nbytes)
    table = np.zeros(SLOTS, kind)
    of = np.array(has.column("lang").to_pylist())
    gram = has.column("gram").to_numpy().astype(np.uint32)
    for k, lang in enumerate(langs):
        for place in slots(gram[of == lang]):
            table[place] |= kind(1 << k)
    return langs, table


def shares_of(gram: np.ndarray, owner: np.ndarray, n: int, table: np.ndarray, langs: int) -> np.ndarray:
    """(text, language): the share of a text's n-grams that the language has."""
    places = slots(gram)
    mask = table[places[0]]
    for place in places[1:]:
        mask &= table[place]
    counts = np.maximum(np.bincount(owner, minlength=n), 1)
    out = np.zeros((n, langs))
    for k in range(langs):
        bit = table.dtype.type(1 << k)
        hits = np.bincount(owner, (mask & bit) != 0, minlength=n) / counts
        chance = np.count_nonzero(table & bit) / SLOTS
        chance **= HASHES
        out[:, k] = np.maximum((hits - chance) / (1 - chance), 0)
    return out


def _predicted(model):
    def run(batches):
        langs, table = model.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            lettered = [at for at, text in enumerate(texts) if langs and has_letter(text)]
            at = 0
            while at < len(lettered):
                end, size = at, 0
                while end < len(lettered) and size < 2_000_000:
                    size += len(texts[lettered[end]])
                    end += 1
                some = lettered[at:end]
                gram, owner = grams([texts[k] for k in some])
                share = shares_of(gram, owner, len(some), table, len(langs))
                best = share.argmax(axis=1)
                for k, row, lang in zip(some, share, best.tolist()):
                    names[k] = langs[lang]
                    scores[k] = row[lang] / max(row.sum(), 1e-300)
                at = end
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(names, pa.string()),
                    pa.array(np.clip(scores, 0, 1)),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def predicted(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of documents (doc_id, text, lang)."""
    docs = docs.select("doc_id", "text", "lang")
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(learned(docs, most))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(
        _predicted(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
