"""Quality rules whose thresholds follow the data of each language and source.

Each document is measured once. Documents that fail a base rule go. Of the others, four rates are
gathered in quantile sketches per language and source: counts by logarithmic bins, with a relative
error of 1 % and a few hundred bins at most. Sketches are merged by adding counts, so that nothing
depends on how rows are dealt out, and merged further, from sources to a language to all documents,
where a source or language has too few documents of its own. A document is kept if each of its rates
lies within the fences of its group: the quartiles, and beyond them REACH times their distance, or
TAIL_REACH times the distance from the quartile to where the group's own tail begins, whichever is
more. Where the tail begins is the rate's own: symbols and long words come in whole kinds of documents,
so a tenth of a group may be odd, repeats in single ones.

Words are runs of characters other than blank and U+0009 to U+000D. Null text has no words and fails,
as empty text does. Null languages and sources are groups of their own. Rows with the same id are
documents of their own, and repeated rows count as often. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.hashing import SPACE, Hasher, buffers, runs_of_texts, shingles, word_hashes, words
from basketry.llm.memory import trimmed
from basketry.llm.scratch import stored

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
# Bytes that begin a character other than a blank.
VISIBLE = ~SPACE & ((np.arange(256) & 0xC0) != 0x80)
BLANKS = " \t\v\f\r"
WINDOW = 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

REACH = 3.0
ENOUGH = 50
ERROR = 0.01
GROWTH = (1 + ERROR) / (1 - ERROR)
ZERO_BIN = -10_000  # rates under LEAST
LEAST = 1e-6
TAIL_REACH = 2.0
TINY = 0.01  # against groups without any spread
# Each rate, the hundredths of a group that are its tail, and whether low values are odd too.
RATES = {
    "symbols": ("n_symbols / n_words", 10, False),
    "dup_lines": ("n_dup_lines / n_lines", 2, False),
    "repeat_words": ("n_repeat_words / n_words", 2, False),
    "word_length": ("word_chars / n_words", 10, True),
}


def repeated_words(tokens: np.ndarray, n_words: int, window: int = WINDOW) -> int:
    """Words that lie in a window whose hash another window has too."""
    if len(tokens) < 2:
        return 0
    order = np.argsort(tokens)
    ordered = tokens[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    covered = np.zeros(n_words + 1, np.int64)
    np.add.at(covered, order[again], 1)
    np.add.at(covered, order[again] + window, -1)
    return int(np.count_nonzero(np.cumsum(covered)[:-1]))


def _measured(names: list[str]):
    def run(batches):
        hasher = Hasher()
        for batch in batches:
            column = batch.column("text")
            found = np.zeros((6, len(column)), np.int64)
            for begin, end in runs_of_texts(column):
                data, offsets = buffers(column.slice(begin, end - begin))
                starts, ends, upto = words(data, offsets)
                runs = shingles(word_hashes(hasher, data, starts, ends), WINDOW)
                some = slice(begin, end)
                found[0, some] = np.diff(upto)
                for row, table in ((1, VISIBLE), (2, SYMBOLS)):
                    upon = np.concatenate([[0], np.cumsum(table[data])])
                    found[row, some] = np.diff(upon[offsets])
                for at in np.flatnonzero(np.diff(upto) > WINDOW).tolist():
                    a, b = int(upto[at]), int(upto[at + 1])
                    found[4, begin + at] = repeated_words(runs[a : b - WINDOW + 1], b - a)
                for at, text in enumerate(column.slice(begin, end - begin).to_pylist()):
                    if text:
                        lines = [line for line in text.split("\n") if line.strip(BLANKS)]
                        found[3, begin + at] = len(lines) - len(set(lines))
                        found[5, begin + at] = len(lines)
            yield pa.record_batch(
                [batch.column(name) for name in names] + [pa.array(row) for row in found],
                names=[*names, *COUNTS, "n_lines"],
            )

    return trimmed(run)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, row) with the counts of each document and base_failed.

    row is the hash of the text.
    """
    names = ["doc_id", "lang", "source", "row"]
    docs = docs.select("doc_id", "lang", "source", "text").withColumn("row", F.xxhash64("text"))
    kinds = [f"{name} {docs.schema[name].dataType.simpleString()}" for name in names]
    schema = ", ".join([*kinds, *(f"{name} long" for name in [*COUNTS, "n_lines"])])
    found = docs.select(*names, "text").mapInArrow(_measured(names), schema)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def sketches(facts: DataFrame) -> DataFrame:
    """(lang, source, rate, bin, n): the quantile sketch of each rate in each group."""
    rates = F.array(
        *[
            F.struct(F.lit(name).alias("rate"), F.expr(rate).alias("x"))
            for name, (rate, _, _) in RATES.items()
        ]
    )
    step = F.ceil(F.log(F.col("r.x")) / F.lit(math.log(GROWTH))).cast("int")
    return (
        facts.where(~F.col("base_failed"))
        .select("lang", "source", F.explode(rates).alias("r"))
        .select(
            "lang",
            "source",
            F.col("r.rate").alias("rate"),
            F.when(F.col("r.x") < LEAST, ZERO_BIN).otherwise(step).alias("bin"),
        )
        .groupBy("lang", "source", "rate", "bin")
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups, by adding counts."""
    return sketch.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, documents, <rate>_low, <rate>_high) of each group of a sketch table."""
    group = Window.partitionBy(*keys, "rate")
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    value = F.when(F.col("bin") == ZERO_BIN, 0.0).otherwise(
        F.pow(F.lit(GROWTH), F.col("bin")) * (2 / (GROWTH + 1))
    )
    placed = sketch.select(
        *keys, "rate", value.alias("x"), F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("all")
    )
    tail = F.lit(0)
    for name, (_, hundredths, _) in RATES.items():
        tail = F.when(F.col("rate") == name, hundredths).otherwise(tail)

    def quantile(hundredths):
        return F.min(F.when(100 * F.col("upto") >= hundredths * F.col("all"), F.col("x")))

    quartiles = placed.withColumn("tail", tail).groupBy(*keys, "rate").agg(
        F.max("all").alias("all"),
        quantile(F.lit(25)).alias("q1"),
        quantile(F.lit(75)).alias("q3"),
        quantile(F.col("tail")).alias("low_tail"),
        quantile(100 - F.col("tail")).alias("high_tail"),
    )
    ends = []
    for name, (_, _, both) in RATES.items():
        least = F.greatest(REACH * (F.col("q3") - F.col("q1")), F.lit(TINY))
        above = F.greatest(least, TAIL_REACH * (F.col("high_tail") - F.col("q3")))
        below = F.greatest(least, TAIL_REACH * (F.col("q1") - F.col("low_tail")))
        this = F.col("rate") == name
        low = F.col("q1") - below if both else F.lit(float("-inf"))
        # A sketch knows values but for its error.
        ends += [
            F.max(F.when(this, low * (1 - ERROR))).alias(f"{name}_low"),
            F.max(F.when(this, (F.col("q3") + above) * (1 + ERROR))).alias(f"{name}_high"),
        ]
    return quartiles.groupBy(*keys).agg(F.max("all").alias("documents"), *ends)


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, row) of the documents, their counts (see COUNTS), base_failed, and whether kept."""
    facts = stored(measured(docs), "facts")
    sketch = stored(sketches(facts), "sketches")
    ends = [f"{name}_{end}" for name in RATES for end in ("low", "high")]
    out = facts
    by_group = fences(sketch, ["lang", "source"])
    by_lang = fences(merged(sketch, ["lang"]), ["lang"])
    overall = fences(merged(sketch, []), [])
    for keys, found, prefix in (
        (["lang", "source"], by_group, "group"),
        (["lang"], by_lang, "lang"),
        ([], overall, "all"),
    ):
        enough = found if not keys else found.where(F.col("documents") >= ENOUGH)
        named = enough.select(
            *[F.col(key).alias(f"{prefix}_{key}") for key in keys],
            F.struct(*ends).alias(f"{prefix}_ends"),
        )
        same = F.lit(True)
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.col(f"{prefix}_{key}"))
        # The last has one row.
        out = out.join(named, same, "left") if keys else out.join(F.broadcast(named), how="left")
    limits = F.coalesce("group_ends", "lang_ends", "all_ends")
    within = F.lit(True)
    for name, (rate, _, _) in RATES.items():
        # Of documents that fail a base rule the rates may not exist.
        value = F.when(~F.col("base_failed"), F.expr(rate))
        within = within & (value >= limits[f"{name}_low"]) & (value <= limits[f"{name}_high"])
    kept = ~F.col("base_failed") & F.coalesce(within, F.lit(False))
    return out.select("doc_id", "row", *COUNTS, "base_failed", kept.alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of the documents that are kept."""
    kept = judged(docs).where("kept").select(F.col("doc_id").alias("kept_id"), "row")
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("row"))
    return docs.join(kept, same, "left_semi")
