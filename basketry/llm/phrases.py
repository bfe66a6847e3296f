"""Collocations: phrases whose words stand together more often than chance has it, by language.

Texts are cut into pieces at sentence marks and line ends, pieces into words. Phrases are counted by
length, one pass over the texts for each:

1. Words are counted by themselves.
2. A longer phrase is looked at only where its first and its last words without the other end are
   frequent, too, since no phrase is more frequent than its parts. What is frequent of the length before
   is met by a bitmap over hashes, of a fixed size. All such phrases are first counted in cells, two tables
   of 2**CELLS of them, and only those are looked at further whose cells have both reached the frequency
   asked for. With one table the phrases that pass by chance, since they share the cell of a frequent one,
   grow with the square of the text; with two they have to meet frequent ones twice. A phrase that passes by
   chance is counted and then dropped, none is lost: the fewer cells there are for the text, the more is
   counted, and the result is the same. Then each task keeps stripes: for each prefix, a counter of the
   words that follow it.
3. Stripes meet by their prefix and are merged elementwise. Prefixes with a 1/HOT of all words or more,
   of which there are at most HOT, have their stripes cut into PARTS by the word that follows, so that no
   task gets all of them.
4. From the merged stripes come the frequency of each extension, the frequency of what it is cut into
   (extensions of shorter prefixes), and the largest frequency among the extensions by one word to
   either side. A phrase inside a longer one is also inside one that is longer by one word, which is at
   least as frequent, so that these maxima decide whether a phrase is subsumed.

Words and phrases are told apart by 64-bit hashes while they are counted: a phrase by the hash of its
prefix and that of its last word. With 100 million frequent phrases the odds that any two prefixes fall
together are 1 to 3,000.

Null text counts as empty, null lang as `und`. Ids are not read: repeated rows and rows with the same id
count as often as they stand there. An empty table gives an empty result. Other columns are ignored.
Long texts are read in segments that overlap by the words that a phrase may reach over, a word at least.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.hashing import FIRST, Hasher, buffers, mixed, runs_of_texts
from basketry.llm.scratch import stored

LEAST = 100
LONGEST = 5
TOP = 2000
PERCENT = 100
GATHERED = 2_000_000
SEGMENT = 2_000_000
ROWS = 100_000
BITS = 27
CELLS = 24
CELL_BLOCK = 16
HOT = 1024
PARTS = 64

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A") : ord("Z") + 1] += 32
BLANK, BREAK = 1, 2
KIND = np.zeros(256, np.uint8)
KIND[np.frombuffer(b" \t", np.uint8)] = BLANK
KIND[np.frombuffer(b".,;:!?\n\v\f\r", np.uint8)] = BREAK


def pieces_of(data: np.ndarray, offsets: np.ndarray):
    """Start, end, text and piece of each word of some texts; pieces are numbered in order."""
    kind = KIND[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    text = np.searchsorted(offsets, starts, side="right") - 1
    breaks = np.cumsum(kind == BREAK, dtype=np.int64)
    return starts, np.flatnonzero(last) + 1, text, breaks[starts] + text


def segments(column: pa.Array, overlap: int):
    """(lower-cased bytes, offsets, first text) of texts one after another, long ones in segments.

    A segment of a long text begins with the last `overlap` words of the one before, so that each run of
    overlap + 1 words is in exactly one.
    """
    for begin, end in runs_of_texts(column):
        data, offsets = buffers(column.slice(begin, end - begin))
        data = LOWERED[data]
        if len(data) <= SEGMENT:
            yield data, offsets, begin
            continue
        for at in range(end - begin):
            text = data[offsets[at] : offsets[at + 1]]
            for a, b in borders(text, overlap, SEGMENT):
                yield text[a:b], np.array([0, b - a]), begin + at


def borders(text: np.ndarray, overlap: int, most: int):
    """Where the segments of a text begin and end; no word is cut."""
    a, size = 0, most
    while a + size < len(text):
        outside = np.flatnonzero(KIND[text[a : a + size]] != 0)
        b = a + int(outside[-1]) if len(outside) else a
        starts = pieces_of(text[a:b], np.array([0, b - a]))[0]
        if len(starts) <= overlap:
            size *= 2
            continue
        yield a, b
        a, size = (a + int(starts[-overlap]) if overlap else b), most
    yield a, len(text)


def language_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a prefix with one word more."""
    return mixed(prefix * FIRST + word)


class Keys:
    """Keys of the words of a batch; words of other languages have other keys."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        coded = batch.column("lang").dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        self.code = coded.indices.to_numpy(zero_copy_only=False)
        self.of_lang = np.array([language_key(lang) for lang in self.langs], np.uint64)

    def words(self, hasher: Hasher, data, starts, ends, texts):
        """(key, language) of each word."""
        code = self.code[texts]
        return mixed(hasher.of(hasher.sums(data), starts, ends) ^ self.of_lang[code]), code


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Stretches of a byte buffer as an Arrow column."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])
    ).cast(pa.string())


class Languages:
    """Numbers for the languages that a task has met."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.number: dict[str, int] = {}

    def numbers(self, names: list[str]) -> np.ndarray:
        for name in names:
            if name not in self.number:
                self.number[name] = len(self.names)
                self.names.append(name)
        return np.array([self.number[name] for name in names], np.int32)

    def column(self, numbers: np.ndarray) -> pa.Array:
        return pa.array(self.names, pa.string()).take(pa.array(numbers))


def _words(batches):
    """(lang, key, word, n) of the words of a task, and for each language all its words with no word."""
    hasher, languages, totals = Hasher(), Languages(), {}
    held: list[tuple] = []
    texts_held: list[np.ndarray] = []
    gathered = size = 0

    def batch_of(langs, key, word, n):
        return pa.record_batch([langs, key, word, n], names=["lang", "key", "word", "n"])

    def taken():
        key, lang, starts, ends = (np.concatenate(c) for c in zip(*held))
        data = np.concatenate(texts_held)
        held.clear()
        texts_held.clear()
        key, at, n = np.unique(key, return_index=True, return_counts=True)
        for a in range(0, len(key), ROWS):
            some = at[a : a + ROWS]
            yield batch_of(
                languages.column(lang[some]),
                pa.array(key[a : a + ROWS].view(np.int64)),
                strings(data, starts[some], ends[some]),
                pa.array(n[a : a + ROWS].astype(np.int64)),
            )

    for batch in batches:
        keys = Keys(batch)
        number = languages.numbers(keys.langs)
        for data, offsets, begin in segments(batch.column("text"), 0):
            starts, ends, texts, _ = pieces_of(data, offsets)
            if not len(starts):
                continue
            key, code = keys.words(hasher, data, starts, ends, texts + begin)
            for k, n in enumerate(np.bincount(code).tolist()):
                totals[keys.langs[k]] = totals.get(keys.langs[k], 0) + n
            held.append((key, number[code], starts + size, ends + size))
            texts_held.append(data)
            size += len(data)
            gathered += len(key)
            if gathered > GATHERED:
                yield from taken()
                gathered = size = 0
    if held:
        yield from taken()
    names = [name for name, n in totals.items() if n]
    yield batch_of(
        pa.array(names, pa.string()),
        pa.nulls(len(names), pa.int64()),
        pa.nulls(len(names), pa.string()),
        pa.array([totals[name] for name in names], pa.int64()),
    )


def stripes_of(prefix: np.ndarray, word: np.ndarray, hot: np.ndarray):
    """Stripes of some phrases: (entry order, first entry of each stripe, counts of entries, part)."""
    order = np.argsort(longer(prefix, word))
    prefix, word = prefix[order], word[order]
    new = np.ones(len(prefix), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (word[1:] != word[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(prefix)))
    prefix, word, order = prefix[at], word[at], order[at]
    split = np.isin(prefix, hot) if len(hot) else np.zeros(len(prefix), bool)
    part = np.where(split, (word >> np.uint64(58)).astype(np.int32) % PARTS, 0)
    by_stripe = np.lexsort((part, prefix))
    prefix, part = prefix[by_stripe], part[by_stripe]
    edge = np.ones(len(prefix), bool)
    edge[1:] = (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])
    return order[by_stripe], np.flatnonzero(edge), counts[by_stripe], part


STRIPE = "lang string, prefix long, part int, words array<bigint>, counts array<bigint>"


def marked(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether the bit at the first bits of each key is set."""
    spot = keys >> np.uint64(64 - bits)
    return (bitmap[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def occurrences(batch: pa.RecordBatch, keys: Keys, hasher: Hasher, size: int, bitmap, bits: int):
    """(prefix, last word, language) of each phrase of `size` words whose parts may be frequent."""
    for data, offsets, begin in segments(batch.column("text"), size - 1):
        starts, ends, texts, piece = pieces_of(data, offsets)
        n = len(starts) - size + 1
        if n <= 0:
            continue
        word, code = keys.words(hasher, data, starts, ends, texts + begin)
        prefix = word
        for k in range(1, size - 1):
            prefix = longer(prefix[:-1], word[k:])
        seen = marked(bitmap, prefix, bits)
        at = np.flatnonzero(seen[:n] & seen[1 : n + 1] & (piece[:n] == piece[size - 1 :]))
        yield prefix[at], word[at + size - 1], code[at]


def cells_of(keys: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each phrase in the first table, then that of each in the second."""
    first = keys >> np.uint64(64 - cells)
    second = (keys >> np.uint64(64 - 2 * cells)) & np.uint64((1 << cells) - 1)
    return np.concatenate([first, second + np.uint64(1 << cells)])


def in_reached_cells(reached: np.ndarray, keys: np.ndarray, cells: int) -> np.ndarray:
    """Whether both cells of each phrase are among those that were reached."""
    spot = cells_of(keys, cells)
    seen = (reached[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return seen[: len(keys)] & seen[len(keys) :]


def _kind_of_cell(least: int):
    """The smallest type that holds `least`, at which counts stop."""
    return next(t for t in (np.uint8, np.uint16, np.uint32) if least <= np.iinfo(t).max)


def _cells(size: int, frequent, bits: int, least: int, cells: int):
    """Occurrences of a task's phrases by cell, in compressed blocks of 2**CELL_BLOCK cells.

    A phrase has a cell in each of two tables.
    """

    def run(batches):
        hasher, bitmap = Hasher(), frequent.value
        counted = np.zeros(2 << cells, _kind_of_cell(least))
        held: list[np.ndarray] = []

        def taken():
            cell, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            counted[cell] = np.minimum(counted[cell].astype(np.int64) + n, least)

        gathered = 0
        for batch in batches:
            for prefix, word, _ in occurrences(batch, Keys(batch), hasher, size, bitmap, bits):
                held.append(cells_of(longer(prefix, word), cells).astype(np.uint32))
                gathered += len(word)
                if gathered > GATHERED:
                    taken()
                    gathered = 0
        if held:
            taken()
        pack = zstandard.ZstdCompressor(level=1).compress
        width = 1 << min(CELL_BLOCK, cells)
        rows = [
            (at // width, pack(counted[at : at + width].tobytes()))
            for at in range(0, len(counted), width)
            if counted[at : at + width].any()
        ]
        columns = list(zip(*rows)) if rows else [[], []]
        yield pa.record_batch(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())],
            names=["block", "cells"],
        )

    return run


def _reached(least: int, cells: int):
    """For each block of cells, a bit for each that reached `least` in all tasks together."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        now, total = None, None

        def taken():
            bits = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.record_batch(
                [pa.array([now], pa.int32()), pa.array([bits], pa.binary())], names=["block", "bits"]
            )

        for batch in batches:
            for block, packed in zip(*(batch.column(c).to_pylist() for c in ("block", "cells"))):
                if block != now:
                    if now is not None:
                        yield taken()
                    now, total = block, np.zeros(1 << min(CELL_BLOCK, cells), np.int64)
                some = np.frombuffer(unpack(packed), _kind_of_cell(least))
                np.minimum(total + some, least, out=total)
        if now is not None:
            yield taken()

    return run


def reached_cells(docs: DataFrame, size: int, frequent, bits: int, least: int, cells: int) -> np.ndarray:
    """2**cells bits for each table, one for each cell that phrases of `size` words fill to `least`."""
    rows = (
        docs.mapInArrow(_cells(size, frequent, bits, least, cells), "block int, cells binary")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_reached(least, cells), "block int, bits binary")
        .toArrow()
    )
    width = max(1, (1 << min(CELL_BLOCK, cells)) // 8)
    out = np.zeros(max(2, (2 << cells) // 8), np.uint8)
    for block, some in zip(rows.column("block").to_pylist(), rows.column("bits").to_pylist()):
        out[width * block : width * (block + 1)] = np.frombuffer(some, np.uint8)
    return out


def _stripes(size: int, frequent, bits: int, reached, cells: int, hot):
    """The stripes of the phrases of `size` words in a task."""

    def run(batches):
        hasher, bitmap, hottest = Hasher(), frequent.value, hot.value
        cell_bits = reached.value
        languages = Languages()
        held: list[tuple] = []

        def taken():
            prefix, word, lang = (np.concatenate(c) for c in zip(*held))
            held.clear()
            entry, first, counts, part = stripes_of(prefix, word, hottest)
            lists = np.append(first, len(entry))
            for a in range(0, len(first), ROWS):
                some = slice(a, a + ROWS)
                at = entry[first[some]]
                edges = lists[a : a + ROWS + 1]
                inside = slice(edges[0], edges[-1])
                offsets = pa.array((edges - edges[0]).astype(np.int32))
                yield pa.record_batch(
                    [
                        languages.column(lang[at]),
                        pa.array(prefix[at].view(np.int64)),
                        pa.array(part[first[some]].astype(np.int32)),
                        pa.ListArray.from_arrays(offsets, pa.array(word[entry[inside]].view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(counts[inside].astype(np.int64))),
                    ],
                    names=["lang", "prefix", "part", "words", "counts"],
                )

        gathered = 0
        for batch in batches:
            keys = Keys(batch)
            number = languages.numbers(keys.langs)
            for prefix, word, code in occurrences(batch, keys, hasher, size, bitmap, bits):
                at = np.flatnonzero(in_reached_cells(cell_bits, longer(prefix, word), cells))
                held.append((prefix[at], word[at], number[code[at]]))
                gathered += len(at)
                if gathered > GATHERED:
                    yield from taken()
                    gathered = 0
        if held:
            yield from taken()

    return run


def _merged(least: int):
    """Stripes in order of their prefix, merged elementwise: (lang, prefix, word, key, n)."""

    def run(batches):
        # Entries of the stripe that the next rows may go on with.
        held, lang_held = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64)), None

        def counted(prefix, word, n):
            order = np.lexsort((word, prefix))
            prefix, word, n = prefix[order], word[order], n[order]
            new = np.ones(len(prefix), bool)
            new[1:] = (prefix[1:] != prefix[:-1]) | (word[1:] != word[:-1])
            at = np.flatnonzero(new)
            return prefix[at], word[at], np.add.reduceat(n, at) if len(at) else n, order[at]

        def taken(prefix, word, n, langs):
            found = n >= least
            prefix, word, n = prefix[found], word[found], n[found]
            return pa.record_batch(
                [
                    pa.array([lang for lang, yes in zip(langs, found.tolist()) if yes], pa.string()),
                    pa.array(prefix.view(np.int64)),
                    pa.array(word.view(np.int64)),
                    pa.array(longer(prefix, word).view(np.int64)),
                    pa.array(n),
                ],
                names=["lang", "prefix", "word", "key", "n"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            words, counts = batch.column("words"), batch.column("counts")
            sizes = words.value_lengths().to_numpy()
            prefix = batch.column("prefix").to_numpy().view(np.uint64)
            langs = batch.column("lang")
            row = np.repeat(np.arange(len(sizes)), sizes)
            before = len(held[0])
            prefix, word, n, order = counted(
                np.concatenate([held[0], prefix[row]]),
                np.concatenate([held[1], words.flatten().to_numpy().view(np.uint64)]),
                np.concatenate([held[2], counts.flatten().to_numpy()]),
            )
            # The last stripe stays: the rows are in order of signed numbers.
            last = batch.column("prefix").to_numpy().view(np.uint64)[-1]
            stays = prefix == last
            own = np.full(len(order), -1)
            own[order >= before] = row[order[order >= before] - before]
            done = ~stays & (n >= least)
            named = langs.take(pa.array(np.maximum(own[done], 0))).to_pylist()
            named = [lang_held if k < 0 else lang for k, lang in zip(own[done].tolist(), named)]
            if len(named):
                yield taken(prefix[done], word[done], n[done], named)
            held = (prefix[stays], word[stays], n[stays])
            lang_held = langs[len(langs) - 1].as_py()
        if len(held[0]):
            yield taken(*held, [lang_held] * len(held[0]))

    return run


def bitmap_of(keys: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits, those at the first bits of a key set; as many bytes at any size of the table."""
    spot = F.shiftrightunsigned("key", 64 - bits) + 1
    rows = (
        keys.groupBy(F.bitmap_bucket_number(spot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits"))
        .toArrow()
    )
    out = np.zeros(max(1 << (bits - 3), 4096), np.uint8)
    for bucket, some in zip(rows.column("bucket").to_pylist(), rows.column("bits")):
        out[4096 * (bucket - 1) : 4096 * bucket] = np.frombuffer(some.as_buffer(), np.uint8)
    return out


def frequent_phrases(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    bits: int = BITS,
    cells: int = CELLS,
) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, n) of all phrases up to `longest` words that occur `least` times,
    and (lang, n) of all words.
    """
    docs = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    context = docs.sparkSession.sparkContext
    cells = max(cells, 3)  # a table ends with a whole byte of bits
    counted = stored(
        docs.mapInArrow(_words, "lang string, key long, word string, n long")
        .groupBy("lang", "key", "word")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") >= least) | F.col("word").isNull()),
        "words",
    )
    totals = counted.where("word is null").select("lang", "n")
    single = counted.where("word is not null")
    everything = totals.agg(F.sum("n")).head()[0] or 0
    words = single.select(F.col("key").alias("word_key"), F.col("word").alias("last"))
    level = single.select("lang", "key", F.col("word").alias("phrase"), "n")
    found = level.select("lang", F.lit(1).alias("words"), "phrase", "n")
    for size in range(2, longest + 1):
        hot = level.where(F.col("n") * HOT >= everything).select("key").collect()
        hot_keys = np.sort(np.array([row["key"] for row in hot], np.int64).view(np.uint64))
        frequent = context.broadcast(bitmap_of(level, bits))
        reached = context.broadcast(reached_cells(docs, size, frequent, bits, least, cells))
        merged = stored(
            docs.mapInArrow(
                _stripes(size, frequent, bits, reached, cells, context.broadcast(hot_keys)), STRIPE
            )
            .repartition("prefix", "part")
            .sortWithinPartitions("prefix", "part")
            .mapInArrow(_merged(least), "lang string, prefix long, word long, key long, n long"),
            f"phrases-{size}",
        )
        prefixes = level.select(F.col("key").alias("prefix_key"), F.col("phrase").alias("first"))
        named = merged.join(prefixes, F.col("prefix") == F.col("prefix_key")).join(
            words, F.col("word") == F.col("word_key")
        )
        level = stored(
            named.select("lang", "key", F.concat_ws(" ", "first", "last").alias("phrase"), "n"),
            f"named-{size}",
        )
        found = found.unionByName(level.select("lang", F.lit(size).alias("words"), "phrase", "n"))
        if level.isEmpty():
            break
    return found, totals


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    percent: int = PERCENT,
    bits: int = BITS,
    cells: int = CELLS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of documents
    (text, lang).

    a, l and r are the frequencies of the phrase and of the two parts of its lowest-scoring cut, n that
    of all words. A phrase goes where a longer one has `percent` hundredths of its frequency.
    """
    found, totals = frequent_phrases(docs, least, longest, bits, cells)
    candidates = found.where("words > 1").select(
        "lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("list")
    )
    inner = candidates.where("words > 2").select(
        F.col("lang").alias("in_lang"),
        F.explode(
            F.array(
                _part(F.col("list"), 1, F.col("words") - 1),
                _part(F.col("list"), 2, F.col("words") - 1),
            )
        ).alias("in_phrase"),
        "a",
    )
    longest_of = inner.groupBy("in_lang", "in_phrase").agg(F.max("a").alias("within"))
    kept = candidates.join(
        longest_of,
        (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("in_phrase")),
        "left",
    ).where(F.coalesce(100 * F.col("within") < percent * F.col("a"), F.lit(True)))

    cuts = kept.select(
        "lang",
        "phrase",
        "a",
        "words",
        "list",
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    ).select(
        "lang",
        "phrase",
        "a",
        "k",
        _part(F.col("list"), F.lit(1), F.col("k")).alias("left"),
        _part(F.col("list"), F.col("k") + 1, F.col("words")).alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        part = found.select(
            F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("n").alias(name)
        )
        same = (F.col("lang") == F.col("part_lang")) & (F.col(side) == F.col("part"))
        cuts = cuts.join(part, same).drop("part_lang", "part", side)
    # One language may have most phrases, so that it is met in parts.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
    spread = totals.select("lang", "n", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    cuts = cuts.select("*", part).join(spread, ["lang", "part"]).drop("part")

    def exact(column: str) -> Column:
        return F.col(column).cast("decimal(18,0)")

    above = (exact("a") * exact("n")).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)")
    score = F.call_function(
        "div", above.cast("decimal(38,0)"), (exact("l") * exact("r")).cast("decimal(38,0)")
    )
    lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct(score.alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("cut")
    )
    scored = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # The best of each part of a language first: no task gets all of one.
    some = Window.partitionBy("lang", "part").orderBy(*order)
    best = scored.select("*", part).withColumn("place", F.row_number().over(some))
    best = best.where(F.col("place") <= top).drop("part", "place")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
