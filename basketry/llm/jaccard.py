"""Documents with nearly the same word shingles, by prefixes of token combinations.

The tokens of a document are its distinct word shingles. Tokens that many documents have are
frequent: a table of them, of bounded size, comes from exact counts over all documents. All other
tokens are rare. Tokens are ordered, rare ones before frequent ones and by hash within.

Of two documents that link, at most every fifth token of either is not in the other. So a prefix from
which any fifth of the document can be taken away without taking all its keys shares a key with the
prefix of each document it links with. Keys are single rare tokens, and pairs of frequent tokens of
the same class; the prefix is extended until the rare tokens and, in each class, all frequent tokens
but one come to more than a fifth. Frequent tokens have the more classes the larger the documents, by
powers of two; documents near a power have keys for either side.

Documents with a key in common are candidates. In each of a few rounds a document is compared with one
other, which is the first one in most of its lists and not known to hang together with it. Then, where
a list still has documents of several components, they are compared across these: all of them if they
are few for the list, else some drawn for each component, again and again with what hangs together by
then, until all have been compared. Only where hardly any of those drawn link are all of a list
compared at once. So a list of thousands of copies, near ones too, costs thousands of comparisons.
Before whole sets are compared, a pair must pass two bounds that no link fails: the sizes, and the
bits in which parities of their tokens differ (each such bit is a token that only one of them has).

Null text and text without a word have no tokens and link with nothing; texts with fewer words than
a shingle are one token. Rows with a null id link with nothing. Rows with the same id are one
document, whose rows link for it, and whose n_shingles is that of its largest row. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import dealing
from basketry.llm.components import components
from basketry.llm.hashing import (
    LOWERED,
    Hasher,
    buffers,
    mixed,
    runs_of_texts,
    shingles,
    word_hashes,
    words,
)
from basketry.llm.memory import trimmed
from basketry.llm.scratch import stored

SIZE = 5
CLASS = np.uint64(0xD6E8FEB86659FD93)
PAIR = np.uint64(0xA0761D6478BD642F)
ROUNDS = 2
BLOCK = 1000
FEW = 8  # pairs for each row of a list that are all compared
DRAWN = 4  # of more, for each component
LINKING = 10  # one of so many pairs drawn has to link, or all are compared
SKETCH = 256  # bytes at most
SHORT = 64
LEAST_FREQUENT = 32
MOST_FREQUENT = 1 << 20


def token_sets(column: pa.Array, size: int, hasher: Hasher):
    """(position, tokens) of each text: its distinct shingles as hashes, ascending."""
    for begin, end in runs_of_texts(column):
        data, offsets = buffers(column.slice(begin, end - begin))
        starts, ends, upto = words(data, offsets)
        hashed = word_hashes(hasher, data, starts, ends)
        all_runs = shingles(hashed, size)
        for at in range(end - begin):
            a, b = int(upto[at]), int(upto[at + 1])
            if b - a >= size:
                tokens = np.unique(all_runs[a : b - size + 1])
            elif b > a:
                tokens = shingles(hashed[a:b], b - a) + np.uint64(b - a)
            else:
                tokens = hashed[:0]
            yield begin + at, tokens


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return (
            int(np.sum(mixed(tokens ^ CLASS), dtype=np.uint64).view(np.int64)),
            int(np.sum(mixed(tokens * PAIR), dtype=np.uint64).view(np.int64)),
        )


def parities(tokens: np.ndarray) -> bytes:
    """Bit k: whether an odd number of tokens falls on it. Two to four bits for each token."""
    bits = 8 << max(0, (len(tokens) - 1).bit_length() - 2)
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """At least so many tokens are in one of the two sets only."""
    size = min(len(a), len(b))
    x, y = (_folded(np.frombuffer(bits, np.uint8), size) for bits in (a, b))
    return int(np.bitwise_count(x ^ y).sum())


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Parities as they would be with fewer bits."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _possible(batches):
    """Pairs that sizes and parities do not rule out."""
    for batch in batches:
        a_n, b_n, a_bits, b_bits = (
            batch.column(c).to_pylist() for c in ("a_n", "b_n", "a_bits", "b_bits")
        )
        passed = [
            # common <= (n + m - differing) / 2, and a link needs 1.8 * common >= 0.8 * (n + m)
            180 * (n + m - differing(x, y)) >= 160 * (n + m)
            for n, m, x, y in zip(a_n, b_n, a_bits, b_bits)
        ]
        yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))


class _Members:
    """Rows of lists, one list after another, as arrays."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        rows = pa.Table.from_batches(batches).combine_chunks()

        def of(name: str) -> np.ndarray:
            return rows.column(name).to_numpy()

        key, low, high = of("key"), of("low"), of("high")
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        self.first = np.flatnonzero(new)
        self.group = np.cumsum(new)
        self.one_block = low == high
        self.block, self.doc, self.label, self.n = (
            of(name) for name in ("block", "doc_id", "label", "n")
        )
        data, offsets = buffers(rows.column("bits").combine_chunks())
        self.size = np.diff(offsets)
        # For each size of parities, those of all rows with as many or more, folded to it.
        self.place, self.folded = {}, {}
        larger: list[np.ndarray] = []
        at_larger = np.zeros(0, np.int64)
        for size in sorted(set(self.size.tolist()), reverse=True):
            at = np.flatnonzero(self.size == size)
            own = data[offsets[at][:, None] + np.arange(size)]
            while larger and larger[0].shape[1] > size:
                half = larger[0].shape[1] // 2
                larger = [larger[0][:, :half] ^ larger[0][:, half:]]
            table = np.concatenate([*larger, own])
            at_larger = np.concatenate([at_larger, at])
            place = np.full(len(key), -1)
            place[at_larger] = np.arange(len(at_larger))
            self.place[size] = place
            self.folded[size] = table.view(np.uint64) if size % 8 == 0 else table
            larger = [table]

    def allowed(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether labels, blocks and sizes let two rows of a list be compared."""
        small = np.minimum(self.n[i], self.n[j])
        large = np.maximum(self.n[i], self.n[j])
        apart = self.one_block[i] | (self.block[i] != self.block[j])
        return (self.label[i] != self.label[j]) & apart & (100 * small >= 80 * large)

    def pairs(self):
        """Row numbers of pairs that may be compared, some at a time; each list on its own."""
        sizes = np.diff(np.append(self.first, len(self.group)))
        for d in range(1, min(SHORT, int(sizes.max()) if len(sizes) else 0)):
            i = np.flatnonzero(self.group[d:] == self.group[:-d])
            i = i[sizes[self.group[i] - 1] <= SHORT]
            good = self.allowed(i, i + d)
            yield i[good], i[good] + d
        for at in np.flatnonzero(sizes > SHORT).tolist():
            rows = np.arange(self.first[at], self.first[at] + sizes[at])
            # All but the rows of the most common label, against all.
            _, of, often = np.unique(self.label[rows], return_inverse=True, return_counts=True)
            common = of == often.argmax()
            for k in np.flatnonzero(~common).tolist():
                other = rows[common | (np.arange(len(rows)) > k)]
                i = np.full(len(other), rows[k])
                good = self.allowed(i, other)
                yield i[good], other[good]

    def possible(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The pairs that parities do not rule out."""
        least = np.minimum(self.size[i], self.size[j])
        total = self.n[i] + self.n[j]
        good = np.zeros(len(i), bool)
        for size in np.unique(least).tolist():
            some = np.flatnonzero(least == size)
            table, place = self.folded[size], self.place[size]
            for a in range(0, len(some), 100_000):
                at = some[a : a + 100_000]
                apart = table[place[i[at]]] ^ table[place[j[at]]]
                differ = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
                good[at] = 180 * (total[at] - differ) >= 160 * total[at]
        return good

    def drawn(self, i: np.ndarray, j: np.ndarray, seed: int) -> np.ndarray:
        """Which of the pairs are taken: all of a list with few, else DRAWN for each of its labels."""
        sizes = np.bincount(self.group)
        many = (np.bincount(self.group[i], minlength=len(sizes)) > FEW * sizes)[self.group[i]]
        at = np.flatnonzero(many)
        both = np.stack([self.group, self.label])
        node = np.unique(both, axis=1, return_inverse=True)[1].reshape(-1)
        own, other = np.concatenate([i[at], j[at]]), np.concatenate([j[at], i[at]])
        with np.errstate(over="ignore"):
            pair = mixed(self.doc[own].view(np.uint64) * PAIR) + self.doc[other].view(np.uint64)
            order = np.lexsort((mixed(pair * CLASS + np.uint64(seed)), node[own]))
        node = node[own][order]
        new = np.ones(len(node), bool)
        new[1:] = node[1:] != node[:-1]
        first = np.flatnonzero(new)
        place = np.arange(len(node)) - np.repeat(first, np.diff(np.append(first, len(node))))
        good = ~many
        good[np.concatenate([at, at])[order[place < DRAWN]]] = True
        return good


def _lists_of(batches):
    """The batches that hold whole lists (key, low, high), some at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        # The rows of the last list may go on in the next batch.
        key, low, high = (batch.column(c).to_numpy() for c in ("key", "low", "high"))
        same = (key == key[-1]) & (low == low[-1]) & (high == high[-1])
        end = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if end:
            yield [*held, batch.slice(0, end)]
            held = [batch.slice(end)]
        elif held and tuple(held[-1].column(c)[-1].as_py() for c in ("key", "low", "high")) != (
            key[0],
            low[0],
            high[0],
        ):
            yield held
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield held


def _across(seed: int | None):
    """Pairs of a list with different labels that sizes and parities do not rule out.

    All of them, or with a seed those drawn; `left`: how many of the lists' others are not given.
    """

    def run(batches):
        for held in _lists_of(batches):
            members = _Members(held)
            found = [np.zeros((2, 0), np.int64)]
            for i, j in members.pairs():
                good = members.possible(i, j)
                found.append(np.stack([i[good], j[good]]))
            i, j = np.concatenate(found, axis=1)
            left = 0
            if seed is not None and len(i):
                good = members.drawn(i, j, seed)
                left = int(np.count_nonzero(~good))
                i, j = i[good], j[good]
            a, b = members.doc[i], members.doc[j]
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            lefts = np.zeros(both.shape[1], np.int64)
            lefts[:1] = left
            yield pa.record_batch(
                [pa.array(both[0]), pa.array(both[1]), pa.array(lefts)], names=["a", "b", "left"]
            )

    return run


def across(members: DataFrame, facts: DataFrame, seed: int | None = None) -> DataFrame:
    """Pairs (a, b, left) of documents in a list (key, doc_id, label) that may link over labels.

    With a seed only some of those of lists with many; the sum of `left` is how many these have beside
    them. Of equal sets with one label a list has one row. Long lists are compared block against block,
    so that a task holds two blocks at most. The parities that go with each row are folded to SKETCH
    bytes at most.
    """
    same = ["n", "d1", "d2"]
    members = (
        members.join(facts.select("doc_id", *same), "doc_id")
        .groupBy("key", "label", *same)
        .agg(F.min("doc_id").alias("doc_id"))
    )
    blocks = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    groups = ["key", "low", "high"]
    return (
        members.join(
            facts.select("doc_id", *same, F.col("sketch").alias("bits")), ["doc_id", *same]
        )
        .join(blocks, "key")
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", other)
        .select(
            "key",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "doc_id",
            "label",
            "n",
            "bits",
        )
        .repartition(*groups)
        .sortWithinPartitions(*groups)
        .mapInArrow(trimmed(_across(seed)), "a long, b long, left long")
    )


def _counted(size: int, bits: int):
    """How many documents of the task have each token, by ranges of tokens."""

    def run(batches):
        hasher, gathered, held, seen = Hasher(LOWERED), [], 0, set()

        def taken():
            tokens, n = np.unique(
                dealing.short(np.concatenate(gathered), bits), return_counts=True
            )
            rows = [
                (at, packed, dealing.plane_bytes(n[a:b].astype(np.uint32)))
                for at, a, b, packed in dealing.deal(tokens, bits)
            ]
            return _batch(rows, ["range", "keys", "n"])

        for batch in batches:
            for _, tokens in token_sets(batch.column("text"), size, hasher):
                if len(tokens) and (digest := _digest(tokens)) not in seen:
                    seen.add(digest)
                    gathered.append(tokens)
                    held += len(tokens)
                if held >= dealing.GATHERED:
                    yield taken()
                    gathered, held = [], 0
        if held:
            yield taken()

    return run


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int32()] + [pa.binary()] * (len(names) - 1)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _frequent(least: int):
    def run(batches):
        for at, rows in dealing.ranges_of(batches):
            keys = np.concatenate([dealing.undealt(at, row["keys"]) for row in rows])
            n = np.concatenate([dealing.from_plane_bytes(row["n"], np.uint32) for row in rows])
            order = np.argsort(keys)
            keys, n = keys[order], n[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            total = np.add.reduceat(n, first)
            often = total > least
            yield pa.record_batch(
                [
                    pa.array(keys[first][often].view(np.int64)),
                    pa.array(total[often], pa.int64()),
                ],
                names=["token", "n"],
            )

    return run


def frequent_tokens(docs: DataFrame, size: int, bits: int) -> np.ndarray:
    """The most frequent tokens (shortened, ascending), at most MOST_FREQUENT of them."""
    dealt = docs.select("text").mapInArrow(
        trimmed(_counted(size, bits)), "range int, keys binary, n binary"
    )
    often = stored(
        dealing.met(dealt).mapInArrow(trimmed(_frequent(LEAST_FREQUENT)), "token long, n long"), "frequent"
    )
    histogram = often.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(
        F.count("*").alias("tokens"), F.min("n").alias("least")
    )
    reached, least = 0, 1 << 62
    for row in sorted(histogram.collect(), key=lambda r: -r["step"]):
        reached += row["tokens"]
        if reached > MOST_FREQUENT:
            break
        least = row["least"]
    found = often.where(F.col("n") >= least).select("token").toArrow()
    return np.sort(found.column("token").to_numpy().view(np.uint64))


def keys_of(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The keys of a document of these tokens (ascending; frequent: a flag for each)."""
    n = len(tokens)
    need = n // 5 + 1
    buckets = range(n.bit_length() - 1, (5 * n // 4).bit_length())
    rare = tokens[~frequent][:need]
    keys = [mixed(rare + np.uint64(bucket)) for bucket in buckets]
    if len(rare) < need:
        often = tokens[frequent]
        for bucket in buckets:
            classes = max(1, (1 << bucket) // 16)
            own = mixed(often ^ CLASS) % np.uint64(classes)
            new = np.zeros(len(often), bool)
            new[np.unique(own, return_index=True)[1]] = True
            enough = len(rare) + np.cumsum(~new) >= need
            end = int(np.argmax(enough)) + 1 if enough.any() else len(often)
            order = np.argsort(own[:end], kind="stable")
            token, group = often[:end][order], own[:end][order]
            for apart in range(1, end):
                same = group[apart:] == group[:-apart]
                if not same.any():
                    break
                pairs = mixed(token[:-apart][same] * PAIR) + token[apart:][same]
                keys.append(mixed(pairs * CLASS + np.uint64(bucket)))
    return np.concatenate(keys)


def _keys(size: int, bits: int, frequent):
    """The documents' keys by ranges, and each document's size and digest with range -1."""

    def run(batches):
        hasher, often = Hasher(LOWERED), frequent.value
        gathered, docs, held, seen = [], [], 0, set()

        def taken():
            keys = dealing.short(np.concatenate(gathered), bits)
            ids = np.repeat(np.array(docs, np.int64), [len(k) for k in gathered])
            order = np.argsort(keys)
            keys, ids = keys[order], ids[order]
            rows = [
                (at, packed, dealing.plane_bytes(ids[a:b]))
                for at, a, b, packed in dealing.deal(keys, bits)
            ]
            return _full(rows)

        def _full(rows=(), facts=()):
            rows = [(*row, *[None] * 6) for row in rows]
            rows += [(-1, None, None, *fact) for fact in facts]
            kinds = [pa.int32(), pa.binary(), pa.binary()] + [pa.int64()] * 4 + [pa.binary()] * 2
            names = ["range", "keys", "docs", "doc_id", "n", "d1", "d2", "bits", "sketch"]
            columns = zip(*rows) if rows else [[]] * 9
            return pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

        for batch in batches:
            facts, ids = [], batch.column("doc_id").to_pylist()
            for at, tokens in token_sets(batch.column("text"), size, hasher):
                digest = _digest(tokens)
                odd = parities(tokens)
                sketch = _folded(np.frombuffer(odd, np.uint8), SKETCH).tobytes()
                facts.append((ids[at], len(tokens), *digest, odd, sketch))
                # Of equal sets in a task one stands for all: they link by their digest.
                if not len(tokens) or ids[at] is None or digest in seen:
                    continue
                seen.add(digest)
                cut = dealing.short(tokens, bits)
                if len(often):
                    place = np.minimum(np.searchsorted(often, cut), len(often) - 1)
                    flags = often[place] == cut
                else:
                    flags = np.zeros(len(tokens), bool)
                gathered.append(keys_of(tokens, flags))
                docs.append(ids[at])
                held += len(gathered[-1])
                if held >= dealing.GATHERED:
                    yield taken()
                    gathered, docs, held = [], [], 0
            yield _full(facts=facts)
        if held:
            yield taken()

    return run


def _lists(batches):
    """(key, doc_id) for the documents of each key that several have."""
    for at, rows in dealing.ranges_of(batches):
        keys = np.concatenate([dealing.undealt(at, row["keys"]) for row in rows])
        docs = np.concatenate([dealing.from_plane_bytes(row["docs"], np.int64) for row in rows])
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])])
        keys, docs = keys[fresh], docs[fresh]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        n = np.diff(np.append(first, len(keys)))
        several = np.repeat(n > 1, n)
        keys, docs = keys[several].view(np.int64), docs[several]
        for a in range(0, len(keys), 100_000):
            yield pa.record_batch(
                [pa.array(keys[a : a + 100_000]), pa.array(docs[a : a + 100_000])],
                names=["key", "doc_id"],
            )


def _sets(size: int):
    def run(batches):
        hasher = Hasher(LOWERED)
        for batch in batches:
            ids, out, docs, held = batch.column("doc_id").to_pylist(), [], [], 0
            for at, tokens in token_sets(batch.column("text"), size, hasher):
                out.append(tokens.view(np.int64))
                docs.append(ids[at])
                held += len(tokens)
                if held >= 500_000:
                    yield _set_batch(docs, out)
                    out, docs, held = [], [], 0
            yield _set_batch(docs, out)

    return run


def _set_batch(docs, out) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in out])]).astype(np.int32)
    flat = np.concatenate(out) if out else np.zeros(0, np.int64)
    return pa.record_batch(
        [pa.array(docs, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat))],
        names=["doc_id", "tokens"],
    )


def verified(pairs: DataFrame, facts: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of 0.8 or more."""
    sized = pairs
    for end in ("a", "b"):
        own = facts.select(
            F.col("doc_id").alias(end), F.col("n").alias(f"{end}_n"), F.col("bits").alias(f"{end}_bits")
        )
        sized = sized.join(own, end)
    sized = sized.where(100 * F.least("a_n", "b_n") >= 80 * F.greatest("a_n", "b_n"))
    possible = stored(sized.mapInArrow(trimmed(_possible), "a long, b long").distinct(), "possible")

    wanted = possible.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = stored(
        docs.join(wanted, "doc_id", "left_semi").mapInArrow(
            trimmed(_sets(size)), "doc_id long, tokens array<long>"
        ),
        "sets",
    )
    first = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("a_tokens"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("b_tokens"))
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    every = F.size("a_tokens") + F.size("b_tokens") - F.col("common")
    found = (
        possible.join(first, "a")
        .join(second, "b")
        .withColumn("common", common)
        .where(100 * F.col("common") >= 80 * every)
    )
    return stored(found.select("a", "b"), "links")


def _open(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, doc_id, label, hub, hub_label) of the lists whose documents do not all hang together."""
    labelled = stored(
        lists.join(labels, F.col("doc_id") == F.col("id"), "left").select(
            "key", "doc_id", F.coalesce("component", "doc_id").alias("label")
        ),
        "labelled",
    )
    groups = (
        labelled.groupBy("key")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.min("doc_id").alias("hub"),
            F.min_by("label", "doc_id").alias("hub_label"),
        )
        .where("low <> high")
        .select("key", "hub", "hub_label")
    )
    return labelled.join(groups, "key")


def similar_components(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of documents (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bits = dealing.range_bits(spark)
    frequent = spark.sparkContext.broadcast(frequent_tokens(docs, size, bits))
    made = stored(
        docs.mapInArrow(
            trimmed(_keys(size, bits, frequent)),
            "range int, keys binary, docs binary, doc_id long, n long, d1 long, d2 long, "
            "bits binary, sketch binary",
        ),
        "keys",
        "lz4",
    )
    facts = made.where("range = -1").select(
        "doc_id", "n", "d1", "d2", "bits", "sketch"
    )
    lists = stored(
        dealing.met(made.where("range >= 0").select("range", "keys", "docs")).mapInArrow(
            trimmed(_lists), "key long, doc_id long"
        ),
        "lists",
    )
    # Equal sets, by their digest.
    alike = facts.where("n > 0 and doc_id is not null")
    heads = alike.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("a"))
    links = stored(
        alike.join(heads, ["n", "d1", "d2"])
        .where("a <> doc_id")
        .select("a", F.col("doc_id").alias("b")),
        "links",
    )
    labels = links.select(F.col("b").alias("id"), F.col("a").alias("component"))

    tested = spark.createDataFrame([], "a long, b long")
    for done in range(ROUNDS):
        open_lists = _open(lists, labels)
        hubs = (
            open_lists.where("label <> hub_label")
            .groupBy("doc_id", F.col("hub").alias("a"))
            .agg(F.count("*").alias("keys"))
            .withColumnRenamed("doc_id", "b")
        )
        if done:
            hubs = hubs.join(tested, ["a", "b"], "left_anti")
        nearest = hubs.groupBy("b").agg(F.max_by("a", F.struct("keys", -F.col("a"))).alias("a"))
        pairs = stored(nearest.select("a", "b"), "nearest")
        tested = tested.union(pairs)
        links = links.union(verified(pairs, facts, docs, size))
        labels = components(links)

    # Lists that still have documents of several components, across these.
    seed: int | None = 0
    while True:
        members = stored(_open(lists, labels).select("key", "doc_id", "label"), "members")
        crossed = stored(across(members, facts, seed), "crossed")
        pairs = stored(
            crossed.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "drawn"
        )
        found = verified(pairs, facts, docs, size)
        links = links.union(found)
        labels = components(links)
        if not crossed.agg(F.sum("left")).head()[0]:
            break
        tested = tested.union(pairs)
        seed = seed + 1 if LINKING * found.count() >= pairs.count() else None

    return (
        facts.groupBy("doc_id")
        .agg(F.max("n").alias("n_shingles"))
        .join(labels, F.col("doc_id") == F.col("id"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
