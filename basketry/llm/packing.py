"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents over the capacity are cut into pieces of exactly the capacity, the first one shorter. How
many pieces there are of each length is a histogram with `capacity` entries at any size of the
corpus, and the packing is planned on it: every step places a whole run of pieces of one length
alike. Lengths above a third of the capacity are matched first, largest with largest that fits, at
most two to a sequence; shorter ones then go, longest first, where the remaining gap is smallest.
The pieces find their places by their rank among those of the same length, which is counted in
buckets, so that no task meets all pieces of a common length.

Null or empty text is a document of the end id alone. Null ids are ids like any other. Repeated rows
are documents of their own, so each (doc_id, piece) then comes as often as its row. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.memory import trimmed
from basketry.llm.scratch import stored
from basketry.llm.tokens import REMEMBERED, Encoder, small_batches

BUCKET_ROWS = 100_000
BATCH_BYTES = 2_000_000


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool, remembered: int = REMEMBERED):
    def run(batches):
        encoder = Encoder(path, remembered)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for some in small_batches(batch, BATCH_BYTES):
                docs, piece, start, length, crc, ids = [], [], [], [], [], []
                encoded = encoder.encode(some.column("text").to_pylist())
                for doc, data in zip(some.column("doc_id").to_pylist(), encoded):
                    data += end
                    total = len(data) // 4
                    to = (total - 1) % capacity + 1
                    at = 0
                    for k in range(-(-total // capacity)):
                        own = data[4 * at : 4 * to]
                        docs.append(doc)
                        piece.append(k)
                        start.append(at)
                        length.append(to - at)
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            ids.append(own)
                        at, to = to, to + capacity
                yield pa.record_batch(
                    [
                        pa.array(docs, some.schema.field("doc_id").type),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ]
                    + [pa.array(ids, pa.binary())] * with_ids,
                    names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids,
                )

    return trimmed(run)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, rank, sequence, offset, together).

    The pieces of that length from that rank on, up to the next entry's, fill consecutive sequences
    from `sequence` on, `together` of them in each, one after the other from `offset` on.
    """
    left = {size: n for size, n in counts.items() if n}
    taken = dict.fromkeys(left, 0)
    places, sequences = [], 0
    gaps: list[tuple[int, int, int]] = []  # (gap, first sequence, sequences), sorted

    def place(size: int, n: int, sequence: int, offset: int, together: int) -> None:
        places.append((size, taken[size], sequence, offset, together))
        taken[size] += n
        left[size] -= n

    def opened(gap: int, first: int, n: int) -> None:
        if gap and n:
            insort(gaps, (gap, first, n))

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for size in large:
        fitting = [s for s in large if s <= size and s + size <= capacity]
        for other in fitting:
            pairs = left[size] // 2 if other == size else min(left[size], left[other])
            if pairs:
                if other == size:
                    place(size, 2 * pairs, sequences, 0, 2)
                else:
                    place(size, pairs, sequences, 0, 1)
                    place(other, pairs, sequences, size, 1)
                opened(capacity - size - other, sequences, pairs)
                sequences += pairs
        if left[size]:
            n = left[size]
            place(size, n, sequences, 0, 1)
            opened(capacity - size, sequences, n)
            sequences += n
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            at = bisect_left(gaps, (size, -1, -1))
            if at < len(gaps):
                gap, first, n = gaps.pop(at)
            else:
                gap, first, n = capacity, sequences, -(-left[size] // (capacity // size))
                sequences += n
            together = min(gap // size, left[size])
            full = min(n, left[size] // together)
            place(size, full * together, first, capacity - gap, together)
            opened(gap - together * size, first, full)
            opened(gap, first + full, n - full)
    return places


def _placed(places, columns: list[str]):
    """Sequence and offset of each piece from its length and rank."""

    def run(batches):
        table = np.array(sorted(places), np.int64).reshape(-1, 5)
        size, rank, sequence, offset, together = table.T
        keys = (size << 44) | rank
        for batch in batches:
            length = batch.column("length").to_numpy()
            own = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 44) | own, "right") - 1
            past = own - rank[at]
            yield pa.record_batch(
                [batch.column(c) for c in columns]
                + [
                    pa.array(sequence[at] + past // together[at]),
                    pa.array(offset[at] + past % together[at] * length),
                ],
                names=[*columns, "sequence_id", "offset"],
            )

    return trimmed(run)


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of documents (doc_id, text).

    With `with_ids` also ids: the piece's ids as little-endian unsigned 32-bit integers. A worker
    remembers the ids of about `remembered` pieces of text; with fewer it needs less memory and more time.
    """
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids binary" * with_ids
    pieces = stored(
        docs.mapInArrow(_pieces(path, capacity, end_id, with_ids, remembered), schema), "pieces"
    )
    columns = pieces.columns

    buckets = max(1, pieces.count() // BUCKET_ROWS)
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")
    pieces = pieces.withColumn("bucket", bucket)
    counted = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counted = stored(
        counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths"
    )
    histogram = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    places = plan({row["length"]: row["n"] for row in histogram}, capacity)

    within = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("place", F.row_number().over(within) - 1)
        .join(counted.select("length", "bucket", "before"), ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("place"))
        .select(*columns, "rank")
    )
    return ranked.mapInArrow(
        _placed(places, columns), f"{schema}, sequence_id long, offset long"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the sequences of a result of pack() with ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(
        parts, F.lit(b"").cast("binary"), lambda done, part: F.concat(done, part["ids"])
    )
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), joined.alias("ids")
    )
