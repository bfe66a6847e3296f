"""Meeting of equal 64-bit keys across all tasks, as packed arrays.

A task gathers its keys, sorts them and deals them out by their highest bits: one row for each range
of keys, with the keys of that range as one binary value. A range holds a fixed share of all keys at
any size of the input, since there are several times as many ranges as shuffle partitions. Of each
key only 32 bits below those of its range are kept; two keys that fall together by that can add a
candidate and never lose one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

GATHERED = 1_000_000


def range_bits(spark: SparkSession) -> int:
    """log2 of the number of ranges: at least four for each shuffle partition."""
    return max(6, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def short(keys: np.ndarray, bits: int) -> np.ndarray:
    """What is kept of keys: the range and the 32 bits below it."""
    return keys >> np.uint64(32 - bits)


def plane_bytes(values: np.ndarray) -> bytes:
    """Integers byte by byte, all lowest bytes first: zero bytes then lie together."""
    size = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T).tobytes()


def from_plane_bytes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    table = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(table.T).view(dtype).reshape(-1)


def deal(ordered: np.ndarray, bits: int):
    """(range, first, last, packed keys) of shortened keys in ascending order."""
    ranges = (ordered >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(np.diff(ranges)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(ordered)]):
        low = ordered[a:b].astype(np.uint32)
        low[1:] = np.diff(low)
        yield int(ranges[a]), a, b, plane_bytes(low)


def undealt(at: int, packed: bytes) -> np.ndarray:
    """The shortened keys of a range again."""
    low = np.cumsum(from_plane_bytes(packed, np.uint32), dtype=np.uint32)
    return low.astype(np.uint64) | np.uint64(at << 32)


def met(dealt: DataFrame) -> DataFrame:
    """The rows of each range one after another in one task."""
    partitions = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(partitions, "range").sortWithinPartitions("range")


def ranges_of(batches):
    """(range, rows) of batches whose rows are sorted by range."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["range"] != now and rows:
                yield now, rows
                rows = []
            now = row["range"]
            rows.append(row)
    if rows:
        yield now, rows
