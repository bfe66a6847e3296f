"""Near-duplicate vectors by the signs of random projections.

Each of TABLES tables has a key of BITS signs for every vector; vectors with an equal key in some
table are compared by their exact cosine in double precision. A pair that meets in several tables
counts in the first of them. With 12 bits and 32 tables, a pair at the threshold of 0.9 meets with
probability 0.995, and closer pairs more surely.

Keys that more than BLOCK vectors share are compared block against block, so that a task holds two
blocks at most; pairs are counted where they are found, and only as many links leave a task as hold
its vectors together.

Vectors are compared with those of their own length; the length is part of each key.

Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; so do
rows with a null id. Rows with the same id are not
compared with each other; links are counted to rows with other ids. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import components
from basketry.llm.scratch import stored

BITS, TABLES, BLOCK = 12, 32, 1024
THRESHOLD = 0.9


def unit_vectors(column: pa.Array):
    """By length: (length, the vectors of a column at length one, which rows they are from)."""
    found: dict[int, list] = {}
    for at, values in enumerate(column):
        if values.is_valid and len(values.values) and not values.values.null_count:
            own = found.setdefault(len(values.values), [])
            own.append((at, values.values.to_numpy(zero_copy_only=False)))
    for size, some in found.items():
        table = np.stack([values for _, values in some]).astype(np.float64)
        rows = np.array([at for at, _ in some], np.int64)
        finite = np.isfinite(table).all(axis=1)
        table, rows = table[finite], rows[finite]
        # Scaled first, so that squares of very large or small components stay in range.
        largest = np.abs(table).max(axis=1)
        table, rows, largest = table[largest > 0], rows[largest > 0], largest[largest > 0]
        table = table / largest[:, None]
        yield size, table / np.sqrt((table * table).sum(axis=1))[:, None], rows


def _keys(bits: int, tables: int, seed: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits)
        for batch in batches:
            for size, units, rows in unit_vectors(batch.column("embedding")):
                if size not in planes:
                    if len(planes) == 8:
                        planes.clear()
                    drawn = np.random.default_rng(seed)
                    planes[size] = drawn.standard_normal((size, bits * tables))
                ids = batch.column("vec_id").take(pa.array(rows))
                known = np.array(ids.is_valid().to_numpy(zero_copy_only=False), bool)
                units, ids = units[known], ids.filter(pa.array(known))
                signs = (units @ planes[size] > 0).reshape(len(units), tables, bits)
                keys = (signs * weights).sum(axis=2).astype(np.int32)
                yield pa.record_batch(
                    [
                        ids,
                        pa.array(np.full(len(units), size, np.int32)),
                        pa.array([row.tobytes() for row in keys], pa.binary()),
                        pa.array([row.tobytes() for row in units], pa.binary()),
                    ],
                    names=["vec_id", "size", "keys", "unit"],
                )

    return run


def _tables(tables: int):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.int32)
            yield pa.record_batch(
                [
                    pa.array(np.tile(np.arange(tables, dtype=np.int32), n)),
                    pa.array(keys),
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(n), tables))),
                    batch.column("size").take(pa.array(np.repeat(np.arange(n), tables))),
                ],
                names=["table", "key", "vec_id", "size"],
            )

    return run


def _spanning(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold the same vectors together as the pairs (i, j) do."""
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(len(ids))
    return ids[label[moved]], ids[moved]


def _compared(threshold: float):
    """Per vector the links found in a block, and links that span them."""

    def found(rows):
        table = rows[0]["table"]
        ids = np.array([row["vec_id"] for row in rows], np.int64)
        units = np.frombuffer(b"".join(row["unit"] for row in rows)).reshape(len(rows), -1)
        keys = np.frombuffer(b"".join(row["keys"] for row in rows), np.int32).reshape(len(rows), -1)
        i, j = np.nonzero(np.triu(units @ units.T >= threshold - 1e-9, 1))
        if rows[0]["low"] != rows[0]["high"]:
            # Two blocks: each against the other only.
            own = np.array([row["block"] for row in rows])
            across = own[i] != own[j]
            i, j = i[across], j[across]
        if table:
            fresh = ~(keys[i, :table] == keys[j, :table]).any(axis=1)
            i, j = i[fresh], j[fresh]
        linked = ids[i] != ids[j]
        i, j = i[linked], j[linked]
        exact = np.einsum("nd,nd->n", units[i], units[j]) >= threshold
        i, j = i[exact], j[exact]
        n = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
        return ids, n, *_spanning(ids, i, j)

    def run(batches):
        waiting, now = [], None

        def taken():
            ids, n, a, b = found(waiting)
            some = n > 0
            return pa.record_batch(
                [
                    pa.array(np.concatenate([ids[some], b])),
                    pa.array(np.concatenate([n[some], np.zeros(len(b), np.int64)])),
                    pa.array(np.concatenate([ids[some], a])),
                ],
                names=["vec_id", "n", "linked"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                group = (row["table"], row["size"], row["key"], row["low"], row["high"])
                if group != now:
                    if len(waiting) > 1:
                        yield taken()
                    waiting, now = [], group
                waiting.append(row)
        if len(waiting) > 1:
            yield taken()

    return run


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    bits: int = BITS,
    tables: int = TABLES,
    block: int = BLOCK,
    seed: int = 7,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of vectors (vec_id, embedding)."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    keyed = stored(
        vectors.mapInArrow(
            _keys(bits, tables, seed), "vec_id long, size int, keys binary, unit binary"
        ),
        "keyed",
    )
    entries = keyed.mapInArrow(_tables(tables), "table int, key int, vec_id long, size int")
    # Only keys that several vectors share; their number says into how many blocks they go.
    shared = (
        entries.groupBy("table", "size", "key")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("table", "size", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        entries.join(shared, ["table", "size", "key"])
        .withColumn("block", own)
        .withColumn("other", each)
        .select(
            "table",
            "size",
            "key",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "vec_id",
        )
    )
    groups = ["table", "size", "key", "low", "high"]
    compared = stored(
        dealt.join(keyed, ["vec_id", "size"])
        .repartition(*groups)
        .sortWithinPartitions(*groups)
        .mapInArrow(_compared(threshold), "vec_id long, n long, linked long"),
        "links",
    )
    counts = compared.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    joined = components(compared.select(F.col("vec_id").alias("a"), F.col("linked").alias("b")))
    return (
        vectors.select("vec_id")
        .distinct()
        .join(counts, "vec_id", "left")
        .join(joined, F.col("vec_id") == F.col("id"), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
