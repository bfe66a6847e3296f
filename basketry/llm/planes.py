"""Token ids of a corpus in order of its documents, as compressed byte or bit planes.

Format: one folder with Parquet tables. `chunks` has a row for each run of at most `block` ids of a
part (parts hold consecutive ranges of doc_id): its planes, each compressed with zstandard, and the
stretches of documents in it. `index` has the same chunks without the planes: where each begins and
how long each of its compressed planes is. Plane k of a chunk holds byte k (or bit k, eight to a
byte) of all its ids. A document begins at part start + `first`.

Null or empty text is a document of the end id alone. Null ids come first. Rows with the same id
follow each other in order of their text. An empty table gives tables without rows. Other columns
are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.scratch import shared_folder
from basketry.llm.tokens import Encoder, small_batches

LEVEL = 3


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, lowest first."""
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        table = np.packbits(np.unpackbits(table, axis=1, bitorder="little"), axis=0)
    return [np.ascontiguousarray(plane).tobytes() for plane in table.T]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The n ids of a block."""
    table = np.stack([np.frombuffer(plane, np.uint8) for plane in planes], axis=1)
    if len(planes) == 32:
        table = np.packbits(
            np.unpackbits(table, axis=0, count=n), axis=1, bitorder="little"
        )
    return np.ascontiguousarray(table).view("<u4").reshape(-1)


def _chunks(path: str, block: int, end_id: int, bits: bool, kind: pa.DataType):
    stretch = pa.struct(
        [
            ("doc_id", kind),
            ("first", pa.int64()),
            ("n_tokens", pa.int64()),
            ("at", pa.int64()),
            ("n", pa.int64()),
        ]
    )

    def run(batches):
        encoder, compressor = Encoder(path), zstandard.ZstdCompressor(level=LEVEL)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        waiting, stretches, filled, chunk = [], [], 0, 0

        def closed():
            ids = np.frombuffer(b"".join(waiting), "<u4")
            planes = [compressor.compress(plane) for plane in to_planes(ids, bits)]
            return pa.record_batch(
                [
                    pa.array([part], pa.int32()),
                    pa.array([chunk], pa.int64()),
                    pa.array([chunk * block], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([[len(p) for p in planes]], pa.list_(pa.int32())),
                    pa.array([planes], pa.list_(pa.binary())),
                    pa.array([stretches], pa.list_(stretch)),
                ],
                names=["part", "chunk", "first", "n", "sizes", "planes", "stretches"],
            )

        for batch in batches:
            for some in small_batches(batch):
                encoded = encoder.encode(some.column("text").to_pylist())
                for doc, data in zip(some.column("doc_id").to_pylist(), encoded):
                    data += end
                    total, at = len(data) // 4, 0
                    first = chunk * block + filled
                    while at < total:
                        n = min(total - at, block - filled)
                        waiting.append(data[4 * at : 4 * (at + n)])
                        stretches.append(
                            {"doc_id": doc, "first": first, "n_tokens": total, "at": at, "n": n}
                        )
                        at, filled = at + n, filled + n
                        if filled == block:
                            yield closed()
                            waiting, stretches, filled, chunk = [], [], 0, chunk + 1
        if filled:
            yield closed()

    return run


def write_ids(
    docs: DataFrame, path: str, folder: str, block: int = 65_536, end_id: int = 2, bits: bool = False
) -> None:
    """Writes the ids of documents (doc_id, text) to `folder` in ascending order of doc_id."""
    docs = docs.select("doc_id", "text")
    field = docs.schema["doc_id"]
    kind = field.dataType.simpleString()
    schema = (
        "part int, chunk long, first long, n long, sizes array<int>, planes array<binary>, "
        f"stretches array<struct<doc_id:{kind},first:bigint,n_tokens:bigint,at:bigint,n:bigint>>"
    )
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    arrow = docs.limit(0).select("doc_id").toArrow().schema.field("doc_id").type
    chunks = ordered.mapInArrow(_chunks(path, block, end_id, bits, arrow), schema)
    chunks.write.option("compression", "uncompressed").parquet(f"{folder}/chunks")
    spark = docs.sparkSession
    spark.read.schema(schema).parquet(f"{folder}/chunks").select(
        "part", "chunk", "first", "n", "sizes"
    ).write.parquet(f"{folder}/index")


def _stretches(kind: pa.DataType):
    """Documents as they stand in the chunks; those that go over an end keep their ids."""

    def run(batches):
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes([decompressor.decompress(p) for p in row["planes"]], row["n"])
                data, place = memoryview(ids.tobytes()), 0
                docs, first, total, at, crc, rest = [], [], [], [], [], []
                for s in row["stretches"]:
                    own = data[4 * place : 4 * (place + s["n"])]
                    place += s["n"]
                    whole = s["n"] == s["n_tokens"]
                    docs.append(s["doc_id"])
                    first.append(s["first"])
                    total.append(s["n_tokens"])
                    at.append(s["at"])
                    crc.append(zlib.crc32(own) if whole else None)
                    rest.append(None if whole else bytes(own))
                yield pa.record_batch(
                    [
                        pa.array([row["part"]] * len(docs), pa.int32()),
                        pa.array(docs, kind),
                        pa.array(first, pa.int64()),
                        pa.array(total, pa.int64()),
                        pa.array(at, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(rest, pa.binary()),
                    ],
                    names=["part", "doc_id", "first", "n_tokens", "at", "crc", "rest"],
                )

    return run


def _joined(batches):
    """The checksum of each document, also of those that stand in several chunks."""
    for batch in batches:
        sums = batch.column("crc").to_pylist()
        for at, parts in enumerate(batch.column("rest").to_pylist()):
            if sums[at] is None:
                sums[at] = 0
                for part in parts:
                    sums[at] = zlib.crc32(part["rest"], sums[at])
        yield pa.record_batch(
            [batch.column(c) for c in ("part", "doc_id", "first", "n_tokens")]
            + [pa.array(sums, pa.int64())],
            names=["part", "doc_id", "first", "n_tokens", "ids_crc32"],
        )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in a folder of write_ids()."""
    chunks = spark.read.parquet(f"{folder}/chunks")
    arrow = chunks.limit(0).select(
        F.explode("stretches.doc_id").alias("doc_id")
    ).toArrow().schema.field("doc_id").type
    kind = chunks.schema["stretches"].dataType.elementType["doc_id"].dataType.simpleString()
    found = chunks.select("part", "n", "planes", "stretches").mapInArrow(
        _stretches(arrow),
        f"part int, doc_id {kind}, first long, n_tokens long, at long, crc long, rest binary",
    )
    # A document over several chunks comes together with its own ids and nothing else.
    found = found.groupBy("part", "first", "doc_id", "n_tokens").agg(
        F.max("crc").alias("crc"), F.sort_array(F.collect_list(F.struct("at", "rest"))).alias("rest")
    )
    found = found.mapInArrow(
        _joined, f"part int, doc_id {kind}, first long, n_tokens long, ids_crc32 long"
    )
    # One row for each part, so as many as there were tasks.
    parts = spark.read.parquet(f"{folder}/index").groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return (
        found.join(F.broadcast(starts), "part")
        .select(
            "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
        )
    )


def new_folder(spark: SparkSession) -> str:
    """A folder for one set of files in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
