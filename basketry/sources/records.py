"""Records of CSV files whose quoted fields may hold line breaks, read in parallel splits.

Whether a line break ends a record depends on whether it stands within quotes, and that on everything
before it. Each line is therefore a step between two states, within quotes or not: what it leads to from
either is a property of the line alone. Each split of a file makes one step of its lines; the splits of a
file, of which the driver keeps a list anyway, are followed from the first to the last; and with the state
at its start each split is cut into records by itself. Only records that go over the end of a split are
put together from their parts. The records themselves are left to Spark's own `from_csv`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# A quoted field that ends on its line, and one that a line ends within.
CLOSED_FIELD = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?!")'
OPEN_FIELD = r'(^|,)"'
# Splits that begin within quotes, up to which they are sent to every task.
MOST_INSIDE = 1_000_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line, out, kept): physical lines in the order of each split.

    `out` tells whether a line that begins outside quotes ends within them, `kept` whether one that
    begins within quotes does.
    """

    def opened(text: Column) -> Column:
        return F.regexp_replace(text, CLOSED_FIELD, ",").rlike(OPEN_FIELD)

    line = F.col("value")
    closing = r'^[^"]*+(?:""[^"]*+)*+"(?!")'
    rest = F.regexp_replace(line, closing, "")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        line.alias("line"),
        opened(line).alias("out"),
        F.when(line.rlike(closing), opened(rest)).otherwise(F.lit(True)).alias("kept"),
    )


def _splits_of(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """(file and split, first row, row after the last) of the splits in a batch."""
    files, splits = batch.column("file").to_pylist(), batch.column("split").to_pylist()
    begin = 0
    for at in range(1, len(files) + 1):
        if at == len(files) or (files[at], splits[at]) != (files[begin], splits[begin]):
            yield (files[begin], splits[begin]), begin, at
            begin = at


def _step(out: np.ndarray, kept: np.ndarray) -> tuple[bool, bool]:
    """Where some lines lead from outside and from within quotes."""
    fixed = np.flatnonzero(out == kept)
    after = int(fixed[-1]) + 1 if len(fixed) else 0
    flips = bool(np.count_nonzero(out[after:] & ~kept[after:]) % 2)
    if len(fixed):
        end = bool(out[fixed[-1]]) ^ flips
        return end, end
    return flips, not flips


def _steps(batches):
    now, step = None, (False, True)
    found = []
    for batch in batches:
        out = batch.column("out").to_numpy(zero_copy_only=False).astype(bool)
        kept = batch.column("kept").to_numpy(zero_copy_only=False).astype(bool)
        for split, begin, end in _splits_of(batch):
            if split != now:
                if now is not None:
                    found.append((*now, *step))
                now, step = split, (False, True)
            here = _step(out[begin:end], kept[begin:end])
            step = (here[step[0]], here[step[1]])
    if now is not None:
        found.append((*now, *step))
    columns = list(zip(*found)) if found else [[]] * 4
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
    yield pa.record_batch(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "split", "out", "kept"]
    )


def begun_inside(lines: DataFrame) -> list[tuple[str, int]]:
    """The splits that begin within quotes; one step for each split comes to the driver."""
    steps = lines.select("file", "split", "out", "kept").mapInArrow(
        _steps, "file string, split long, out boolean, kept boolean"
    )
    inside, file, state = [], None, False
    for row in sorted(steps.collect(), key=lambda row: (row.file, row.split)):
        if row.file != file:
            file, state = row.file, False
        if state:
            inside.append((row.file, row.split))
        state = row.kept if state else row.out
    if len(inside) > MOST_INSIDE:
        raise ValueError(
            f"{len(inside)} splits begin within quotes; larger ones (spark.sql.files.maxPartitionBytes) "
            "are needed"
        )
    return inside


def _cut(batches):
    """The records of each split, and what belongs to a record that another split begins or ends."""
    now, number, state = None, 0, False
    parts: list[str] = []
    begins = True
    found = []

    def close(ends: bool) -> None:
        nonlocal number, parts
        if parts:
            found.append((*now, number, "\n".join(parts), begins, ends))
            number += 1
        parts = []

    def taken():
        columns = list(zip(*found))
        found.clear()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
        return pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["file", "split", "number", "record", "begins", "ends"],
        )

    for batch in batches:
        names = ("file", "split", "line", "out", "kept", "inside")
        for file, split, line, out, kept, inside in zip(
            *(batch.column(name).to_pylist() for name in names)
        ):
            if now != (file, split):
                if now is not None:
                    close(not state)
                now, number, state, begins = (file, split), 0, inside, not inside
            elif not state:
                close(True)
                begins = True
            parts.append(line)
            state = kept if state else out
        if len(found) > 5_000:
            yield taken()
    if now is not None:
        close(not state)
    if found:
        yield taken()


def whole_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, first): the records of the files of a path; `first` marks the first of each file."""
    lines = _lines(spark, path)
    inside = spark.createDataFrame(begun_inside(lines), "file string, split long")
    marked = lines.join(
        F.broadcast(inside.withColumn("inside", F.lit(True))), ["file", "split"], "left"
    ).withColumn("inside", F.coalesce("inside", F.lit(False)))
    pieces = marked.mapInArrow(
        _cut,
        "file string, split long, number long, record string, begins boolean, ends boolean",
    )
    first = (F.col("split") == 0) & (F.col("number") == 0)
    complete = pieces.where("begins and ends").select("record", first.alias("first"))
    # At most two parts of a split are not complete.
    order = Window.partitionBy("file").orderBy("split", "number")
    parts = pieces.where("not (begins and ends)").withColumn(
        "of", F.count_if(F.col("begins")).over(order)
    )
    joined = parts.groupBy("file", "of").agg(
        F.sort_array(F.collect_list(F.struct("split", "number", "record"))).alias("parts")
    )
    head = F.col("parts")[0]
    spanning = joined.select(
        F.array_join(F.transform("parts", lambda part: part["record"]), "\n").alias("record"),
        ((head["split"] == 0) & (head["number"] == 0)).alias("first"),
    )
    ended = F.regexp_replace("record", r"\r\z", "").alias("record")
    return complete.unionByName(spanning).select(ended, "first").where(F.trim("record") != "")
