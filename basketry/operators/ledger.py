"""Reference checks as one keyed count instead of one anti-join each.

An anti-join ships every row of both sides and meets a hot key in one task. Here every
source is reduced to counts per key, the reduction runs on the map side, and one exchange
of the union answers all questions about the key.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


def key_ledger(
    key: str,
    sources: Mapping[str, DataFrame],
    subsets: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Rows per key in each source: one output row per key, one count column per source.

    A subset counts the rows of a source that meet a condition, in the same scan.
    """
    subsets = subsets or {}

    def mark(name: str, source: str) -> Column:
        if name in subsets:
            of, condition = subsets[name]
            counted = F.when(condition, 1).otherwise(0) if of == source else F.lit(0)
        else:
            counted = F.lit(1 if name == source else 0)
        return counted.cast("bigint").alias(name)

    names = [*sources, *subsets]
    union = reduce(
        DataFrame.unionByName,
        [df.select(key, *[mark(name, source) for name in names]) for source, df in sources.items()],
    )
    return union.groupBy(key).agg(*[F.sum(name).alias(name) for name in names])


class Entry(NamedTuple):
    """What a row adds to a ledger: the key it has there, and counts by name."""

    key: Column
    counts: Mapping[str, Column]


class JointLedger:
    """Several ledgers at once, each source scanned once.

    `sources` names for each source its rows and the relations they have a part in; a source with two
    keys gives two entries per row, within its scan. `flaws` are conditions on single rows: a row that
    meets any gives one entry more, so that they cost nothing where rows are sound. All entries are
    counted in one exchange, by relation and key; the counts of a relation share the columns with
    those of the others.
    """

    FLAWS = "flaws"

    def __init__(
        self,
        sources: Mapping[str, tuple[DataFrame, Mapping[str, Entry], Mapping[str, Column]]],
    ) -> None:
        self.names: dict[str, list[str]] = {self.FLAWS: []}
        for _, parts, flaws in sources.values():
            self.names[self.FLAWS] += [name for name in flaws]
            for relation, entry in parts.items():
                known = self.names.setdefault(relation, [])
                known += [name for name in entry.counts if name not in known]
        self.width = max(len(names) for names in self.names.values())
        rows = [
            source.select(F.inline(self._entries(parts, flaws)))
            for source, parts, flaws in sources.values()
        ]
        columns = [F.sum(f"n{at}").alias(f"n{at}") for at in range(self.width)]
        self.rows = reduce(DataFrame.unionByName, rows).groupBy("relation", "key").agg(*columns)

    def _entry(self, relation: str, key: Column, counts: Mapping[str, Column]) -> Column:
        placed = {self.names[relation].index(name): count for name, count in counts.items()}
        return F.struct(
            F.lit(relation).alias("relation"),
            key.cast("string").alias("key"),
            *[
                placed.get(at, F.lit(0)).cast("bigint").alias(f"n{at}")
                for at in range(self.width)
            ],
        )

    def _entries(self, parts: Mapping[str, Entry], flaws: Mapping[str, Column]) -> Column:
        entries = [self._entry(name, *entry) for name, entry in parts.items()]
        if not flaws:
            return F.array(*entries)
        marks = {name: F.when(flaw, 1).otherwise(0) for name, flaw in flaws.items()}
        flawed = reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flaws.values()])
        more = self._entry(self.FLAWS, F.lit(""), marks)
        return F.when(flawed, F.array(*entries, more)).otherwise(F.array(*entries))

    def count(self, relation: str, name: str) -> Column:
        return F.col(f"n{self.names[relation].index(name)}")

    def unmatched(self, relation: str, rows: str, target: str) -> Column:
        """Rows whose key is null or not among the target's keys, summed over the ledger."""
        missing = F.col("key").isNull() | (self.count(relation, target) == 0)
        of = (F.col("relation") == relation) & missing
        return F.coalesce(F.sum(F.when(of, self.count(relation, rows))), F.lit(0))

    def flawed(self, name: str) -> Column:
        """Rows that meet a condition."""
        of = F.col("relation") == self.FLAWS
        return F.coalesce(F.sum(F.when(of, self.count(self.FLAWS, name))), F.lit(0))


def unmatched(key: str, rows: str, target: str) -> Column:
    """Rows whose key is null or not among the target's keys, summed over a ledger."""
    missing = F.col(key).isNull() | (F.col(target) == 0)
    return F.coalesce(F.sum(F.when(missing, F.col(rows))), F.lit(0))
