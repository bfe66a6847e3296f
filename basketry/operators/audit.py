"""The key audit: what the loader refuses, as counts per table.

Repeated keys are looked for by fingerprints: of each key only a 64-bit hash is exchanged and counted.
Rows whose fingerprint is met twice are then counted exactly, by their key. Two keys that share a
fingerprint by chance cost that second look and never change the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from basketry.sources.model import MODEL, Tables
from basketry.sources.scratch import stored

# Flag column of rows that did not fit their file's header, present while loading.
MALFORMED = "_malformed"
# Fingerprints, 16 bytes each, up to which they are sent to every task; more meet by a join.
SENT = 500_000


def fingerprint(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def met_twice(t: Tables) -> DataFrame:
    """(table_name, print) of the fingerprints that more than one row of a table has."""
    prints = [
        df.select(F.lit(name).alias("table_name"), fingerprint(MODEL[name].key).alias("print"))
        for name, df in t.items()
    ]
    counted = reduce(DataFrame.unionByName, prints).groupBy("table_name", "print").count()
    return counted.where("count > 1").select("table_name", "print")


def _repeated(name: str, df: DataFrame, prints: DataFrame, many: int) -> DataFrame:
    """Rows beyond the first of each key, counted by key among the rows with these fingerprints."""
    keys = MODEL[name].key
    some = prints.where(F.col("table_name") == name).select("print")
    if many <= SENT:
        some = F.broadcast(some)
    rows = df.select(*keys).withColumn("print", fingerprint(keys)).join(some, "print", "left_semi")
    return (
        rows.groupBy(*keys)
        .count()
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_keys"))
        .select(F.lit(name).alias("table_name"), "duplicate_keys")
    )


def repeated_keys(t: Tables) -> DataFrame:
    """(table_name, duplicate_keys) of every table.

    The fingerprints met twice are stored, and one number for each table comes to the driver: a
    table without any is not looked at again.
    """
    prints = stored(met_twice(t), "fingerprints")
    many = {row.table_name: row["count"] for row in prints.groupBy("table_name").count().collect()}
    spark = prints.sparkSession
    none = [(name, 0) for name in MODEL if name not in many]
    parts = [_repeated(name, df, prints, many[name]) for name, df in t.items() if name in many]
    if none:
        parts.append(spark.createDataFrame(none, "table_name string, duplicate_keys bigint"))
    return reduce(DataFrame.unionByName, parts)


def key_audit(t: Tables) -> DataFrame:
    """Row count, null identifiers, invalid moments and repeated keys of every table, a row each."""
    counted = reduce(DataFrame.unionByName, [_audit(name, df) for name, df in t.items()])
    return counted.join(repeated_keys(t), "table_name")


def _audit(name: str, df: DataFrame) -> DataFrame:
    """What is counted where the rows are, without an exchange of rows."""
    spec = MODEL[name]
    malformed = F.col(MALFORMED) if MALFORMED in df.columns else F.lit(False)

    def findings(columns) -> Column:
        entries = [
            F.struct(
                F.lit(column).alias("column_name"),
                F.count_if(F.col(column).isNull()).alias("violations"),
            )
            for column in columns
        ]
        return F.array(*entries).cast("array<struct<column_name:string,violations:bigint>>")

    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(malformed).alias("malformed_rows"),
        findings(spec.key).alias("null_identifiers"),
        findings(spec.required_moments).alias("invalid_moments"),
    ).select(F.lit(name).alias("table_name"), "*")
