"""The person table as files by segment, of about the same size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.plans import rfm
from basketry.sources.model import Tables
from basketry.sources.scratch import shared_folder, stored

ROWS_PER_FILE = 2_000_000


def clustered(persons: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Persons dealt out for a write by segment: a task for each file, in the published order.

    A segment gets as many files as its persons ask for, and a person goes to one of them by the
    hash of the id: no file holds much more than another, however uneven the segments are, and no
    order over all persons is needed. `persons` is read twice, best from a stored table; one count
    for each segment comes to the driver.
    """
    counts = persons.groupBy("segment").count().orderBy("segment").collect()
    place: Column = F.lit(0)
    first = 0
    for row in counts:
        files = max(1, round(row["count"] / rows_per_file))
        own = F.lit(first) + F.pmod(F.xxhash64("customer_unique_id"), F.lit(files)).cast("int")
        place = F.when(F.col("segment").eqNullSafe(F.lit(row.segment)), own).otherwise(place)
        first += files
    dealt = persons.repartitionById(max(1, first), place)
    return dealt.sortWithinPartitions("segment", F.desc("monetary"), "customer_unique_id")


def write_persons(persons: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Publish the person table below path, a folder for each segment."""
    settled = stored(persons, "persons")
    clustered(settled, rows_per_file).write.mode("overwrite").partitionBy("segment").parquet(path)


def read_persons(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The published person table, with columns in the order of `like`."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def published_persons(t: Tables) -> DataFrame:
    """Write the person table and read it back."""
    persons = rfm.rfm_customers(t)
    spark = persons.sparkSession
    path = f"{shared_folder(spark)}/published-persons-{spark.sparkContext.applicationId}"
    write_persons(persons, path)
    return read_persons(spark, path, persons)
