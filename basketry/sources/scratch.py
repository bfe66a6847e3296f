"""Tables that a plan stores for itself, in a folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINTS, WAREHOUSE = "spark.checkpoint.dir", "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, or the warehouse where there is none."""
    folder = spark.conf.get(CHECKPOINTS, None) or spark.sparkContext.getConf().get(CHECKPOINTS)
    return (folder or spark.conf.get(WAREHOUSE)).rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once and read back; removed when the application ends.

    Later steps neither repeat the work nor depend on the memory or the disks of any executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
