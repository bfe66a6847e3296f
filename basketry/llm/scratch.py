"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Only a session in one process (as in tests) may go without; it gets a folder of its own.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"{SETTING} must name a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="shared-")
    spark.conf.set(SETTING, folder)
    return folder


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The rows of df, written once to the shared folder and read back.

    Cuts the lineage: what a lost executor held is read again and not computed again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
