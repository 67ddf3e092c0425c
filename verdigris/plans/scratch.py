"""Tables that fix an intermediate result: written to the shared folder, read again, gone with the application."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; only a local session without one gets a local folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='verdigris-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
