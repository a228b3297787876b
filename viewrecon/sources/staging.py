"""Tables that a run computes once and reads several times, on storage that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of this machine if all runs here, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="viewrecon-"))
    return spark.conf.get("spark.checkpoint.dir")


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path for what this session stages."""
    return f"{shared_folder(spark)}/viewrecon-staged/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df``, written once and read back; ``by``: a column whose values become folders, so that a filter on it reads only some."""
    path = staged_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def release(spark: SparkSession) -> None:
    """Deletes what this session staged; results that still read it are void then."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/viewrecon-staged/{spark.sparkContext.applicationId}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
