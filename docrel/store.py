"""Tables that a plan writes to the cluster's shared folder and reads back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new path in the cluster's shared folder. Without one, a local folder serves where the driver is the only machine, as
    in tests; a cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='docrel-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/docrel-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, so a lost executor costs a read, not a
    recomputation, and a plan that uses it twice does not compute it twice."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._docrel_path = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete what stage() wrote, once nothing reads it any more."""
    path = getattr(df, "_docrel_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
