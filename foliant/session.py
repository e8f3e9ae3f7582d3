"""Session helpers: table loading and lineage cutting that survives the loss of executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a private one only where none is set and all tasks run in this process, as in tests."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not conf and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(conf or tempfile.mkdtemp(prefix="foliant-checkpoint-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Write a table in the shared checkpoint folder and read it again: a lost executor costs no recomputation of the whole
    lineage, and plans after it know the table's true size. (The size that Spark infers of a checkpointed join is the product
    of its sides', whose digits multiply with each round of a loop.) The table is deleted when the driver ends, or by `forget`.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _file_system(df.sparkSession, path).deleteOnExit(df.sparkSession._jvm.org.apache.hadoop.fs.Path(path))
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table that `cut` wrote and that nothing reads any more, such as a round's before the last."""
    _file_system(df.sparkSession, df._written).delete(df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written), True)


def _file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
