"""The folder all executors share, and cutting lineage through it."""

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: `spark.checkpoint.dir`, else the warehouse.

    Both are folders that the driver and all executors see; no machine-local
    folder is ever used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in this application's part of the shared folder."""
    home = f"{shared_folder(spark).rstrip('/')}/strandflow-{spark.sparkContext.applicationId}"
    return f"{home}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from the files.

    Used inside iterative jobs: the plan stays short, and a lost executor costs
    a re-read of files, not a re-run of all earlier rounds.
    """
    return materialised(df, "cut")


def materialised(df: DataFrame, label: str) -> DataFrame:
    """Write df once as a table in the shared folder and read it from there.

    For an intermediate result with several readers: it is computed once, the
    readers get file statistics and column pruning, and no executor holds it.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(*tables: DataFrame) -> None:
    """Remove tables made by `materialised` once their last reader has ended."""
    for table in tables:
        spark = table.sparkSession
        for folder in {posixpath.dirname(f) for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
