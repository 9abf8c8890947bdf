"""Cutting a plan at a written table in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the session's shared folder.

    A session that names none (tests, a laptop) gets one below its warehouse, which every executor
    of a cluster reaches as well.
    """
    base = spark.conf.get(SHARED_FOLDER_KEY, None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    What was handed out and what is settled later are then the same rows, and an executor that
    is lost costs only its own tasks.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*written: DataFrame) -> None:
    """Remove the folders of materialised tables that nothing reads any more."""
    for df in written:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
