"""Where intermediate results are kept."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode with the setting absent; on a
    cluster other machines could not read it.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="surveyqc-")
    sc.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write a table under the shared folder and go on from the written files: computed
    once, readable after executors are lost, with column pruning. ``by`` are columns whose
    values get folders of their own. The files stay; the owner of the folder clears it."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/surveyqc/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(*tables: DataFrame) -> None:
    """Empty tables that :func:`materialize` wrote and that nothing will read again, by
    writing no rows over them. Other tables are refused."""
    for df in tables:
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            if not re.search("/surveyqc/[^/]+-[0-9a-f]{32}$", folder):
                raise ValueError(f"{folder} is no intermediate table")
            df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(folder)
