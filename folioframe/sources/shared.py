"""The folder that driver and executors share, and files in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only where that is unset and all runs on this machine (tests) a local one is made."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        got = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = got.get() if got.isDefined() else None
    if not folder and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="folioframe-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and there for whoever computes again."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(path: str):
    """(pyarrow filesystem, path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def put(path: str, data: bytes) -> None:
    """Write beside the path, then move: whoever reads sees all of it or nothing."""
    files, at = store(path)
    part = f"{at.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.part"
    files.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(part, compression=None) as out:
        out.write(data)
    files.move(part, at)
