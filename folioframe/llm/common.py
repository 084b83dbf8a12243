"""What the operators of this subpackage share: the shared folder, spooled tables, freed memory and connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where that is unset and all runs on this machine (tests) a local one is made."""
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


def spool(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and return the written table: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_spooled(*tables: DataFrame) -> None:
    """Delete spooled tables that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def give_back() -> None:
    """Hand what this process has freed back to the system: Arrow's pool and the C library keep it otherwise, on the driver for as long as the session lasts."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def rows_of(df: DataFrame, id_col: str, text_col: str, keep_null: bool = False) -> DataFrame:
    """Only (doc_id, text), so that no further column can clash; null texts become empty unless keep_null."""
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).alias("doc_id"), (text if keep_null else F.coalesce(text, F.lit(""))).alias("text"))


def learned(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds: the fold that the contracts split by."""
    return F.crc32(F.coalesce(F.col(id_col) if isinstance(id_col, str) else id_col, F.lit(-1)).cast("string")) % folds


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component), component = smallest node reachable. Links to itself are left out.

    Alternating stars (Kiveris, Lattanzi, Mirrokni, Rastogi and Vassilvitskii, 2014): the larger neighbours of each node are
    linked with its smallest, then its smaller ones are, until nothing changes and each component is a star; that takes
    log2(n) squared rounds at most, whatever the order of the ids, a chain of a thousand about ten. Each round is a table in
    the shared folder. The smallest neighbour is combined before it shuffles, so a hub costs one row for each task, and
    links are never more than at the start. An empty table gives no rows.
    """
    now = spool(edges.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).filter("x <> y").distinct(), "links")
    state = _fingerprint(now)
    while True:
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("least"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("least").alias("y")).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("least"))
        small = large.join(least, "x").filter("y <> least").select(F.col("y").alias("x"), F.col("least").alias("y"))
        new = spool(small.unionByName(least.select("x", F.col("least").alias("y"))).distinct(), "links")
        drop_spooled(now)
        now, was, state = new, state, _fingerprint(new)
        if state == was:
            return now.select(F.col("x").alias("node"), F.col("y").alias("component")).union(now.select("y", "y").distinct())


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("y", "x"))).first())
