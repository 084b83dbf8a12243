"""Reports that are kept up as documents arrive: counts that merge, one table of them a batch.

The state of a batch is a histogram: how many documents have so many blocks, how often each label stands. Histograms of
batches add up to that of all, so the report over a thousand batches reads only their counts. A batch that runs again, after
a failure, replaces its own state and nothing else. Documents must arrive whole and once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "kind string, label string, size long, n long, batch long"


def partial(blocks: DataFrame) -> DataFrame:
    """blocks (doc, label) -> kind, label, size, n: documents by their number of blocks, and blocks by label."""
    sizes = blocks.groupBy("doc").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n"))
    labels = blocks.groupBy("label").agg(F.count("*").alias("n"))
    none = F.lit(None).cast("string")
    return sizes.select(F.lit("size").alias("kind"), none.alias("label"), "size", "n").unionByName(labels.select(F.lit("label").alias("kind"), "label", F.lit(None).cast("long").alias("size"), "n"))


def keep(stream: DataFrame, folder: str, checkpoint: str):
    """A started query that takes what has arrived and ends; each batch's state is below folder."""

    def merge(batch: DataFrame, number: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def state(spark: SparkSession, folder: str) -> DataFrame:
    """kind, label, size, n of all batches together."""
    rows = spark.read.schema(STATE).option("basePath", folder).parquet(folder)
    return rows.groupBy("kind", "label", "size").agg(F.sum("n").alias("n"))


def corpus(total: DataFrame) -> DataFrame:
    """One row, as stats.corpus_blocks gives it: documents, blocks, least, median (cut off) and most blocks of a document."""
    own = total.filter("kind = 'size'")
    whole = F.percentile("size", 0.5, F.col("n")).cast("long")
    return own.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("documents"), F.sum(F.col("size") * F.col("n")).alias("blocks"), F.min("size").alias("blocks_min"), whole.alias("blocks_median"), F.max("size").alias("blocks_max"))


def labels(total: DataFrame) -> DataFrame:
    return total.filter("kind = 'label'").select("label", "n")


def nearest_ranks(total: DataFrame, ratios: dict[str, float]) -> DataFrame:
    """One row of nearest-rank percentiles of the number of blocks of a document: only its different values are gathered."""
    own = total.filter("kind = 'size'")
    pairs = own.agg(F.array_sort(F.collect_list(F.struct("size", "n"))).alias("p"), F.sum("n").alias("all"))

    def at(ratio: float):
        rank = F.rint(F.lit(ratio) * (F.col("all") - 1)).cast("long")
        step = lambda s, x: F.struct((s["seen"] + x["n"]).alias("seen"), F.when((s["seen"] <= rank) & (rank < s["seen"] + x["n"]), x["size"]).otherwise(s["found"]).alias("found"))
        return F.aggregate("p", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("found")), step)["found"]

    return pairs.select(*[at(r).alias(name) for name, r in ratios.items()])
