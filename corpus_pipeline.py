"""documents -> packed training sequences: toxicity, line dedup, near dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioframe.llm import decontaminate, line_dedup, minhash, packing, toxicity
from folioframe.llm.common import fresh_path, give_back


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of op6, learned on the labelled rows outside its held-out fold, rejects go."""
    judge = toxicity.train(toxicity.labelled_texts(docs, _table(spark, sf_dir, "labels")))
    out = toxicity.clean(docs, judge)
    del judge  # it has been sent; the driver needs the room for the stages that follow
    give_back()
    return out


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in an earlier document, or earlier in the same one, go, also those within an edit or a word; a document of which nothing is left stays, empty."""
    return line_dedup.clean(docs, words=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays: that of the smallest doc_id."""
    return minhash.clean(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of sequences of at most 1024 ids."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", toxic), ("line dedup", lines), ("near dedup", near), ("decontamination", benchmark), ("packing", pack)]

#: SQL can't express the classifier, the token ids or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = fresh_path(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
