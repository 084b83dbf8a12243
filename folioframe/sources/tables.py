"""Block tables from plain tables: what stands in for extracted documents where there are none.

A block table has doc, pos (0-based order in the document), page_seq, sequence_index, block_ref, label, content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

PAGE = 20  # blocks to a page


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def block_ref(page: Column, index: Column) -> Column:
    return F.format_string("p%04d:b%04d", page, index)


def placed(df: DataFrame) -> DataFrame:
    """Adds page_seq, sequence_index and block_ref to (doc, pos, ...)."""
    df = df.withColumn("page_seq", F.floor(F.col("pos") / PAGE).cast("int")).withColumn("sequence_index", (F.col("pos") % PAGE).cast("int"))
    return df.withColumn("block_ref", block_ref(F.col("page_seq"), F.col("sequence_index")))


def line_label(doc: Column, pos: Column, content: Column) -> Column:
    turn = F.pmod(doc * 31 + pos, F.lit(10))
    return (
        F.when(pos == 0, "doc_title")
        .when(F.trim(content) == "", "footer")
        .when(F.contains(content, F.lit("$")), "inline_formula")
        .when(content.rlike("^[A-Z]") & (F.length(content) < 40), "number")
        .when(turn == 0, "header")
        .when(turn == 1, "paragraph_title")
        .when(turn == 2, "image")
        .when(turn == 3, "display_formula")
        .otherwise("text")
    )


def blocks(documents: DataFrame) -> DataFrame:
    """documents (doc_id, text) -> blocks, one for each line, with provider_block_order."""
    lines = documents.select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "content"))
    lines = placed(lines).withColumn("label", line_label(F.col("doc"), F.col("pos"), F.col("content")))
    order = F.when(~F.col("label").isin("header", "doc_title", "footer"), F.col("pos") - F.when((F.col("doc") + F.col("pos")) % 17 == 0, 2).otherwise(0))
    return lines.withColumn("provider_block_order", order.cast("int"))


def turns(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> blocks, one for each turn."""
    label = F.when(F.col("role") == "system", "header").when(F.col("role") == "user", "number").otherwise("text")
    pos = F.row_number().over(W.partitionBy("conv_id").orderBy("turn")) - 1
    return placed(conversations.select(F.col("conv_id").alias("doc"), pos.alias("pos"), label.alias("label"), F.col("text").alias("content")))
