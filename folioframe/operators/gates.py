"""Quality gates: nothing is silently lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coverage(stream: DataFrame, members: DataFrame) -> DataFrame:
    """doc, coverage_complete: every block is in a window."""
    own, held = stream.select("doc", "block_ref").distinct(), members.select("doc", "block_ref").distinct()
    missing = own.join(held, ["doc", "block_ref"], "left_anti").groupBy("doc").agg(F.count("*").alias("missing"))
    return own.select("doc").distinct().join(missing, "doc", "left").select("doc", F.coalesce("missing", F.lit(0)).alias("missing"), F.col("missing").isNull().alias("coverage_complete"))


def decided(stream: DataFrame, role_table: DataFrame) -> DataFrame:
    return stream.select("doc", "block_ref").join(role_table.select("doc", "block_ref"), ["doc", "block_ref"], "left_semi").groupBy("doc").agg(F.count("*").alias("blocks_decided"))


def silent_loss(stream: DataFrame, refs: DataFrame, excluded: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Blocks that no candidate refers to and that are neither excluded nor diagnosed."""
    accounted = refs.select("doc", "block_ref").union(excluded.select("doc", "block_ref")).union(diagnostics.select("doc", "block_ref"))
    return stream.select("doc", "block_ref").join(accounted, ["doc", "block_ref"], "left_anti")


def extraction_loss(blocks: DataFrame, raw: DataFrame) -> DataFrame:
    """raw (doc, page_seq, raw_count) against the blocks of each page: doc, loss, pages_differing. Pages without a raw count don't count."""
    own = blocks.groupBy("doc", "page_seq").agg(F.count("*").alias("n"))
    loss = F.col("raw_count") - F.coalesce("n", F.lit(0))
    joined = raw.filter("raw_count is not null").join(own, ["doc", "page_seq"], "left").withColumn("loss", loss)
    return joined.groupBy("doc").agg(F.sum("loss").alias("loss"), F.count_if(F.col("loss") != 0).alias("pages_differing"))


def raw_counts(pages: DataFrame, raw: DataFrame) -> DataFrame:
    """pages (doc, page_seq) and the raw pages kept of them (doc, number, text as JSON) -> doc, page_seq, raw_count.

    A page's raw file is the one of its own number, or else the next one's (files may be numbered from 0 or from 1): also
    where the first holds no block list, but not where it is no JSON, which makes the count null at once. The list is
    parsing_res_list, at the top or in pruned_result; an empty one counts 0. A number that is kept twice counts as the file
    whose text is smaller.
    """
    own = pages.select("doc", "page_seq").distinct()
    kept = raw.groupBy("doc", "number").agg(F.min("text").alias("text"))
    held = lambda path: F.json_array_length(F.get_json_object("text", path)).cast("long")
    kept = kept.select("doc", "number", F.struct(F.try_parse_json("text").isNotNull().alias("is_json"), F.coalesce(held("$.parsing_res_list"), held("$.pruned_result.parsing_res_list")).alias("n")).alias("file"))
    keys = own.select("doc", "page_seq", F.explode(F.array(F.col("page_seq"), F.col("page_seq") + 1)).alias("number"))
    first, second = (F.max(F.when(F.col("number") == F.col("page_seq") + k, F.col("file"))) for k in (0, 1))
    found = keys.join(kept, ["doc", "number"]).groupBy("doc", "page_seq").agg(first.alias("a"), second.alias("b"))
    count = F.when(F.col("a").isNotNull() & ~F.col("a.is_json"), F.lit(None)).otherwise(F.coalesce("a.n", "b.n"))
    return own.join(found.select("doc", "page_seq", count.alias("raw_count")), ["doc", "page_seq"], "left")
