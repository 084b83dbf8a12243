"""Structural statistics of block tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

IMAGES = ("image", "chart")
FORMULAS = ("display_formula", "inline_formula", "formula_number")


def per_document(blocks: DataFrame) -> DataFrame:
    """doc, pages, blocks, labels, ordered, order_null_ratio (4 digits), images, formulas, blocks_per_page_min and _max."""
    pages = blocks.groupBy("doc", "page_seq").agg(
        F.count("*").alias("n"), F.count("provider_block_order").alias("ordered"), F.count_if(F.col("label").isin(*IMAGES)).alias("images"), F.count_if(F.col("label").isin(*FORMULAS)).alias("formulas"),
        F.collect_set("label").alias("labels"),
    )
    out = pages.groupBy("doc").agg(
        F.count("*").alias("pages"), F.sum("n").alias("blocks"), F.size(F.array_distinct(F.flatten(F.collect_list("labels")))).cast("long").alias("labels"), F.sum("ordered").alias("ordered"),
        F.sum("images").alias("images"), F.sum("formulas").alias("formulas"), F.min("n").alias("blocks_per_page_min"), F.max("n").alias("blocks_per_page_max"),
    )
    return out.withColumn("order_null_ratio", F.round((F.col("blocks") - F.col("ordered")) / F.col("blocks"), 4))


def _present(c: str) -> Column:
    return F.coalesce(F.size(c), F.lit(0)) > 0


def per_page(blocks: DataFrame, raw: DataFrame) -> DataFrame:
    """blocks with bbox and polygon (arrays), raw (doc, page_seq, raw_count) -> a row a page of either: doc, page_seq, blocks, ordered, conflicts, boxed, outlined, images, formulas, raw_count, loss.

    conflicts are known orders below the known one before them on the page. loss is raw_count less blocks, null where nothing
    raw was read. A null or empty array is no geometry.
    """
    before = F.last("provider_block_order", ignorenulls=True).over(W.partitionBy("doc", "page_seq").orderBy("sequence_index").rowsBetween(W.unboundedPreceding, -1))
    slim = blocks.select("doc", "page_seq", "sequence_index", "label", "provider_block_order", _present("bbox").alias("boxed"), _present("polygon").alias("outlined"))
    own = slim.withColumn("back", F.col("provider_block_order") < before).groupBy("doc", "page_seq").agg(
        F.count("*").alias("blocks"), F.count("provider_block_order").alias("ordered"), F.count_if("back").alias("conflicts"), F.count_if("boxed").alias("boxed"), F.count_if("outlined").alias("outlined"),
        F.count_if(F.col("label").isin(*IMAGES)).alias("images"), F.count_if(F.col("label").isin(*FORMULAS)).alias("formulas"),
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("blocks", "ordered", "conflicts", "boxed", "outlined", "images", "formulas")]
    both = own.join(raw.select("doc", "page_seq", "raw_count"), ["doc", "page_seq"], "full")
    return both.select("doc", "page_seq", *counts, "raw_count", (F.col("raw_count") - F.coalesce("blocks", F.lit(0))).alias("loss"))


def document_summary(pages: DataFrame, assets: DataFrame) -> DataFrame:
    """per_page's rows and assets (doc, state) -> a row a document of pages: counts, orders, geometry, images with their assets, what extraction lost.

    Ratios have 4 digits and are null of a document without blocks; pages without blocks count as pages. Pages are summed
    first and no list of them is gathered: the pages that lost something are per_page's rows with a loss other than 0.
    """
    total = lambda c: F.sum(c).alias(c)
    own = pages.groupBy("doc").agg(
        F.count("*").alias("pages"), total("blocks"), F.min("blocks").alias("blocks_per_page_min"), F.max("blocks").alias("blocks_per_page_max"), total("ordered"), total("conflicts"),
        F.count_if(F.col("conflicts") > 0).alias("pages_out_of_order"), total("boxed"), total("outlined"), total("images"), total("formulas"),
        F.count("raw_count").alias("raw_pages_read"), F.coalesce(F.sum("loss"), F.lit(0)).alias("loss_blocks"), F.count_if(F.col("loss") != 0).alias("pages_with_loss"),
    )
    held = assets.groupBy("doc").agg(F.count("*").alias("assets"), F.count_if(F.col("state") == "saved").alias("assets_saved"), F.count_if(F.col("state") == "missing").alias("assets_missing"))
    ratio = lambda c: F.when(F.col("blocks") > 0, F.round(c / F.col("blocks"), 4))
    out = own.join(held, "doc", "left").fillna(0, ["assets", "assets_saved", "assets_missing"])
    return out.withColumns({"order_null_ratio": ratio(F.col("blocks") - F.col("ordered")), "bbox_present_ratio": ratio(F.col("boxed")), "polygon_present_ratio": ratio(F.col("outlined"))}).drop("boxed", "outlined")


def label_histogram(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("label").agg(F.count("*").alias("n"))


def corpus_blocks(blocks: DataFrame) -> DataFrame:
    """One row: documents, blocks, least, median (cut off) and most blocks of a document."""
    per = blocks.groupBy("doc").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("documents"), F.sum("n").alias("blocks"), F.min("n").alias("blocks_min"), F.percentile("n", 0.5).cast("long").alias("blocks_median"), F.max("n").alias("blocks_max"))


def nearest_rank(values: Column, ratio: float) -> Column:
    """Of an array: the value at ratio * (n - 1), rounded half to even; 0 of none."""
    n = F.size(values)
    at = F.least(F.greatest(F.rint(F.lit(ratio) * (n - 1)).cast("int"), F.lit(0)), n - 1)
    return F.when(n > 0, F.get(F.array_sort(values), at)).otherwise(0)


def nearest_rank_of(df: DataFrame, column: str, ratios: dict[str, float]) -> DataFrame:
    """One row of nearest-rank percentiles of a column, by its value counts: only distinct values are gathered."""
    counts = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    pairs = counts.agg(F.array_sort(F.collect_list(F.struct("v", "c"))).alias("p"), F.sum("c").alias("n"))

    def at(ratio: float) -> Column:
        rank = F.rint(F.lit(ratio) * (F.col("n") - 1)).cast("long")
        step = lambda s, x: F.struct((s["seen"] + x["c"]).alias("seen"), F.when((s["seen"] <= rank) & (rank < s["seen"] + x["c"]), x["v"]).otherwise(s["found"]).alias("found"))
        return F.aggregate("p", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast(counts.schema["v"].dataType).alias("found")), step)["found"]

    return pairs.select(*[at(r).alias(name) for name, r in ratios.items()])
