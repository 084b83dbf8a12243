"""What a provider's results hold: structure statistics, envelope statistics, image kinds, the capability report, fixtures."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .structure import BLOCK_FIELDS, BLOCK_LISTS, _arrow, desensitize

#: Fields that show that a wrapper hands blocks on.
STRUCTURED = ("blocks", "parsing_res_list", "pages_structured")
NONE = "array<string>"


def resource_kind(value: Column) -> Column:
    bare = F.lower(F.btrim(value, F.lit(" \t\r\n")))
    return F.when(F.startswith(bare, F.lit("data:")), "data_url").when(bare.rlike(r"^[a-z][a-z0-9+.\-]*://"), "url").otherwise("opaque")


def image_pages(pages: DataFrame) -> DataFrame:
    """doc, page_seq, images, kinds (sorted) of the pages that have any."""
    kinds = F.array_sort(F.array_distinct(F.transform(F.map_values("images"), resource_kind)))
    return pages.filter(F.size("images") > 0).select("doc", "page_seq", F.size("images").alias("images"), kinds.alias("kinds"))


def block_items(pages: DataFrame, column: str = "pruned") -> DataFrame:
    """doc, page_seq, place, item (JSON) of every block that is an object."""
    lists = F.coalesce(*[F.get_json_object(F.col(column), f"$.{n}") for n in BLOCK_LISTS])
    return pages.select("doc", "page_seq", F.posexplode(F.from_json(lists, NONE)).alias("place", "item")).filter("item like '{%'")


def structure_stats(pages: DataFrame, column: str = "pruned") -> DataFrame:
    """doc, blocks, block_keys, orders, orders_known, order_null_ratio (4 digits; null without orders), has_group, has_polygon, boxes, image_kinds, labels (an array of (n, label), most first) and a has_<field> for each block field."""
    keys = F.json_object_keys("item")
    has = lambda names: F.arrays_overlap(F.col("keys"), F.array(*[F.lit(n) for n in names]))
    order = F.coalesce(*[F.get_json_object("item", f"$.{n}") for n in ("block_order", "blockOrder", "order")])
    items = block_items(pages, column).withColumn("keys", keys).withColumn("order", order)
    label = F.coalesce(*[F.when(x != "", x) for x in (F.get_json_object("item", "$.block_label"), F.get_json_object("item", "$.label"))])
    # grouped by label first, so that a document's blocks are never gathered
    part = items.groupBy("doc", label.alias("label")).agg(
        F.count("*").alias("n"), F.flatten(F.collect_set("keys")).alias("keys"), F.count_if(has(("block_order", "blockOrder", "order"))).alias("orders"), F.count("order").alias("known"),
    )
    labels = F.transform(F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct((-F.col("n")).alias("n"), "label")))), lambda x: F.struct((-x["n"]).alias("n"), x["label"].alias("label")))
    found = part.groupBy("doc").agg(F.sum("n").alias("blocks"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("keys"), F.sum("orders").alias("orders"), F.sum("known").alias("orders_known"), labels.alias("labels"))
    per = pages.groupBy("doc").agg(
        F.sum(F.coalesce(F.json_array_length(F.get_json_object(column, "$.layout_det_res.boxes")), F.lit(0))).alias("boxes"), F.count("*").alias("pages"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.transform(F.map_values("images"), resource_kind))))).alias("image_kinds"),
    )
    out = per.join(found, "doc", "left")
    ratio = F.when(F.col("orders") > 0, F.round(1 - F.col("orders_known") / F.col("orders"), 4))
    known = F.coalesce("keys", F.array().cast(NONE))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.withColumn("keys", known).select(
        "doc", "pages", zero("blocks"), F.col("keys").alias("block_keys"), zero("orders"), zero("orders_known"), ratio.alias("order_null_ratio"), has(("group_id", "groupId")).alias("has_group"), has(("block_polygon_points", "polygon_points")).alias("has_polygon"),
        "boxes", "image_kinds", F.coalesce("labels", F.array().cast(found.schema["labels"].dataType)).alias("labels"), *[has(names).alias(f"has_{field}") for field, names in BLOCK_FIELDS.items()],
    )


def gap(fields: list[str], has_blocks: Column) -> Column:
    """C where the wrapper hands blocks on, B where only the provider has them, else A."""
    return F.lit("C") if set(fields) & set(STRUCTURED) else F.when(has_blocks, "B").otherwise("A")


def wrapper_fields(df: DataFrame) -> list[str]:
    return df.schema.fieldNames()


def report(pages: DataFrame, fields: list[str], column: str = "pruned") -> DataFrame:
    """A capability row per document: structure_stats, markdown and images of the first page, gap."""
    first = pages.groupBy("doc").agg(F.min_by(F.struct(F.coalesce("markdown_text", F.lit("")).alias("markdown"), F.col(column).alias("pruned")), "page_seq").alias("p"), F.max(F.size("images") > 0).alias("images_mapping"))
    out = structure_stats(pages, column).join(first, "doc")
    return out.select(
        "*", (F.btrim(F.col("p.markdown"), F.lit(" \t\r\n")) != "").alias("has_markdown"), F.array_sort(F.coalesce(F.json_object_keys("p.pruned"), F.array().cast(NONE))).alias("pruned_keys"), gap(fields, F.col("blocks") > 0).alias("gap"),
    ).drop("p")


def envelope_stats(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row over JSON lines: lines, line_keys, result_keys, data_info_keys, items (of all lines), items_min, items_max. What isn't an object counts as a line only."""
    keys = lambda c: F.coalesce(F.json_object_keys(c), F.array().cast(NONE))
    result = F.get_json_object(column, "$.result")
    items = F.when(F.json_object_keys(result).isNotNull(), F.coalesce(F.json_array_length(F.get_json_object(column, "$.result.layoutParsingResults")), F.lit(0)))
    own = lines.select(keys(F.col(column)).alias("top"), keys(result).alias("result"), keys(F.get_json_object(column, "$.result.dataInfo")).alias("info"), items.alias("items"))
    sets = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))  # noqa: E731  of key sets, not of lines
    return own.agg(F.count("*").alias("lines"), sets("top").alias("line_keys"), sets("result").alias("result_keys"), sets("info").alias("data_info_keys"), F.sum("items").alias("items"), F.min("items").alias("items_min"), F.max("items").alias("items_max"))


def fixture_page(column: Column, boxes: int = 8, longest: int = 200) -> Column:
    """A page as JSON that can be shown: the first boxes with their number beside, resources and long texts as digests, secrets gone."""

    def trimmed(page):
        layout = page.get("layout_det_res") if isinstance(page, dict) else None
        if isinstance(layout, dict) and isinstance(layout.get("boxes"), list) and len(layout["boxes"]) > boxes:
            page = page | {"layout_det_res": layout | {"boxes": layout["boxes"][:boxes], "__boxes_total__": len(layout["boxes"])}}
        return json.dumps(desensitize(page, longest), ensure_ascii=False)

    return _arrow(trimmed, "string")(column)


def fixture(pages: DataFrame, most: int = 2, boxes: int = 8, column: str = "pruned") -> DataFrame:
    """doc, page_seq, page: the first pages of each document by page_seq."""
    return pages.filter(F.col("page_seq") < most).select("doc", "page_seq", fixture_page(F.col(column), boxes).alias("page"))
