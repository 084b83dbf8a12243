"""Readers of evidence documents, views, provider results and Markdown; the evidence projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import redact_remote

BLOCK = "block_ref STRING, provider_block_id INT, provider_block_order INT, sequence_index INT, label STRING, content STRING, bbox ARRAY<DOUBLE>, polygon ARRAY<ARRAY<DOUBLE>>, group_id INT, content_sha256 STRING"
EVIDENCE = f"schema_version STRING, document_id STRING, page_count INT, block_count INT, content_hash STRING, pages ARRAY<STRUCT<page_seq: INT, markdown_text: STRING, images: MAP<STRING, STRING>, blocks: ARRAY<STRUCT<{BLOCK.replace(' STRING', ': STRING').replace(' INT', ': INT').replace(' ARRAY<', ': ARRAY<')}>>>>"
VIEW = "schema_version STRING, document_id STRING, evidence_hash STRING, blocks ARRAY<STRUCT<block_ref: STRING, label: STRING, profile: STRING, profile_version: STRING, status: STRING, normalized_content: STRING>>"
# fixed values: the names that a provider's fields go by
BLOCK_LISTS = ("parsing_res_list", "parsingResList", "blocks")


def read_evidence(spark: SparkSession, root: str) -> DataFrame:
    """Evidence in both layouts (<stem>.evidence.json, <stem>_prework/evidence.json), with its path."""
    df = spark.read.schema(EVIDENCE).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*evidence.json").json(root)
    return df.withColumn("path", F.col("_metadata.file_path"))


def read_views(spark: SparkSession, root: str) -> DataFrame:
    df = spark.read.schema(VIEW).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*normalized*.json").json(root)
    return df.select("document_id", F.explode("blocks").alias("v")).select("document_id", "v.*")


def flatten(evidence: DataFrame) -> DataFrame:
    """One row per block with its document, page and pos in reading order."""
    pages = evidence.select(F.col("document_id").alias("doc"), F.explode("pages").alias("p"))
    rows = pages.select("doc", F.col("p.page_seq").alias("page_seq"), F.explode("p.blocks").alias("b")).select("doc", "page_seq", "b.*")
    from pyspark.sql.window import Window as W

    order = W.partitionBy("doc").orderBy("page_seq", "sequence_index")
    return rows.withColumn("pos", F.row_number().over(order) - 1).withColumn("page_start", F.row_number().over(W.partitionBy("doc", "page_seq").orderBy("sequence_index")) == 1)


def with_view(blocks: DataFrame, view: DataFrame) -> DataFrame:
    """Blocks with what their view says; all blocks stay."""
    own = view.select(F.col("document_id").alias("doc"), "block_ref", "status", "normalized_content")
    return blocks.join(own, ["doc", "block_ref"], "left")


def provider_blocks(results: DataFrame, column: str = "pruned") -> DataFrame:
    """results (doc, page_seq, pruned JSON) -> blocks: the first list under a known name; of each field the first name that is present, of label and content the first that isn't empty."""
    get = lambda *names: [F.get_json_object(F.col("item"), f"$.{n}") for n in names]
    lists = F.coalesce(*[F.get_json_object(F.col(column), f"$.{n}") for n in BLOCK_LISTS])
    items = results.select("doc", "page_seq", F.posexplode_outer(F.from_json(lists, "array<string>")).alias("sequence_index", "item")).filter("item like '{%'")
    full = lambda c: F.when(c != "", c)
    return items.select(
        "doc", "page_seq", "sequence_index", F.format_string("p%04d:b%04d", "page_seq", "sequence_index").alias("block_ref"),
        F.coalesce(*[x.try_cast("int") for x in get("block_id", "blockId", "id")]).alias("provider_block_id"),
        F.coalesce(*[x.try_cast("int") for x in get("block_order", "blockOrder", "order", "reading_order")]).alias("provider_block_order"),
        F.coalesce(*[full(x) for x in get("block_label", "blockLabel", "label")], F.lit("")).alias("label"),
        F.coalesce(*[full(x) for x in get("block_content", "blockContent", "content")], F.lit("")).alias("content"),
        F.from_json(F.coalesce(*get("block_bbox", "blockBbox", "bbox")), "array<double>").alias("bbox"),
    )


def envelope_keys(lines: DataFrame, column: str = "value") -> DataFrame:
    """Sorted distinct keys of JSON lines, and those of their result as result.<key>: one row."""
    top = F.coalesce(F.json_object_keys(column), F.array().cast("array<string>"))
    inner = F.coalesce(F.transform(F.json_object_keys(F.get_json_object(column, "$.result")), lambda k: F.concat(F.lit("result."), k)), F.array().cast("array<string>"))
    return lines.select(F.explode(F.concat(top, inner)).alias("k")).agg(F.array_sort(F.collect_set("k")).alias("keys"))


def redacted_images(images: Column) -> Column:
    """A map of images without clickable or embedded values."""
    return F.transform_values(images, lambda _, v: redact_remote(v))


def merged_images(pages: DataFrame) -> DataFrame:
    """(doc, page_seq, images) -> doc, images: of a source on several pages the last page's value."""
    each = pages.select("doc", "page_seq", F.explode("images").alias("src", "url"))
    last = each.groupBy("doc", "src").agg(F.max_by("url", "page_seq").alias("url"))
    return last.groupBy("doc").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("src", "url")))).alias("images"))


def read_markdown(spark: SparkSession, root: str) -> DataFrame:
    """path, has_bom, text of .md files."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(root)
    bom = F.hex(F.substring("content", 1, 3)) == "EFBBBF"
    body = F.when(bom, F.expr("substring(content, 4)")).otherwise(F.col("content"))
    return raw.select("path", bom.alias("has_bom"), F.decode(body, "UTF-8").alias("text"))


def read_raw_pages(spark: SparkSession, root: str) -> DataFrame:
    """doc, number, text of <doc>/.../page-<number>.json below root; the document is the folder next to the file, or the one above it if that is called raw."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "page-*.json").option("recursiveFileLookup", True).load(root)
    parts = F.split(F.regexp_replace("path", r"/raw/(?=[^/]*$)", "/"), "/")
    number = F.regexp_extract("path", r"page-(\d{1,9})\.json$", 1).try_cast("int")
    return files.select(F.element_at(parts, -2).alias("doc"), number.alias("number"), F.decode("content", "UTF-8").alias("text")).filter("number is not null")
