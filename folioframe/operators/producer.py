"""From a provider's results to evidence documents: pages, settings, images, evidence rows, outcomes.

results is a table (doc, page_seq, pruned, markdown_text, images): pruned is the provider's page as JSON, images a map of
sources to URLs, data URLs or base64. Everything stays a DataFrame; a document is one nested row only in `evidence`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import image_format, redact_remote, rstrip_lines, safe_path
from ..sources.evidence import merged_images, provider_blocks
from .evidence import document_id, rewrite_images

SCHEMA = "folioframe/evidence/v1"
#: Suffixes of image formats.
SUFFIXES = {"jpeg": "jpg", "png": "png", "gif": "gif", "bmp": "bmp", "tiff": "tiff", "webp": "webp"}


def page_table(results: DataFrame, column: str = "pruned") -> DataFrame:
    """doc, page_seq, width, height, boxes, preprocessed, settings (JSON, null if empty), markdown_text, images, raw (the page if it is one)."""
    get = lambda path: F.get_json_object(F.col(column), f"$.{path}")
    boxes = F.coalesce(F.json_array_length(get("layout_det_res.boxes")), F.lit(0))
    settings = get("model_settings")
    return results.select(
        "doc", "page_seq", get("width").try_cast("int").alias("width"), get("height").try_cast("int").alias("height"), boxes.alias("boxes"),
        F.coalesce(get("model_settings.use_doc_preprocessor") == "true", F.lit(False)).alias("preprocessed"),
        F.when(F.size(F.json_object_keys(settings)) > 0, settings).alias("settings"), F.coalesce("markdown_text", F.lit("")).alias("markdown_text"), "images",
        F.when(F.size(F.json_object_keys(column)) > 0, F.col(column)).alias("raw"),
    )


def model_settings(pages: DataFrame) -> DataFrame:
    """doc, settings: those of the first page that has any."""
    return pages.filter("settings is not null").groupBy("doc").agg(F.min_by("settings", "page_seq").alias("settings"))


def markdown(pages: DataFrame) -> DataFrame:
    """doc, pages, markdown: the pages' texts in order, without white space at the ends of lines (it hides block formulas from renderers)."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_seq", "markdown_text"))), lambda p: p["markdown_text"]), "\n")
    return pages.groupBy("doc").agg(F.count("*").alias("pages"), joined.alias("markdown")).withColumn("markdown", rstrip_lines(F.col("markdown")))


def image_bytes(payload: Column) -> Column:
    """The bytes of a data URL or of base64, padded where it is cut short; null of what is remote or can't be read."""
    bare = F.btrim(payload, F.lit(" \t\r\n"))
    data = F.when(F.startswith(F.lower(bare), F.lit("data:")) & F.contains(bare, F.lit(",")), F.regexp_replace(bare, r"^[^,]*,", "")).otherwise(bare)
    compact = F.regexp_replace(data, r"(?U)\s+", "")
    padded = F.concat(compact, F.repeat(F.lit("="), F.pmod(-F.length(compact), F.lit(4))))
    return F.when(~is_remote(bare), F.try_to_binary(padded, F.lit("base64")))


def is_remote(value: Column) -> Column:
    return F.lower(value).rlike("^https?://")


def image_records(images: DataFrame, folder: str = "media", keep: bool = True) -> DataFrame:
    """(doc, src, value) -> a record for each image: doc, src, kind, state (saved, missing, remote), file, format, bytes, sha256, detail, content.

    An image whose header is known is saved under its safe name with the suffix that the header asks for; file is never the
    name of what isn't there. Remote images are the data source's job and count as missing here; without keep all stay remote.
    """
    own = images.select("doc", "src", F.col("value"), image_bytes(F.col("value")).alias("content"), safe_path(F.regexp_replace("src", r"^[/\\]+", "")).alias("name"))
    own = own.withColumn("format", image_format(F.hex(F.substring("content", 1, 16))))
    suffix = F.element_at(F.create_map(*[F.lit(x) for kv in SUFFIXES.items() for x in kv]), F.col("format"))
    stem = F.regexp_replace("name", r"(?<=[^/.])\.[^./]*$", "")
    has = F.lower(F.regexp_extract("name", r"(?<=[^/.])\.([^./]*)$", 1))
    saved = F.lit(keep) & (F.col("name") != "") & F.col("format").isNotNull()
    state = F.when(F.col("name") == "", "missing").when(F.lit(not keep), "remote").when(saved, "saved").otherwise("missing")
    detail = F.when(F.col("name") == "", "invalid name").when(F.lit(keep) & F.col("content").isNull(), F.when(is_remote(F.col("value")), "not fetched").otherwise("not decodable")).when(F.lit(keep) & F.col("format").isNull(), "not an image")
    file = F.concat(F.lit(folder + "/"), F.when(has == suffix, F.col("name")).otherwise(F.concat(stem, F.lit("."), suffix)))
    only = lambda c: F.when(saved, c)
    return own.select(
        "doc", "src", F.when(is_remote(F.col("value")), "url").otherwise("inline").alias("kind"), state.alias("state"), only(file).alias("file"), only(F.col("format")).alias("format"),
        only(F.octet_length("content").cast("long")).alias("bytes"), only(F.sha2("content", 256)).alias("sha256"), detail.alias("detail"), only(F.col("content")).alias("content"),
    )


def broken_images(markdown_table: DataFrame, mapping: DataFrame) -> DataFrame:
    """(doc, content) and (doc, src) that are known -> doc, src of the remote image sources that aren't, with repeats."""
    found = markdown_table.select("doc", F.explode(F.regexp_extract_all("content", F.lit(r'<img[^>]*?src="([^"]+)"'), F.lit(1))).alias("src")).filter(is_remote(F.col("src")))
    return found.join(mapping.select("doc", "src").distinct(), ["doc", "src"], "left_anti")


def content_hash(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc, content_hash: page order and size, block order, ids, labels and hashes, and the pages' texts. A null prints as None."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    line = F.concat(F.lit("B"), F.col("sequence_index"), F.lit("|"), blank("provider_block_id"), F.lit("|"), F.col("label"), F.lit("|"), F.sha2("content", 256), F.lit("\n"))
    own = blocks.groupBy("doc", "page_seq").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sequence_index", line.alias("line")))), lambda x: x["line"]), "").alias("lines"))
    head = F.concat(F.lit("P"), F.col("page_seq"), F.lit("|"), blank("width"), F.lit("x"), blank("height"), F.lit("\n"))
    text = F.concat(head, F.coalesce("lines", F.lit("")), F.col("markdown_text"), F.lit("\n"))
    joined = pages.join(own, ["doc", "page_seq"], "left").select("doc", "page_seq", text.alias("text"))
    return joined.groupBy("doc").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_seq", "text"))), lambda x: x["text"]), ""), 256).alias("content_hash"))


def evidence(results: DataFrame, sources: DataFrame, settings: dict, raw_mode: str = "page") -> DataFrame:
    """One nested row per document: schema_version, document_id, identity, producer, source, page_count, block_count, content_hash, pages.

    sources: doc, filename, sha256, size_bytes. settings: what the producer was told; its hash is part of the identity.
    """
    from .evidence import config_hash

    pages, blocks = page_table(results), provider_blocks(results)
    block = F.struct("block_ref", "provider_block_id", "provider_block_order", "sequence_index", "label", "content", "bbox", F.sha2("content", 256).alias("content_sha256"))
    own = blocks.groupBy("doc", "page_seq").agg(F.transform(F.array_sort(F.collect_list(F.struct("sequence_index", block.alias("b")))), lambda x: x["b"]).alias("blocks"))
    joined = pages.join(own, ["doc", "page_seq"], "left")
    empty = F.array().cast(own.schema["blocks"].dataType)
    raw_ref = F.format_string("raw/page-%04d.json", "page_seq") if raw_mode != "none" else F.lit("")
    page = F.struct(
        "page_seq", F.struct(F.when(F.col("preprocessed"), "preprocessed_page").otherwise("provider_page").alias("kind"), "width", "height").alias("coordinate_space"), F.col("boxes").alias("boxes_count"),
        "markdown_text", F.transform_values("images", lambda _, v: redact_remote(v)).alias("images"), raw_ref.alias("raw_ref"), F.coalesce("blocks", empty).alias("blocks"),
    )
    in_order = lambda a, b: a["page_seq"] - b["page_seq"]  # noqa: E731  maps have no order
    nested = joined.groupBy("doc").agg(F.array_sort(F.collect_list(page), in_order).alias("pages"), F.count("*").alias("page_count"), F.sum(F.size(F.coalesce("blocks", empty))).alias("block_count"))
    out = nested.join(content_hash(pages, blocks), "doc").join(model_settings(pages), "doc", "left").join(sources, "doc")
    return out.select(
        "doc", F.lit(SCHEMA).alias("schema_version"), document_id(F.col("filename"), F.col("sha256")).alias("document_id"),
        F.struct(F.col("sha256").alias("source_sha256"), F.lit(config_hash(settings)).alias("producer_config_hash")).alias("identity"), F.struct(*[F.lit(v).alias(k) for k, v in sorted(settings.items())], "settings").alias("producer"),
        F.struct("filename", "sha256", "size_bytes").alias("source"), "page_count", "block_count", "content_hash", "pages",
    )


def convert(results: DataFrame, sources: DataFrame, done: DataFrame | None = None, keep: bool = True) -> DataFrame:
    """One outcome per source: doc, status (ok, skipped, failed), reason, markdown (images rewritten to what was saved), pages, chars, blocks, images_total, images_saved.

    Sources with evidence already (done: doc) are skipped, those whose Markdown is blank fail, those without results too.
    """
    pages = page_table(results)
    texts, images = markdown(pages), merged_images(pages)
    each = images.select("doc", F.explode("images").alias("src", "value"))
    saved = image_records(each, keep=keep).filter("state = 'saved'")
    mapping = saved.groupBy("doc").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("src", "file")))).alias("mapping"), F.count("*").alias("images_saved"))
    counts = provider_blocks(results).groupBy("doc").agg(F.count("*").alias("blocks"))
    out = sources.select("doc").join(texts, "doc", "left").join(images, "doc", "left").join(mapping, "doc", "left").join(counts, "doc", "left")
    skipped = F.lit(False)
    if done is not None:
        out, skipped = out.join(done.select("doc").distinct().withColumn("_done", F.lit(True)), "doc", "left"), F.coalesce("_done", F.lit(False))
    blank = F.coalesce(F.btrim(F.col("markdown"), F.lit(" \t\r\n")) == "", F.lit(True))
    text = F.when(F.col("mapping").isNotNull(), rewrite_images(F.col("markdown"), F.col("mapping"))).otherwise(F.col("markdown"))
    ok = ~skipped & ~blank
    number = lambda c: F.when(ok, F.coalesce(c, F.lit(0))).otherwise(0).cast("long")
    return out.select(
        "doc", F.when(skipped, "skipped").when(blank, "failed").otherwise("ok").alias("status"), F.when(skipped, "evidence_exists").when(blank, "empty_markdown").otherwise("").alias("reason"), F.when(ok, text).alias("markdown"),
        number(F.col("pages")).alias("pages"), number(F.length(text)).alias("chars"), number(F.col("blocks")).alias("blocks"), number(F.size("images")).alias("images_total"), number(F.col("images_saved")).alias("images_saved"),
    )
