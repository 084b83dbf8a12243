"""Evidence tables: block hashes, reading-order checks, content hash, the sinks that never overwrite, and resumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def with_hash(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("content_sha256", F.sha2(F.coalesce("content", F.lit("")), 256))


def order_consistency(blocks: DataFrame) -> DataFrame:
    """doc, page_seq, blocks, ordered_blocks, conflicts (descents of the provider's order, where it has one), monotonic."""
    by_page = W.partitionBy("doc", "page_seq").orderBy("sequence_index")
    known = blocks.filter("provider_block_order is not null").withColumn("_before", F.lag("provider_block_order").over(by_page))
    found = known.groupBy("doc", "page_seq").agg(F.count("*").alias("ordered_blocks"), F.count_if(F.col("provider_block_order") < F.col("_before")).alias("conflicts"))
    pages = blocks.groupBy("doc", "page_seq").agg(F.count("*").alias("blocks")).join(found, ["doc", "page_seq"], "left")
    conflicts = F.coalesce("conflicts", F.lit(0))
    return pages.select("doc", "page_seq", "blocks", F.coalesce("ordered_blocks", F.lit(0)).alias("ordered_blocks"), conflicts.alias("conflicts"), (conflicts == 0).alias("monotonic"))


def content_hash(blocks: DataFrame) -> DataFrame:
    """doc, content_hash: of the pages and blocks in order; a null prints as None."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    line = F.concat(F.lit("B"), F.col("sequence_index"), F.lit("|"), blank(F.col("provider_block_order")), F.lit("|"), F.col("label"), F.lit("|"), F.col("content_sha256"), F.lit("\n"))
    head = F.when(F.col("sequence_index") == 0, F.concat(F.lit("P"), F.col("page_seq"), F.lit("|None\n"))).otherwise("")
    lines = blocks.select("doc", "pos", F.concat(head, line).alias("line"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "")
    return lines.groupBy("doc").agg(F.sha2(joined, 256).alias("content_hash"))


def config_hash(settings: dict) -> str:
    """SHA-256 of the settings as JSON with sorted keys."""
    import hashlib
    import json

    return hashlib.sha256(json.dumps(settings, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def document_id(name: Column, sha256: Column) -> Column:
    stem = F.regexp_replace(F.regexp_extract(name, r"[^/\\]+$", 0), r"\.[^.]*$", "")
    return F.concat(stem, F.lit("-"), F.left(sha256, F.lit(8)))


def unfinished(inputs: DataFrame, done: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Inputs without an output yet; all of them with force."""
    return inputs if force else inputs.join(done.select(*keys).distinct(), keys, "left_anti")


def with_skipped(inputs: DataFrame, done: DataFrame, keys: list[str], reason: str = "evidence_exists") -> DataFrame:
    """All inputs with status todo or skipped and a reason."""
    own = done.select(*keys).distinct().withColumn("_done", F.lit(True))
    out = inputs.join(own, keys, "left")
    return out.withColumn("status", F.when(F.col("_done"), "skipped").otherwise("todo")).withColumn("reason", F.when(F.col("_done"), reason)).drop("_done")


def output_conflicts(inputs: DataFrame, source: str, target: Column) -> DataFrame:
    """Targets that more than one source would write: target, sources."""
    own = inputs.select(F.col(source).alias("source"), target.alias("target"))
    return own.groupBy("target").agg(F.count_distinct("source").alias("sources")).filter("sources > 1")


def write(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Evidence is immutable: an existing table is an error unless overwrite is said."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def summary(outcomes: DataFrame) -> DataFrame:
    """One row: counts by status."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return outcomes.agg(F.count("*").alias("total"), count("ok"), count("skipped"), count("failed"))


def missing_images(markdown: DataFrame, files: DataFrame, pattern: str = r'<img[^>]*?src="([^"]*)"', group: int = 1) -> DataFrame:
    """(doc, content) and (doc, src) of what exists -> distinct (doc, src) that are remote or missing; data: sources never are."""
    found = markdown.select("doc", F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit(pattern), F.lit(group)))).alias("src"))
    found = found.filter(~F.lower("src").startswith("data:"))
    return found.join(files, ["doc", "src"], "left_anti").distinct()


IMAGE_TAG = r'(<img[^>]*?src=")([^"]+)(")'


def _pieces(content: Column) -> Column:
    """array<struct<between, head, src>>: what stands before each image tag's source, the tag's beginning, and the source; the last one has no tag."""
    heads, sources = (F.regexp_extract_all(content, F.lit(IMAGE_TAG), F.lit(k)) for k in (1, 2))
    tags = F.zip_with(heads, sources, lambda h, s: F.struct(h.alias("head"), s.alias("src")))
    return F.zip_with(F.split(content, IMAGE_TAG, -1), tags, lambda b, t: F.struct(b.alias("between"), t["head"].alias("head"), t["src"].alias("src")))


def _joined(piece: Column, new: Column) -> Column:
    """A piece with another source."""
    return F.concat(piece["between"], F.when(piece["src"].isNull(), F.lit("")).otherwise(F.concat(piece["head"], F.coalesce(new, piece["src"]), F.lit('"'))))


def rewrite_images(content: Column, mapping: Column) -> Column:
    """Each source of an image tag that the map knows becomes what the map says, once; all else stays."""
    return F.array_join(F.transform(_pieces(content), lambda p: _joined(p, F.try_element_at(mapping, p["src"]))), "")


def rewritten(texts: DataFrame, mapping: DataFrame) -> DataFrame:
    """texts (doc, content) and mapping (doc, src, file) -> texts with the sources of image tags rewritten, without a map a document.

    Texts are cut at their image tags; the tags' sources are joined with the mapping by document and source, so that a document
    of many images, or a mapping of many entries, is many keys; the pieces are put together in their order. Of a source that
    is mapped twice the smaller file counts. Null contents stay null, docs must come once; rows of a null doc are not mapped.
    """
    pieces = texts.select("doc", F.posexplode(_pieces(F.col("content"))).alias("k", "p"))
    known = mapping.groupBy("doc", F.col("src").alias("_src")).agg(F.min("file").alias("_file"))
    found = pieces.withColumn("_src", F.col("p.src")).join(known, ["doc", "_src"], "left").select("doc", "k", _joined(F.col("p"), F.col("_file")).alias("text"))
    whole = found.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "").alias("_new"))
    same = texts.withColumn("_doc", F.col("doc"))
    out = same.join(whole.withColumnRenamed("doc", "_other"), F.col("_doc").eqNullSafe(F.col("_other")), "left").withColumn("content", F.when(F.col("content").isNotNull(), F.col("_new")))
    return out.drop("_doc", "_other", "_new")
