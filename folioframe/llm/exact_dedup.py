"""Exact deduplication: two Bloom passes find the hashes that may repeat; only their rows shuffle.

Pass 1 counts, in a filter of two-state cells ("once", "more than once"), the distinct-row hits of each cell. Pass 2
tests each row: if any of its cells was hit only once its text is unique and the row passes straight through.
The remaining rows (all repeats, and the filter's false positives) are grouped by the SHA-256 of the text, so the
result is exact whatever the filter says.

The cells with more than one hit are a bitmap of at most MAX_CELLS / 8 bytes, whatever the corpus: beyond about
MAX_CELLS / 16 rows the filter fills up, and more rows (ids and hashes, never texts) shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of, spool

MAX_CELLS = 1 << 28  # 32 MiB of bits
CELLS_PER_ROW = 16
BROADCAST_GROUPS = 100_000  # about 100 bytes each


def _cells(n_cells: int) -> list:
    h = F.xxhash64("text_sha256")
    return [F.pmod(h, F.lit(n_cells)), F.pmod(F.shiftright(h, 29).bitwiseXOR(h * 0 + F.hash("text_sha256")), F.lit(n_cells))]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as the empty text. Of equal texts the row with the largest doc_id
    stays. Null doc_ids rank lowest (keep_id is null only if all ids of the group are); of several rows with the
    kept id all are marked kept. Empty tables give no rows. Further columns of docs are ignored.
    """
    base = spool(rows_of(docs, id_col, text_col).select("doc_id", F.sha2("text", 256).alias("text_sha256")), "hashes")
    n_cells = 1 << 15
    while n_cells < min(max_cells, CELLS_PER_ROW * base.count()):
        n_cells *= 2

    # pass 1: which cells are hit more than once
    hits = base.select(F.explode(F.array(*_cells(n_cells))).alias("cell")).groupBy("cell").count().filter("count > 1")
    bits = spool(
        hits.groupBy((F.col("cell") / 32768).cast("long").alias("page")).agg(F.bitmap_construct_agg((F.col("cell") % 32768)).alias("bits")),
        "bloom",
    )

    # pass 2: a row may repeat only if all its cells were; the bitmap is at most max_cells / 8 bytes
    maybe, flagged = F.lit(True), base
    for k, cell in enumerate(_cells(n_cells)):
        page = F.broadcast(bits.select(F.col("page").alias(f"page{k}"), F.col("bits").alias(f"bits{k}")))
        flagged = flagged.withColumn(f"cell{k}", cell)
        flagged = flagged.join(page, (F.col(f"cell{k}") / 32768).cast("long") == F.col(f"page{k}"), "left")
        at = F.col(f"cell{k}") % 32768
        byte = F.conv(F.hex(F.substring(f"bits{k}", 1, 4096).substr((at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        maybe = maybe & (F.coalesce(F.shiftrightunsigned(byte, 0).bitwiseAND(F.expr(f"shiftleft(1, cast(cell{k} % 8 as int))")), F.lit(0)) != 0)
    flagged = flagged.select("doc_id", "text_sha256", maybe.alias("maybe"))

    once = flagged.filter(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    again = flagged.filter("maybe").select("doc_id", "text_sha256")
    groups = spool(again.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"), "groups")
    if groups.count() <= BROADCAST_GROUPS:  # else a join whose hot keys Spark can split
        groups = F.broadcast(groups)
    found = F.col("group_size").isNotNull()
    rest = again.join(groups, "text_sha256", "left").select(
        "doc_id", F.when(found, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (~found | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256",
    )
    return once.unionByName(rest)
