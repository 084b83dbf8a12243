"""The normalized view: one row for each block, none dropped or moved; a block that fails is kept without content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, unbalanced_left_right

FORMULAS = ("display_formula", "inline_formula")


def profile(label: Column) -> Column:
    return F.when(label == "text", "text_math").when(label.isin(*FORMULAS), "formula_canonical").otherwise("preserve")


def profile_version(name: Column) -> Column:
    return F.when(name == "text_math", "text_math_v1.1").when(name == "formula_canonical", "formula_canonical_v1").otherwise("preserve_v1")


def normalized(blocks: DataFrame, text: Callable[[Column], Column] | None) -> DataFrame:
    """Adds profile, profile_version, status, normalized_content, impact, diagnostic.

    text: a column function to struct(text, error, stable), error null where it went well; None where there is no
    normalizer, which is fatal for text blocks. Only blocks of label text are given to it.
    """
    df = blocks.withColumn("profile", profile(F.col("label"))).withColumn("profile_version", profile_version(F.col("profile")))
    content = F.coalesce("content", F.lit(""))
    is_text, is_formula = F.col("profile") == "text_math", F.col("profile") == "formula_canonical"
    none = F.lit(None).cast("struct<text:string,error:string,stable:boolean>")
    df = df.withColumn("_t", F.when(is_text, text(content)) if text else none)
    got, error = F.col("_t.text"), F.col("_t.error")
    nested, split = F.coalesce(F.contains(error, F.lit("ERROR_NESTED_MATH_ENVIRONMENT")), F.lit(False)), F.coalesce(unbalanced_left_right(got), F.lit(False))
    fatal = is_text & ~nested & (F.lit(text is None) | error.isNotNull())
    preserved = is_text & ~fatal & (nested | split)
    new = F.when(fatal | (F.col("profile") == "preserve"), None).when(preserved, content).when(is_formula, strip(content)).otherwise(got)
    status = F.when(fatal, "fatal").when(preserved, "preserved").when(new.isNotNull() & (new != content), "changed").otherwise("unchanged")
    diagnostic = (
        F.when(fatal, "NORMALIZER_UNAVAILABLE" if text is None else "NORMALIZE_FATAL").when(is_text & nested, "MIXED_MATH").when(preserved, "SPLIT_LEFT_RIGHT").when(is_text & ~F.col("_t.stable"), "NOT_IDEMPOTENT")
    )
    df = df.withColumn("normalized_content", new).withColumn("status", status).withColumn("diagnostic", diagnostic)
    impact = F.when(F.col("status") == "changed", F.when(is_formula, "cosmetic_only").otherwise("substantive_changed")).otherwise(F.col("status"))
    return df.withColumn("impact", impact).drop("_t")


def summarize(view: DataFrame, keys: list[str]) -> DataFrame:
    """keys, blocks (preserved ones don't count), changed, unchanged, fatal, preserved, cosmetic, substantive, idempotence_failures."""
    count = lambda c: F.count_if(c)
    status, impact = F.col("status"), F.col("impact")
    return view.groupBy(*keys).agg(
        count(status != "preserved").alias("blocks"), count(status == "changed").alias("changed"), count(status == "unchanged").alias("unchanged"), count(status == "fatal").alias("fatal"),
        count(status == "preserved").alias("preserved"), count(impact == "cosmetic_only").alias("cosmetic"), count(impact == "substantive_changed").alias("substantive"),
        count(F.col("diagnostic").eqNullSafe("NOT_IDEMPOTENT")).alias("idempotence_failures"),
    )


def rollup(view: DataFrame) -> DataFrame:
    """Blocks and changes of each document, and of all (doc null), in one pass."""
    status = F.col("status")
    return view.rollup("doc").agg(F.count("*").alias("blocks"), F.count_if(status == "changed").alias("changed"), F.count_if(status == "fatal").alias("fatal"))


def payload(stream: DataFrame) -> DataFrame:
    """Window payload of a joined block and view: normalized_text, normalization_status, signals in fixed order."""
    first = F.col("sequence_index") == 0
    status = F.coalesce("status", F.lit("unknown"))
    text = F.when(F.col("status") == "preserved", F.coalesce("normalized_content", "content")).otherwise(F.col("normalized_content"))
    math = F.coalesce("content", F.lit("")).rlike(r"\$[^$]+\$|\\\(|\\\[")
    signals = F.array_compact(
        F.array(F.concat(F.lit("label:"), "label"), F.concat(F.lit("normalization:"), status), F.when(first, "page_start"), F.when(F.col("label").isin(*FORMULAS), "formula_block"), F.when(math, "has_math_env"))
    )
    return stream.withColumn("normalized_text", text).withColumn("normalization_status", status).withColumn("signals", signals)
