"""Overlapping windows' decisions become one for each block; what disagrees is UNCERTAIN, never outvoted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTINUATIONS = ("PROBLEM_CONTINUATION", "SOLUTION_CONTINUATION")
FORMULAS = ("display_formula", "inline_formula")


def _agreed(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    found = F.array_sort(F.collect_set(value))
    out = df.groupBy(*keys).agg(found.alias("_found"))
    return out.select(*keys, F.when(F.size("_found") == 1, F.col("_found")[0]).otherwise("UNCERTAIN").alias(value), (F.size("_found") > 1).alias("conflict"), F.array_join("_found", "|").alias("found"))


def roles(labelled: DataFrame) -> DataFrame:
    """doc, block_ref, role, conflict, found (all roles given, sorted, joined by |)."""
    return _agreed(labelled, ["doc", "block_ref"], "role")


def boundaries(pairs: DataFrame) -> DataFrame:
    return _agreed(pairs, ["doc", "left_ref", "right_ref"], "relation")


def expansion_reasons(labelled: DataFrame, role_table: DataFrame, boundary_table: DataFrame, splits: DataFrame | None = None, uncertain: DataFrame | None = None) -> DataFrame:
    """doc, window_index, window_id, reasons (array, in fixed order) of windows that should be widened.

    labelled: window members with role, label, pos. splits: (doc, window_index, block_ref). uncertain: (doc, window_index).
    """
    hit = role_table.filter("conflict").select("doc", "block_ref", F.lit(True).alias("_role_hit"))
    rows = labelled.join(hit, ["doc", "block_ref"], "left")
    if splits is None:
        rows = rows.withColumn("_split", F.lit(False))
    else:
        own = splits.select("doc", "window_index", "block_ref", F.lit(True).alias("_split")).distinct()
        rows = rows.join(own, ["doc", "window_index", "block_ref"], "left")
    signal = ((F.col("label") == "number") & F.col("role").isin("NON_PROBLEM", "SHARED_CONTEXT")) | (F.col("label").isin(*FORMULAS) & (F.col("role") == "PROBLEM_START"))
    head, tail = F.min_by(F.struct("role", "_split"), "pos"), F.max_by(F.struct("role", "_split"), "pos")
    per = rows.groupBy("doc", "window_index", "window_id").agg(
        F.max(F.coalesce("_role_hit", F.lit(False))).alias("role_hit"), F.max(signal).alias("signal"), head.alias("head"), tail.alias("tail")
    )
    # both ends of a conflicting boundary lie in a window exactly where a window has given it
    pairs = labelled.select("doc", "window_index", "block_ref")
    ends = boundary_table.filter("conflict").select("doc", "left_ref", "right_ref")
    left = pairs.join(ends.withColumnRenamed("left_ref", "block_ref"), ["doc", "block_ref"]).select("doc", "window_index", F.col("right_ref").alias("block_ref"))
    in_both = left.join(pairs, ["doc", "window_index", "block_ref"], "left_semi").select("doc", "window_index", F.lit(True).alias("boundary_hit")).distinct()
    per = per.join(in_both, ["doc", "window_index"], "left")
    if uncertain is None:
        per = per.withColumn("_uncertain", F.lit(False))
    else:
        per = per.join(uncertain.select("doc", "window_index", F.lit(True).alias("_uncertain")).distinct(), ["doc", "window_index"], "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    rules = [
        ("MODEL_UNCERTAIN", F.col("_uncertain")),
        ("OVERLAP_CONFLICT", yes(F.col("role_hit")) | yes(F.col("boundary_hit"))),
        ("EDGE_SPLIT", yes(F.col("head._split")) | yes(F.col("tail._split"))),
        ("HEAD_CONTINUATION", F.col("head.role").isin(*CONTINUATIONS)),
        ("TAIL_CONTINUATION", F.col("tail.role").isin(*CONTINUATIONS)),
        ("SIGNAL_CONFLICT", F.col("signal")),
    ]
    reasons = F.array_compact(F.array(*[F.when(yes(c), name) for name, c in rules]))
    return per.select("doc", "window_index", "window_id", reasons.alias("reasons"))


def reason_histogram(reasons: DataFrame) -> DataFrame:
    return reasons.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
