"""Nested predictions as tables: roles, boundaries, splits and what the model was not sure of, ready for reconciliation and assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .assemble import first_splits, resolve_split


def _each(predicted: DataFrame, field: str) -> DataFrame:
    """One row an entry, with its place; windows without a prediction have none."""
    return predicted.select("doc", "window_index", F.posexplode(F.col("prediction")[field]).alias("k", "e")).select("doc", "window_index", "k", "e.*")


def roles(predicted: DataFrame, members: DataFrame) -> DataFrame:
    """members with the role that their window's prediction gives them; members of windows without one, and blocks that it doesn't name, have no row."""
    return members.join(_each(predicted, "roles").select("doc", "window_index", "block_ref", "role"), ["doc", "window_index", "block_ref"])


def boundaries(predicted: DataFrame) -> DataFrame:
    """doc, window_index, left_ref, right_ref, relation."""
    return _each(predicted, "boundaries").drop("k")


def splits(predicted: DataFrame, members: DataFrame) -> DataFrame:
    """doc, window_index, split_pos, block_ref, content, anchor of every split of every window; several of one block are in their order."""
    own = members.select("doc", "window_index", "block_ref", "pos", "content")
    found = _each(predicted, "splits").join(own, ["doc", "window_index", "block_ref"])
    return found.select("doc", "window_index", F.struct("pos", "k").alias("split_pos"), "block_ref", "content", "anchor")


def resolved(split_table: DataFrame) -> DataFrame:
    """Of each block the first window's first split, with where its anchor stands."""
    return first_splits(split_table).withColumn("split", resolve_split(F.col("content"), F.col("anchor")))


def uncertain(predicted: DataFrame) -> DataFrame:
    """doc, window_index, kind, refs, reason."""
    return _each(predicted, "uncertain").drop("k")
