"""Candidates from decided blocks: gaps and islands instead of a fold; references, never copies of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def _by_pos():
    return W.partitionBy("doc").orderBy("pos")


def question_number(text: Column) -> Column:
    """struct(number, numbering_system) of the first 40 characters, or null."""
    head = F.left(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", ""), F.lit(40))
    arabic = F.regexp_extract(head, r"(?U)^\s*(\d{1,3})\s*[.、]\s*", 1)
    chinese = F.regexp_extract(head, r"(?U)^\s*([一二三四五六七八九十]{1,3})\s*[、.]\s*", 1)
    pair = lambda n, system: F.struct(n.alias("number"), F.lit(system).alias("numbering_system"))
    return F.when(arabic != "", pair(arabic, "arabic")).when(chinese != "", pair(chinese, "chinese"))


def resolve_split(text: Column, anchor: Column) -> Column:
    """struct(status, start, end): resolved only if the anchor stands in the text exactly once (overlaps count)."""
    text, anchor = F.coalesce(text, F.lit("")), F.coalesce(anchor, F.lit(""))
    first = F.locate(anchor, text) if isinstance(anchor, str) else F.call_function("locate", anchor, text)
    again = F.call_function("locate", anchor, text, first + 1)
    none = F.lit(None).cast("int")
    status = F.when(anchor == "", "missing_anchor").when(first == 0, "not_found").when(again > 0, "ambiguous").otherwise("resolved")
    return F.struct(status.alias("status"), F.when(status == "resolved", first - 1).otherwise(none).alias("start"), F.when(status == "resolved", first - 1 + F.length(anchor)).otherwise(none).alias("end"))


def decided(stream: DataFrame, role_table: DataFrame) -> DataFrame:
    """stream with its role; blocks without a decision are UNCERTAIN."""
    own = role_table.select("doc", "block_ref", "role")
    return stream.join(own, ["doc", "block_ref"], "left").withColumn("role", F.coalesce("role", F.lit("UNCERTAIN")))


def assigned(blocks: DataFrame, compat: bool = False) -> DataFrame:
    """Adds candidate (1-based, of the document; 0: none) and fate.

    fate: statement, solution, shared, excluded:<reason>, or diagnostic:<name>. A shared block goes to the next start. One
    without a next start is excluded as dangling_shared_context; with compat it is lost.
    """
    start = F.col("role") == "PROBLEM_START"
    number = F.sum(start.cast("int")).over(_by_pos().rowsBetween(W.unboundedPreceding, 0))
    following = F.min(F.when(start, F.col("_number"))).over(_by_pos().rowsBetween(1, W.unboundedFollowing))
    df = blocks.withColumn("_number", number)
    df = df.withColumn("candidate", F.when(F.col("role") == "SHARED_CONTEXT", F.coalesce(following, F.lit(0))).otherwise(F.col("_number")).cast("int"))
    none = F.col("candidate") == 0
    role = F.col("role")
    fate = (
        F.when(role == "SHARED_CONTEXT", F.when(~none, "shared").otherwise("lost" if compat else "excluded:dangling_shared_context"))
        .when(role == "PROBLEM_START", "statement")
        .when(role == "PROBLEM_CONTINUATION", F.when(none, "diagnostic:orphan_continuation").otherwise("statement"))
        .when(role.isin("SOLUTION_START", "SOLUTION_CONTINUATION"), F.when(none, "diagnostic:orphan_solution").otherwise("solution"))
        .when(role == "UNCERTAIN", "excluded:uncertain_role")
        .otherwise(F.concat(F.lit("excluded:excluded_role:"), role))
    )
    return df.withColumn("fate", fate).drop("_number")


def excluded(assigned_: DataFrame) -> DataFrame:
    return assigned_.filter(F.startswith("fate", F.lit("excluded:"))).select("doc", "pos", "block_ref", F.substring("fate", 10, 1000).alias("reason"))


def diagnostics(assigned_: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """doc, block_ref, diagnostic. Uncertain roles are diagnosed as well as excluded; so are splits that don't resolve, or that would cut nothing off."""
    own = F.when(F.startswith("fate", F.lit("diagnostic:")), F.substring("fate", 12, 1000)).when(F.col("fate") == "excluded:uncertain_role", "uncertain_role")
    out = assigned_.select("doc", "block_ref", own.alias("diagnostic")).filter("diagnostic is not null")
    if splits is not None:
        bad = F.when(F.col("split.status") != "resolved", F.concat(F.lit("unresolved_split:"), F.col("split.status"))).when(F.col("split.start") == 0, "split_at_block_start")
        out = out.unionByName(splits.select("doc", "block_ref", bad.alias("diagnostic")).filter("diagnostic is not null"))
    return out


def first_splits(splits: DataFrame) -> DataFrame:
    """splits (doc, window_index, split_pos, block_ref, anchor): of each block the first anchor, in window order."""
    order = W.partitionBy("doc", "block_ref").orderBy("window_index", "split_pos")
    return splits.withColumn("_k", F.row_number().over(order)).filter("_k = 1").drop("_k")


def candidate_refs(assigned_: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """doc, candidate_number, kind (statement, solution, shared), pos, block_ref, start, end (exclusive).

    splits: (doc, block_ref, window_index, split_pos, split) resolved. A resolved split inside a statement block gives its
    tail and what follows to a new candidate; new ones are numbered after all others, in the order of the splits, and get
    the solutions of the one that they were split from.
    """
    refs = assigned_.filter("fate in ('statement', 'solution', 'shared')").select("doc", "candidate", F.col("fate").alias("kind"), "pos", "block_ref", F.lit(0).alias("start"), F.length(F.coalesce("content", F.lit(""))).alias("end"))
    if splits is None:
        return refs.withColumnRenamed("candidate", "candidate_number")
    cuts = splits.filter("split.status = 'resolved' and split.start > 0").select("doc", "block_ref", F.col("split.start").alias("cut"), "window_index", "split_pos")
    joined = refs.join(cuts, ["doc", "block_ref"], "left")
    is_cut = (F.col("kind") == "statement") & F.col("cut").isNotNull()
    joined = joined.withColumn("cut", F.when(is_cut, F.col("cut")))
    # the tails' numbers: after all starts
    starts = assigned_.groupBy("doc").agg(F.max("candidate").alias("starts"))
    order = W.partitionBy("doc").orderBy("window_index", "split_pos")
    made = joined.filter("cut is not null").select("doc", "candidate", "pos", F.row_number().over(order).alias("_nth"))
    made = made.join(starts, "doc").select("doc", "candidate", F.col("pos").alias("cut_pos"), (F.col("starts") + F.col("_nth")).alias("new_number"))
    # halves of cut blocks
    halves = F.when(F.col("cut").isNotNull(), F.array(F.struct("start", F.col("cut").alias("end"), F.lit(False).alias("tail")), F.struct(F.col("cut").alias("start"), "end", F.lit(True).alias("tail")))).otherwise(
        F.array(F.struct("start", "end", F.lit(False).alias("tail")))
    )
    pieces = joined.select("doc", "candidate", "kind", "pos", "block_ref", F.explode(halves).alias("h")).select("doc", "candidate", "kind", "pos", "block_ref", "h.start", "h.end", "h.tail")
    # a statement piece belongs to the last cut at or before it
    held = pieces.filter("kind = 'statement'").join(made, ["doc", "candidate"], "left")
    before = F.when((F.col("cut_pos") < F.col("pos")) | ((F.col("cut_pos") == F.col("pos")) & F.col("tail")), F.struct("cut_pos", "new_number"))
    statement = held.groupBy("doc", "candidate", "kind", "pos", "block_ref", "start", "end").agg(F.max(before)["new_number"].alias("_new"))
    statement = statement.select("doc", F.coalesce("_new", "candidate").alias("candidate_number"), "kind", "pos", "block_ref", "start", "end")
    rest = pieces.filter("kind <> 'statement'").drop("tail").withColumnRenamed("candidate", "candidate_number")
    copied = pieces.filter("kind = 'solution'").join(made, ["doc", "candidate"]).select("doc", F.col("new_number").alias("candidate_number"), "kind", "pos", "block_ref", "start", "end")
    return statement.unionByName(rest.select(statement.columns)).unionByName(copied)


def candidates(refs: DataFrame, assigned_: DataFrame) -> DataFrame:
    """doc, candidate_id, statement_refs, solution_refs, shared_refs (arrays in document order) and number."""
    item = F.struct("pos", "start", "block_ref", "end")
    of = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, item))), lambda x: F.struct(x["block_ref"].alias("block_ref"), x["start"].alias("start"), x["end"].alias("end")))
    out = refs.groupBy("doc", "candidate_number").agg(of("statement").alias("statement_refs"), of("solution").alias("solution_refs"), F.transform(of("shared"), lambda x: x["block_ref"]).alias("shared_refs"))
    number = assigned_.filter("role = 'PROBLEM_START'").select("doc", F.col("candidate").alias("candidate_number"), question_number(F.col("content")).alias("number"))
    out = out.join(number, ["doc", "candidate_number"], "left")
    return out.select("doc", "candidate_number", F.format_string("pc%04d", "candidate_number").alias("candidate_id"), "statement_refs", "solution_refs", "shared_refs", "number")
