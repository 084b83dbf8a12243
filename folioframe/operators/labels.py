"""Deterministic labellers of window blocks, and the validation of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

PREDICTION_SCHEMA = "folioframe/prediction/v1"
# fixed values: the closed vocabularies of predictions
ROLES = ("PROBLEM_START", "PROBLEM_CONTINUATION", "SOLUTION_START", "SOLUTION_CONTINUATION", "SHARED_CONTEXT", "NON_PROBLEM", "UNCERTAIN")
RELATIONS = ("SAME_PROBLEM", "NEW_PROBLEM", "NOT_RELATED", "UNCERTAIN")
UNCERTAIN_KINDS = ("ROLE", "BOUNDARY", "SPLIT")
ANSWER_TITLE = "参考答案"


def _in_window():
    return W.partitionBy("doc", "window_index").orderBy("pos")


def baseline_role(label: Column, first: Column, content: Column) -> Column:
    return (
        F.when((label == "number") | (first & (label != "doc_title")), "PROBLEM_START")
        .when((label == "paragraph_title") & F.contains(content, F.lit(ANSWER_TITLE)), "SOLUTION_START")
        .when(label.isin("header", "doc_title", "footer"), "NON_PROBLEM")
        .otherwise("PROBLEM_CONTINUATION")
    )


def label_roles(members: DataFrame) -> DataFrame:
    """Adds role to window members by their label and place."""
    return members.withColumn("role", baseline_role(F.col("label"), F.col("pos_in_window") == 0, F.coalesce("content", F.lit(""))))


def sequential_roles(members: DataFrame, every: int = 3) -> DataFrame:
    """Every n-th block of a window begins a problem."""
    return members.withColumn("role", F.when(F.pmod("pos_in_window", F.lit(every)) == 0, "PROBLEM_START").otherwise("PROBLEM_CONTINUATION"))


def boundaries(roles: DataFrame) -> DataFrame:
    """doc, window_index, left_ref, right_ref, relation of each two blocks beside each other in a window."""
    out = roles.select(
        "doc", "window_index", F.col("pos").alias("left_pos"), F.col("block_ref").alias("left_ref"), F.lead("block_ref").over(_in_window()).alias("right_ref"),
        F.when(F.lead("role").over(_in_window()) == "PROBLEM_START", "NEW_PROBLEM").otherwise("SAME_PROBLEM").alias("relation"),
    )
    return out.filter("right_ref is not null")


def predictions(roles: DataFrame) -> DataFrame:
    """doc, window_index, window_id, refs (of the window), prediction: what a model would return."""
    own = F.array_sort(F.collect_list(F.struct("pos", "block_ref", "role")))
    out = roles.groupBy("doc", "window_index", "window_id").agg(own.alias("own"))
    refs = F.transform("own", lambda x: x["block_ref"])
    pair = lambda x, y: F.struct(x["block_ref"].alias("left_ref"), y["block_ref"].alias("right_ref"), F.when(y["role"] == "PROBLEM_START", "NEW_PROBLEM").otherwise("SAME_PROBLEM").alias("relation"))
    n = F.size("own")
    return out.select(
        "doc", "window_index", "window_id", refs.alias("refs"),
        F.struct(
            F.lit(PREDICTION_SCHEMA).alias("schema"), F.col("window_id").alias("window_id"),
            F.transform("own", lambda x: F.struct(x["block_ref"].alias("block_ref"), x["role"].alias("role"))).alias("roles"),
            F.zip_with(F.slice("own", F.lit(1), n - 1), F.slice("own", F.lit(2), n - 1), pair).alias("boundaries"),
            F.array().cast("array<struct<block_ref:string,anchor:string>>").alias("splits"),
            F.array().cast("array<struct<kind:string,refs:array<string>,reason:string>>").alias("uncertain"),
        ).alias("prediction"),
    )


def validation_error(prediction: Column, window_id: Column, refs: Column, schema: str = PREDICTION_SCHEMA) -> Column:
    """The first rule that a prediction breaks, or null; schema is the name that it must give. An invalid prediction stays a row."""
    p = prediction
    roles, own = p["roles"], F.transform(p["roles"], lambda r: r["block_ref"])
    outside = lambda a: F.exists(a, lambda x: ~F.array_contains(refs, x))
    n = F.size(refs)
    left, right = F.slice(refs, F.lit(1), n - 1), F.slice(refs, F.lit(2), n - 1)
    pairs = F.zip_with(left, right, lambda a, b: F.concat(a, F.lit("->"), b))
    actual = F.transform(p["boundaries"], lambda b: F.concat(F.coalesce(b["left_ref"], F.lit("")), F.lit("->"), F.coalesce(b["right_ref"], F.lit(""))))
    known = lambda x, values: F.coalesce(x.isin(*values), F.lit(False))
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(~yes(p["schema"] == schema), "schema")
        .when(~yes(p["window_id"] == window_id), "window_id")
        .when(F.coalesce(n, F.lit(0)) <= 0, "empty_window")
        .when(roles.isNull() | (F.size(roles) <= 0), "roles_empty")
        .when(F.exists(roles, lambda r: ~known(r["role"], ROLES)), "unknown_role")
        .when(outside(own), "role_outside_window")
        .when(F.size(F.array_distinct(own)) < F.size(own), "role_repeated")
        .when(~yes(own == refs), "roles_not_in_order")
        .when(p["boundaries"].isNull(), "boundaries_missing")
        .when(~yes(actual == pairs), "boundaries_not_in_order")
        .when(F.exists(p["boundaries"], lambda b: ~known(b["relation"], RELATIONS)), "unknown_relation")
        .when(yes(outside(F.transform(p["splits"], lambda s: s["block_ref"]))), "split_outside_window")
        .when(yes(F.exists(p["splits"], lambda s: F.coalesce(F.trim(s["anchor"]), F.lit("")) == "")), "split_without_anchor")
        .when(yes(F.exists(p["uncertain"], lambda u: ~known(u["kind"], UNCERTAIN_KINDS))), "unknown_uncertain_kind")
        .when(yes(F.exists(p["uncertain"], lambda u: outside(F.coalesce(u["refs"], F.array().cast("array<string>"))))), "uncertain_outside_window")
        .when(F.contains(F.to_json(p), F.lit("confidence")), "confidence_forbidden")
    )


def parse_response(text: Column, schema: str) -> Column:
    """A model's answer as a struct, code fences taken off; null if it isn't an object."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[A-Za-z]*\s*", ""), r"\s*```$", "")
    return F.when(bare.rlike(r"^\s*\{"), F.from_json(bare, schema))
