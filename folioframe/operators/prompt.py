"""Windows as prompts, a model's answers as predictions: pluggable providers, retries, and a record of every call."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labels import PREDICTION_SCHEMA, RELATIONS, ROLES, UNCERTAIN_KINDS, parse_response, validation_error

PREDICTION = (
    "schema string, window_id string, roles array<struct<block_ref:string,role:string>>, boundaries array<struct<left_ref:string,right_ref:string,relation:string>>,"
    " splits array<struct<block_ref:string,anchor:string>>, uncertain array<struct<kind:string,refs:array<string>,reason:string>>"
)
SYSTEM = f"""Classify the structure of a window of blocks. Judge structure only; never rewrite, repeat or complete a text.

Answer with one JSON object (schema {PREDICTION_SCHEMA}):
roles: block_ref and role of every block, in the window's order; role is one of {", ".join(ROLES)}.
boundaries: left_ref, right_ref and relation of every two blocks beside each other, in order; relation is one of {", ".join(RELATIONS)}.
splits: block_ref and anchor, only where one block holds several problems; the anchor is a piece of its text that stands there once.
uncertain: kind ({", ".join(UNCERTAIN_KINDS)}), refs and reason.
Give no offsets and no numbers that say how sure you are. The end of a page is not the end of a problem.
"""


def prompts(members: DataFrame) -> DataFrame:
    """window members (doc, window_index, window_id, pos, block_ref, label, content, ...) -> doc, window_index, window_id, refs, user: the window as JSON."""
    own = F.array_sort(F.collect_list(F.struct("pos", "block_ref", "label", F.coalesce("content", F.lit("")).alias("raw_text"))))
    out = members.groupBy("doc", "window_index", "window_id").agg(own.alias("own"))
    shown = F.transform("own", lambda b: F.struct(b["block_ref"].alias("block_ref"), b["label"].alias("label"), b["raw_text"].alias("raw_text")))
    window = F.to_json(F.struct("window_id", F.size("own").alias("window_size"), shown.alias("blocks")))
    return out.select("doc", "window_index", "window_id", F.transform("own", lambda b: b["block_ref"]).alias("refs"), F.concat(F.lit("Blocks of the window (JSON):\n"), window).alias("user"))


def request(stream: DataFrame, windows: DataFrame, size: int = 5, stride: int = 3, adaptive: tuple[int, ...] = (9, 13)) -> DataFrame:
    """One row per document: doc, block_count, window_size, stride, adaptive_sizes, windows (an array in order)."""
    counts = stream.groupBy("doc").agg(F.count("*").alias("block_count"))
    listed = windows.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("window_index", "window_id", "start_index", "end_index"))).alias("windows"))
    empty = F.array().cast(listed.schema["windows"].dataType)
    out = counts.join(listed, "doc", "left")
    return out.select("doc", "block_count", F.lit(size).alias("window_size"), F.lit(stride).alias("stride"), F.array(*[F.lit(a) for a in adaptive]).alias("adaptive_sizes"), F.coalesce("windows", empty).alias("windows"))


def answer_text(payload: Column) -> Column:
    """The final answer in a response as JSON: output_text, or else the text parts of its messages, one a line. Reasoning is no answer. Null if there is none."""
    item = "array<struct<type:string,content:array<struct<type:string,text:string>>>>"
    whole = F.get_json_object(payload, "$.output_text")
    full = lambda c: F.btrim(c, F.lit(" \t\r\n")) != ""
    messages = F.filter(F.from_json(F.get_json_object(payload, "$.output"), item), lambda m: m["type"] == "message")
    parts = F.flatten(F.transform(messages, lambda m: F.coalesce(m["content"], F.array().cast("array<struct<type:string,text:string>>"))))
    texts = F.transform(F.filter(parts, lambda c: c["type"].isin("output_text", "text") & F.coalesce(full(c["text"]), F.lit(False))), lambda c: c["text"])
    return F.when(F.coalesce(full(whole), F.lit(False)), whole).when(F.size(texts) > 0, F.array_join(texts, "\n"))


def provider(call: Callable[[str, str, int], str]) -> Callable[[Column, Column, int], Column]:
    """A column function of (system, user, attempt) from a function of them; it isn't called where user is null."""

    def column(system: Column, user: Column, attempt: int) -> Column:
        def own(systems, users):
            import pandas as pd

            return pd.Series([None if u is None else call(s, u, attempt) for s, u in zip(systems, users, strict=True)])

        return F.pandas_udf(own, "string")(system, user)

    return column


def predict(windows: DataFrame, ask: Callable[[Column, Column, int], Column], attempts: int = 2, system: str = SYSTEM) -> DataFrame:
    """prompts' columns and: prediction (of the first answer that is valid, else null), error (the last one, null if valid), tries: an array of (attempt, ok, error, raw).

    A further attempt asks only for the windows that have no valid answer yet.
    """
    out, names, valid = windows, [], F.lit(False)
    for k in range(1, max(1, attempts) + 1):
        out = out.withColumn(f"_raw{k}", ask(F.lit(system), F.when(~valid, F.col("user")), k))
        out = out.withColumn(f"_p{k}", parse_response(F.col(f"_raw{k}"), PREDICTION))
        fault = F.when(F.col(f"_p{k}").isNull(), "not_an_object").otherwise(validation_error(F.col(f"_p{k}"), F.col("window_id"), F.col("refs")))
        out = out.withColumn(f"_e{k}", F.when(~valid, fault))
        asked = ~valid
        out = out.withColumn(f"_t{k}", F.when(asked, F.struct(F.lit(k).alias("attempt"), F.col(f"_e{k}").isNull().alias("ok"), F.col(f"_e{k}").alias("error"), F.col(f"_raw{k}").alias("raw"))))
        valid = valid | F.coalesce(F.col(f"_t{k}.ok"), F.lit(False))
        names.append(k)
    prediction = F.coalesce(*[F.when(F.col(f"_t{k}.ok"), F.col(f"_p{k}")) for k in names])
    tries = F.array_compact(F.array(*[F.col(f"_t{k}") for k in names]))
    error = F.when(~valid, F.coalesce(*[F.col(f"_e{k}") for k in reversed(names)]))
    return out.select(*windows.columns, prediction.alias("prediction"), error.alias("error"), tries.alias("tries"))


def call_counts(calls: DataFrame) -> DataFrame:
    """One row: windows, calls, invalid answers, retries, windows left without a prediction."""
    bad = F.size(F.filter("tries", lambda t: ~t["ok"]))
    return calls.agg(F.count("*").alias("windows"), F.sum(F.size("tries")).alias("calls"), F.sum(bad).alias("invalid"), F.sum(F.size("tries") - 1).alias("retries"), F.count_if(F.col("prediction").isNull()).alias("lost"))
