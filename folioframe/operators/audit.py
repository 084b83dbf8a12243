"""What normalization changed: diff classes, numeric wraps, distance, and a stratified sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

BUCKETS = ("HIGH_RISK", "WRAP_MATH_ONLY", "PUNCTUATION_ONLY", "MIXED", "OTHER")
QUOTAS = {"HIGH_RISK": 30, "WRAP_MATH_ONLY": 10, "PUNCTUATION_ONLY": 10, "MIXED": 10, "OTHER": 0}


def _bare(c: Column) -> Column:
    return F.replace(c, F.lit("$"), F.lit(""))


def _flat(c: Column) -> Column:
    return F.regexp_replace(F.translate(_bare(c), "，。：；（）", ",.:;()"), r"(?U)\s+", "")


def numeric_wraps(c: Column) -> Column:
    """The $...$ that hold only a number, with repeats."""
    return F.filter(F.regexp_extract_all(c, F.lit(r"\$([^$\n]*)\$"), F.lit(1)), lambda x: F.trim(x).rlike(r"^[+-]?[0-9,]+(\.[0-9]+)?%?$"))


def numeric_wrap_gain(raw: Column, new: Column) -> Column:
    """Size of the bag difference: numeric wraps of the new text that the raw one lacks."""
    a, b = numeric_wraps(new), numeric_wraps(raw)
    count = lambda xs, v: F.size(F.filter(xs, lambda x: x == v))
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda s, v: s + F.greatest(count(a, v) - count(b, v), F.lit(0)))


def classify(raw: Column, new: Column) -> Column:
    added = F.regexp_count(new, F.lit(r"\$")) - F.regexp_count(raw, F.lit(r"\$"))
    inner = F.array_join(F.regexp_extract_all(new, F.lit(r"\$([^$]*)\$"), F.lit(1)), " ")
    words = F.exists(F.regexp_extract_all(new, F.lit(r"\$[^$\n]*\$"), F.lit(0)), lambda e: e.rlike(r"(?<!\\)\b[A-Za-z]{3,}\b"))
    risky = words | inner.rlike(r"\b(19|20)[0-9]{2}\b") | (numeric_wrap_gain(raw, new) > 0)
    return F.when(added <= 0, "OTHER").when(risky, "HIGH_RISK").when(_bare(new) == _bare(raw), "WRAP_MATH_ONLY").when(_flat(new) == _flat(raw), "PUNCTUATION_ONLY").otherwise("MIXED")


def distance(a: Column, b: Column) -> Column:
    """What follows the longest common prefix, in both."""
    x, y = F.split(a, ""), F.split(b, "")
    differ = F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), False)
    shorter = F.least(F.length(a), F.length(b)).cast("long")
    common = F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0).cast("long")).when(differ == 0, shorter).otherwise(differ - 1)
    return (F.length(a) - common) + (F.length(b) - common)


def sample(diffs: DataFrame, quotas: dict[str, int] = QUOTAS) -> DataFrame:
    """diffs (bucket, distance, doc, block_ref, ...): of each bucket the largest distances; what a bucket leaves of its quota goes to HIGH_RISK. Ties by doc and block_ref."""
    have = diffs.groupBy("bucket").agg(F.count("*").alias("n"))
    quota = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])
    left = F.greatest(quota[F.col("bucket")] - F.coalesce("n", F.lit(0)), F.lit(0))
    names = diffs.sparkSession.createDataFrame([(b,) for b in quotas], "bucket string")
    spill = names.filter("bucket <> 'HIGH_RISK'").join(have, "bucket", "left").agg(F.sum(left).alias("spill"))
    rank = F.row_number().over(W.partitionBy("bucket").orderBy(F.desc("distance"), "doc", "block_ref"))
    ranked = diffs.withColumn("rank", rank).filter(F.col("rank") <= sum(quotas.values()))
    limit = quota[F.col("bucket")] + F.when(F.col("bucket") == "HIGH_RISK", F.col("spill")).otherwise(0)
    return ranked.join(F.broadcast(spill)).filter(F.col("rank") <= limit).drop("spill")  # one row


def collect(view: DataFrame, shown: int = 300) -> tuple[DataFrame, DataFrame]:
    """view (doc, block_ref, content, profile, status, normalized_content, diagnostic) -> changes (doc, block_ref, bucket, distance, gain, raw, new) of blocks of text, and fatals (doc, block_ref, diagnostic, raw); texts are shown up to `shown` characters, buckets and distances are of the whole ones."""
    raw, new = F.coalesce("content", F.lit("")), F.coalesce("normalized_content", F.lit(""))
    cut = lambda c: F.left(c, F.lit(shown))
    changed = view.filter((F.col("profile") == "text_math") & (F.col("status") == "changed"))
    changes = changed.select("doc", "block_ref", classify(raw, new).alias("bucket"), distance(raw, new).alias("distance"), numeric_wrap_gain(raw, new).alias("gain"), cut(raw).alias("raw"), cut(new).alias("new"))
    return changes, view.filter("status = 'fatal'").select("doc", "block_ref", "diagnostic", cut(raw).alias("raw"))
