"""The normalizer of mathematics on every line's number in twelve dresses, against what the rules ask for."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import udfs
from ..sources.tables import blocks, table
from .registry import query, sql

N = "cast(pos as varchar(20))"
#: What is put in, and what normalization makes of it.
DRESSES = [
    (f"'设x=' || {N}", f"'设$x=' || {N} || '$'"), (f"'`x=' || {N} || '`'", None), (f"'https://e.org/x=' || {N}", None), (f"'共' || {N} || '个'", None),
    (rf"'分数$\frac{{1}}{{' || {N} || '}}$'", rf"'分数$\displaystyle \frac{{1}}{{' || {N} || '}}$'"), (f"'已知$a$,$b_{{' || {N} || '}}$'", f"'已知$a,b_{{' || {N} || '}}$'"),
    (f"'填____空' || {N}", rf"'填$\underline{{\quad\quad\quad}}$空' || {N}"), (f"'[链接x=1](http://a.b/' || {N} || ')'", None), (f"'<b>x=' || {N} || '</b>'", f"'<b>$x=' || {N} || '$</b>'"),
    (f"'第' || {N} || '题.设y=2'", f"'第' || {N} || '题. 设$y=2$'"), (f"'2.5%,x+' || {N} || '=40。'", f"'$2.5%, x+' || {N} || '=40$.'"), (f"'$$x=' || {N} || '$$'", None),
]


def _case(values: list) -> str:
    return "case pos % 12 " + " ".join(f"when {k} then {v}" for k, v in enumerate(values) if v) + " end"


RAW = _case([a for a, _ in DRESSES])
NEW = _case([b or a for a, b in DRESSES])


def _lines(spark, d):
    return blocks(table(spark, d, "documents")).select("doc", "pos", F.expr(RAW.replace("\\", "\\\\")).alias("raw"))


@query("normalized_lines", sql("blocks", then=f"select doc, pos, {NEW} as text from blocks"))
def q_normalized(spark, d):
    return _lines(spark, d).select("doc", "pos", udfs.text_math(F.col("raw"))["text"].alias("text"))


@query("normalized_twice", sql("blocks", then=f"select doc, pos, {NEW} as text, '' as codes from blocks"))
def q_twice(spark, d):
    """A normalized line is valid and stays as it is."""
    once = _lines(spark, d).select("doc", "pos", udfs.text_math(F.col("raw"))["text"].alias("once"))
    return once.select("doc", "pos", udfs.text_math(F.col("once"))["text"].alias("text"), F.array_join(udfs.check_math(F.col("once"))["findings"]["code"], "|").alias("codes"))


SPANNED = f"""case pos % 12 when 1 then 'INLINE_CODE:0-' || length({DRESSES[1][0]}) when 2 then 'URL:0-' || length({DRESSES[2][0]})
   when 7 then 'MARKDOWN_LINK_DESTINATION:0-' || length({DRESSES[7][0]}) || '|URL:8-' || (length({DRESSES[7][0]}) - 1)
   when 8 then 'RAW_HTML:0-3|RAW_HTML:' || (5 + length({N})) || '-' || (9 + length({N})) else '' end"""


@query("protected_spans", sql("blocks", then=f"select doc, pos, {SPANNED} as spans from blocks"))
def q_protected(spark, d):
    return _lines(spark, d).select("doc", "pos", _shown(udfs.protected(F.col("raw"))).alias("spans"))


MATHS = f"""case pos % 12 when 4 then 'INLINE_MATH:2-' || length({DRESSES[4][0]}) when 5 then 'INLINE_MATH:2-5|INLINE_MATH:6-' || length({DRESSES[5][0]}) when 11 then 'DISPLAY_MATH:0-' || length({DRESSES[11][0]}) else '' end"""


@query("math_spans", sql("blocks", then=f"select doc, pos, {MATHS} as spans from blocks"))
def q_math(spark, d):
    return _lines(spark, d).select("doc", "pos", _shown(udfs.math(F.col("raw"))).alias("spans"))


FOUND = "case pos % 12 when 4 then 'ERROR_MISSING_DISPLAYSTYLE' when 5 then 'ERROR_MERGEABLE_INLINE_MATH' when 6 then 'ERROR_NOT_NORMALIZED' else case when pos % 12 in (0, 8, 9, 10) then 'ERROR_UNWRAPPED_MATH' else '' end end"


@query("math_findings", sql("blocks", then=f"select doc, pos, {FOUND} as codes, pos % 12 in (1, 2, 3, 7, 11) as is_valid, pos % 12 not in (1, 2, 3, 7, 11) as needs_normalization from blocks"))
def q_findings(spark, d):
    own = _lines(spark, d).select("doc", "pos", udfs.check_math(F.col("raw")).alias("c"))
    return own.select("doc", "pos", F.array_join("c.findings.code", "|").alias("codes"), "c.is_valid", "c.needs_normalization")


def _shown(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), "|")
