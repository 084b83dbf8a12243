"""Suspicious lines of extracted Markdown: marked, never changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: words and patterns of the rules
SOLUTION_WORDS = ("分析", "解", "证明", "评注", "解答", "解析", "思路", "说明")
PAGE_TITLE = r"(?U)^[_\s\-—]*\d{1,4}[_\s\-—]*[\x{4e00}-\x{9fff}][\x{4e00}-\x{9fff}\w\s]{0,30}$"
CJK_SPACE = r"(?U)[\x{4e00}-\x{9fff}]\s+[\x{4e00}-\x{9fff}]"
HEADER_IMAGE = r'(?i)<img[^>]*?src="([^"]*header[^"]*)"'


def marks(documents: DataFrame) -> DataFrame:
    """(doc, text) -> doc, line (from 1), rule, content.

    R1 page number and a title of the document, R2 a blank between ideographs in a heading, R3 a heading that begins like a
    solution, R4 a header image (each one), R5 an empty heading. R1 ends a line's rules but for R4.
    """
    lines = documents.select("doc", F.posexplode(F.split("text", "\n")).alias("k", "raw"))
    bare = F.regexp_replace("raw", r"(?U)^\s+|\s+$", "")
    lines = lines.select("doc", (F.col("k") + 1).alias("line"), "raw", bare.alias("bare")).filter("bare <> ''")
    titles = lines.filter(F.startswith("raw", F.lit("#"))).select("doc", F.regexp_replace(F.regexp_replace("raw", "^#+", ""), r"(?U)^\s+|\s+$", "").alias("title"))
    titles = titles.filter((F.col("title") != "") & ~F.col("title").rlike(CJK_SPACE)).distinct()
    paged = lines.filter(~F.contains("bare", F.lit("$")) & F.col("bare").rlike(PAGE_TITLE))
    r1 = paged.join(titles, "doc").filter(F.contains("bare", F.col("title"))).select("doc", "line").distinct().withColumn("paged", F.lit(True))
    all_ = lines.join(r1, ["doc", "line"], "left")
    heading = F.col("raw").rlike("^#{1,6}") & F.col("paged").isNull()
    title = F.regexp_replace(F.regexp_extract("raw", r"(?U)^#{1,6}\s*(.*)$", 1), r"(?U)^\s+|\s+$", "")
    mark = lambda rule, c: F.struct(F.lit(rule).alias("rule"), F.left(c, F.lit(120)).alias("content"))
    word = F.greatest(*[F.startswith(title, F.lit(w)) for w in SOLUTION_WORDS])
    images = F.transform(F.regexp_extract_all("raw", F.lit(HEADER_IMAGE), F.lit(1)), lambda _: mark("R4", F.col("bare")))
    rest = F.array_compact(
        F.array(
            F.when(F.col("paged"), mark("R1", F.col("bare"))),
            F.when(heading & (title == ""), mark("R5", F.col("raw"))),
            F.when(heading & (title != "") & title.rlike(CJK_SPACE), mark("R2", title)),
            F.when(heading & (title != "") & word, mark("R3", title)),
        )
    )
    found = all_.select("doc", "line", F.explode(F.concat(images, rest)).alias("m"))
    return found.select("doc", "line", "m.rule", "m.content")
