"""Sinks: JSON lines and documents that are never overwritten unasked, raw pages, logs, Markdown files, reports.

Spark's commit protocol stands in for writing beside and renaming: a table is there whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import with_newlines
from ..operators.evidence import summary
from ..operators.structure import scrubbed


def write_json(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """One JSON object a row, nulls kept. What is there already is an error unless overwrite is said."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("ignoreNullFields", False).json(path)


def write_raw_pages(pages: DataFrame, path: str, mode: str = "page", envelope: DataFrame | None = None) -> None:
    """pages (doc, page_seq, raw JSON, markdown_text, images): none writes nothing, page the raw pages, full also what stands beside them and the envelope (value), without secrets. Empty pages are left out."""
    if mode not in ("none", "page", "full"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "none":
        return
    some = pages.filter("raw is not null")
    columns = ["doc", "page_seq", "raw"] if mode == "page" else ["doc", "page_seq", "raw", "markdown_text", "images"]
    some.select(*columns).write.mode("errorifexists").partitionBy("doc").json(f"{path}/pages")
    if mode == "full" and envelope is not None:
        envelope.select(scrubbed(F.col("value")).alias("value")).filter("value is not null").write.mode("errorifexists").text(f"{path}/envelope")


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    """A log of the outcomes and a summary row beside it."""
    outcomes.write.mode("errorifexists").json(f"{path}/status")
    summary(outcomes).write.mode("errorifexists").json(f"{path}/summary")


def write_views(view: DataFrame, path: str, overwrite: bool = False) -> None:
    """Normalized views by document."""
    view.write.mode("overwrite" if overwrite else "errorifexists").partitionBy("doc").json(path)


def write_calls(calls: DataFrame, path: str) -> None:
    """Every call of a provider: the window's prompt, its tries and the prediction, by document."""
    calls.write.mode("errorifexists").partitionBy("doc").json(path)


def markdown_bytes(text: Column, bom: Column, style: Column) -> Column:
    """A file's bytes: its newline style and its byte order mark are kept."""
    body = F.when(style == "CRLF", with_newlines(text, "CRLF")).otherwise(with_newlines(text, "LF"))
    return F.when(bom, F.concat(F.unhex(F.lit("EFBBBF")), F.encode(body, "UTF-8"))).otherwise(F.encode(body, "UTF-8"))


def write_markdown(files: DataFrame, folder: str) -> DataFrame:
    """files (name, text, has_bom, style) -> name, path, bytes, for each file that was written below folder, which driver and executors share. A file is written beside its place and moved, so a task that runs again leaves the same one."""
    rows = files.select("name", markdown_bytes(F.col("text"), F.col("has_bom"), F.col("style")).alias("content"))

    def put(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))
        for b in batches:
            paths, sizes = [], []
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at = f"{root}/{name}"
                store.create_dir(at.rsplit("/", 1)[0], recursive=True)
                part = f"{at}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part, compression=None) as out:
                    out.write(content)
                store.move(part, at)
                paths.append(at)
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["name", "path", "bytes"])

    return rows.mapInArrow(put, "name string, path string, bytes long")


def markdown_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """line: each row as a row of a Markdown table; | in a cell is escaped, nulls are empty."""
    cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in columns]), F.lit(" |")).alias("line"))


def markdown_report(df: DataFrame, columns: list[str], title: str, limit: int = 1000) -> str:
    """A titled Markdown table of the first rows, for people to read."""
    lines = [r["line"] for r in markdown_rows(df.limit(limit), columns).collect()]
    return "\n".join([f"# {title}", "", "| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns), *lines, ""])


def revised(path: Column, mark: str = ".revised") -> Column:
    """The output beside an input: its name with a mark before the suffix."""
    return F.regexp_replace(path, r"(?s)^(.*?)(\.[^./\\]*)?$", "$1" + mark + "$2")


def free_names(wanted: DataFrame, taken: DataFrame) -> DataFrame:
    """wanted (name) -> name, free for each row: the name, or with -2, -3 ... before its suffix the first that is neither taken nor wanted.

    No two rows get one name. Of rows that want the same free name one keeps it. The r-th row that must go elsewhere gets the
    r-th number that is open: r + 1, and as many more as there are used numbers with fewer than r open ones before them. A
    name is in one family alone, what it is made of before its last number, so families are dealt with apart from each other.
    Null names stay null.
    """
    from pyspark.sql.window import Window as W

    suffix = F.regexp_extract("name", r"(\.[^./\\]*)$", 1)
    stem = F.expr("left(name, length(name) - length(suffix))")
    numbered = r"(?s)^(.*)-([1-9]\d{0,8})$"
    own = wanted.filter("name is not null").select("name").withColumn("nth", F.row_number().over(W.partitionBy("name").orderBy(F.lit(1))))
    held = taken.filter("name is not null").select("name").distinct()
    kept = own.filter("nth = 1").join(held, "name", "left_anti").select("name", F.col("name").alias("free"))
    rest = own.join(held.withColumn("held", F.lit(True)), "name", "left").filter("held or nth > 1").groupBy("name").agg(F.count("*").alias("n"))
    rest = rest.withColumn("suffix", suffix).withColumn("stem", stem)
    used = held.unionByName(own.select("name")).distinct().withColumn("suffix", suffix).withColumn("bare", stem).filter(F.col("bare").rlike(numbered))
    used = used.select(F.regexp_extract("bare", numbered, 1).alias("stem"), "suffix", F.regexp_extract("bare", numbered, 2).cast("long").alias("k")).filter("k >= 2")
    used = used.join(rest.select("stem", "suffix"), ["stem", "suffix"], "left_semi")
    before = F.col("k") - 1 - F.row_number().over(W.partitionBy("stem", "suffix").orderBy("k"))  # open numbers below a used one
    marks = used.select("stem", "suffix", before.alias("at"), F.lit(True).alias("is_used"))
    rows = rest.select("stem", "suffix", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("at"), F.lit(False).alias("is_used"))
    passed = F.count(F.when(F.col("is_used"), 1)).over(W.partitionBy("stem", "suffix").orderBy("at", "is_used").rowsBetween(W.unboundedPreceding, 0))
    number = (F.col("at") + 1 + passed).cast("string")
    moved = marks.unionByName(rows).withColumn("number", number).filter("not is_used").select(F.concat("stem", "suffix").alias("name"), F.concat("stem", F.lit("-"), "number", "suffix").alias("free"))
    return kept.unionByName(moved).unionByName(wanted.filter("name is null").select("name", F.lit(None).cast("string").alias("free")))


def chosen_files(spark: SparkSession, names: list[str], asked: str, skip: str = r"\.revised\.") -> list[str]:
    """Names that a person asks for: parted by ; or , (full-width too); all or * means every one but those that were made by a run."""
    import re

    parts = [p.strip() for p in re.split("[;,；，]", asked) if p.strip()]
    if any(p in ("*", "all", "全部") for p in parts):
        return sorted(n for n in names if not re.search(skip, n))
    return parts
