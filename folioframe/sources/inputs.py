"""What is asked for, folders and files by name, as the files that are worked on and the problems there are.

A listing (path) is a table, of `listed` or of a catalogue; what is asked (place, name) is one too. Both meet in equi-joins
on names, so neither comes to the driver. A folder gives its own files, not those of folders below. Names are compared with
/ at the end left out; an empty name is the folder "." of the relative paths.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PDF = (".pdf",)
MARKDOWN = (".md",)
BOTH = (".pdf", ".md")
ABSENT, EMPTY, OTHER = "absent", "no_files", "other_suffix"


def listed(spark: SparkSession, roots: list[str]) -> DataFrame:
    """path, length of every file below the roots; no file is opened. Files whose names begin with _ or . are left out, as Spark does."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    return files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")


def _bare(name: Column) -> Column:
    return F.when(name.rlike("^/+$"), "/").when(name == "", ".").otherwise(F.regexp_replace(name, "/+$", ""))


def _folder(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "(?s)/+[^/]*$", "")).when(path.isNotNull(), ".")


def suffix(path: Column) -> Column:
    """From the last point of the file's name on, in small letters; none where the name only begins or ends with it."""
    return F.lower(F.regexp_extract(path, r"(?s)[^/](\.[^./]+)$", 1))


def _above(path: Column) -> Column:
    """The folders above a path, each with all that stands before it."""
    parts = F.split(path, "/")
    heads = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    return F.when(F.size(parts) > 1, F.filter(heads, lambda x: x != "")).otherwise(F.array().cast("array<string>"))


def _named(files: DataFrame, suffixes: tuple[str, ...], skip: str | None) -> DataFrame:
    """path, _key, named, fits: each file under its own name and under its folder's, and whether it is taken where that is asked for."""
    two = F.array(F.struct(F.lit(True).alias("named"), F.col("path").alias("_key")), F.struct(F.lit(False).alias("named"), _folder(F.col("path")).alias("_key")))
    fits = suffix(F.col("path")).isin(*suffixes)
    if skip:
        fits = fits & (F.col("named") | ~F.regexp_replace("path", r"(?s)(?<=[^/])\.[^./]+$", "").rlike(skip))
    return files.filter("path is not null").select("path", F.explode(two).alias("k")).select("path", "k.*").withColumn("fits", fits)


def collected(asked: DataFrame, files: DataFrame, suffixes: tuple[str, ...] = PDF, skip: str | None = None) -> DataFrame:
    """asked (place, name), files (path) -> place, path: each file once, whatever the case of its path and however often it is asked for, by the first place that asks.

    In a folder files whose names, without suffix, match skip are left out (what an earlier run made); a file asked for by its
    name isn't. Of paths that differ in case alone the first by place, then by path, stays. Null names ask for nothing. The
    order is (place, path). What is asked for many times is looked up once.
    """
    once = asked.filter("name is not null").groupBy(_bare(F.col("name")).alias("_key")).agg(F.min("place").alias("place"))
    own = _named(files, suffixes, skip).filter("fits").join(once, "_key")
    return own.groupBy(F.lower("path").alias("_same")).agg(F.min(F.struct("place", "path")).alias("f")).select("f.place", "f.path")


def problems(asked: DataFrame, files: DataFrame, suffixes: tuple[str, ...] = PDF, skip: str | None = None) -> DataFrame:
    """place, name, problem of all that is asked and gives no file: absent, no_files (a folder without such files of its own), other_suffix (a file).

    A folder is known by the files below it, at any depth; one that holds nothing is absent to a listing of files.
    """
    known = _named(files, suffixes, skip).groupBy("_key").agg(F.max("fits").alias("fits"), F.max("named").alias("named"))
    above = files.filter("path is not null").select(F.explode(_above(F.col("path"))).alias("_key")).distinct()
    facts = known.join(above.withColumn("above", F.lit(True)), "_key", "full")
    what = F.when(F.col("named"), OTHER).when(F.col("above") | ~F.col("named"), EMPTY).otherwise(ABSENT)
    own = asked.filter("name is not null").select("place", "name", _bare(F.col("name")).alias("_key"))
    return own.join(facts, "_key", "left").filter("not coalesce(fits, false)").select("place", "name", what.alias("problem"))


def glob(pattern: str) -> str:
    """The regular expression of a pattern of file names: * and ? don't pass /, [a-c] and [!a] are sets; an open [ stands for itself."""
    out, k = "", 0
    while k < len(pattern):
        c, end = pattern[k], pattern.find("]", k + 2)
        if c == "[" and end > 0:
            body = pattern[k + 1 : end].replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&").replace("^", "\\^")
            out += f"[^/{body[1:]}]" if body.startswith("!") else f"[{body}]"
            k = end
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c))
        k += 1
    return f"(?s)^{out}$"


def targets(files: DataFrame, folder: str, pattern: str = "*.pdf", limit: int = 0) -> DataFrame:
    """path of the files of a folder whose names match, by path; the first `limit` of them if it is above 0 (what a trial run asks for)."""
    bare = folder if folder == "/" else folder.rstrip("/")
    own = files.filter((_folder(F.col("path")) == bare) & F.regexp_extract("path", "(?s)[^/]*$", 0).rlike(glob(pattern))).select("path").distinct().orderBy("path")
    return own.limit(limit) if limit > 0 else own


def prework(path: Column) -> Column:
    """The folder <stem>_prework that holds an evidence.json; null in the older layout."""
    return F.nullif(F.regexp_extract(path, r"(?s)^((?:.*/)?[^/]*_prework)/evidence\.json$", 1), F.lit(""))


def beside(path: Column, kind: str) -> Column:
    """Where a derived artifact of an evidence file lies: view, raw, semantic or diagnostics, in both layouts.

    <stem>_prework/evidence.json has normalized-view.json and the folders raw, semantic and diagnostics beside it;
    <stem>.evidence.json has <stem>.normalized.json and <stem>_raw, and its own folder for the rest.
    """
    own = prework(path)
    name = F.regexp_extract(path, "(?s)[^/]*$", 0)
    folder = _folder(path)
    in_folder = lambda x: F.when(F.instr(path, "/") > 0, F.concat(folder, F.lit("/"), x)).otherwise(x)
    stem = F.replace(name, F.lit(".evidence.json"), F.lit(""))
    new = {"view": "normalized-view.json", "raw": "raw", "semantic": "semantic", "diagnostics": "diagnostics"}[kind]
    old = {"view": in_folder(F.replace(name, F.lit(".evidence.json"), F.lit(".normalized.json"))), "raw": in_folder(F.concat(stem, F.lit("_raw"))), "semantic": folder, "diagnostics": folder}[kind]
    return F.when(own.isNotNull(), F.concat(own, F.lit("/" + new))).otherwise(old)
