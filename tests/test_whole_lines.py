"""Queries without SQL that run over all lines of documents, against brute force; odd lines are planted."""

import os
import re
from collections import Counter

import pytest

from folioframe.functions import mathtext
from folioframe.plans import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [
    "1.x", " 12.Find it.Now", "a.b", "3.14 and 2.x", "x.", "..", "a.,b", "1.2.3", "no.1.x", "v.9", "a,b!c?d:e;f", "a,,b", "end. ok", "", "x1.y",
    "$x=1$", "the year 1999 x=1", "x=1，y=2", "x=1", "n $10$", "$\\left( x$", "$\\left( x \\right)$ $a \\rightarrow b$", "a $b", "x，y", "10", "x+1=20%", "price $5$ and x=5",
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [(-1, "\n".join(ODD)), (-2, None), (-3, "")]
    if os.path.isdir(SF):
        rows += [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return str(path), [(k, i, line) for k, t in rows if t is not None for i, line in enumerate(t.split("\n"))]


def _spaced(line: str) -> str:
    """Character by character."""
    out = []
    for i, c in enumerate(line):
        out.append(c)
        after = line[i + 1 : i + 2]
        if not after or after.isspace():
            continue
        if c in ",!?:;":
            out.append(" ")
        elif c == "." and after not in ".,;:!?":
            digit = i > 0 and line[i - 1].isdigit()
            if not (digit and after.isdigit()) and not (digit and line[:i].strip().isdigit()):
                out.append(" ")
    return "".join(out)


def test_spacing(spark, folder):
    path, lines = folder
    got = {(r.doc_id, r.pos): r.spaced for r in QUERIES["punctuation_spacing_lines"](spark, path).collect()}
    assert len(got) == len(lines) and sum("." in line for _, _, line in lines) > 10
    assert [(k, i, got[k, i]) for k, i, _ in lines] == [(k, i, _spaced(line)) for k, i, line in lines]


def _normalized(line: str) -> str:
    try:
        return mathtext.normalize(line)[0]
    except mathtext.MathTextError:
        return line


def _wraps(line: str) -> Counter:
    return Counter(x for x in re.findall(r"\$([^$\n]*)\$", line) if re.match(r"^[+-]?[0-9,]+([.][0-9]+)?%?$", x.strip(" ")))


def _bucket(raw: str, new: str) -> str:
    def flat(t: str) -> str:
        return "".join(t.replace("$", "").translate(str.maketrans("，。：；（）", ",.:;()")).split())

    if new.count("$") <= raw.count("$"):
        return "OTHER"
    inner = re.findall(r"\$([^$]*)\$", new)
    words = any(re.search(r"(?<!\\)\b[A-Za-z]{3,}\b", x) for x in re.findall(r"\$[^$\n]*\$", new))
    if words or re.search(r"\b(19|20)[0-9]{2}\b", " ".join(inner)) or _wraps(new) - _wraps(raw):
        return "HIGH_RISK"
    return "WRAP_MATH_ONLY" if new.replace("$", "") == raw.replace("$", "") else "PUNCTUATION_ONLY" if flat(new) == flat(raw) else "MIXED"


def test_buckets(spark, folder):
    path, lines = folder
    got = {r.bucket: r.n for r in QUERIES["diff_buckets_normalized"](spark, path).collect()}
    want = Counter(_bucket(line, _normalized(line)) for _, _, line in lines)
    assert got == want and len(want) >= 3, (got, want)
