"""Column functions that need a lexer: Arrow batches of strings, equal strings of a batch once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import mathtext

SPANS = "array<struct<start:int,end:int,kind:string>>"
FINDINGS = "array<struct<code:string,severity:string,message:string,line:int,column:int,context:string>>"


def _batched(function, kind: str):
    def own(batch):
        import pandas as pd

        known = {t: function(t) for t in set(batch) if t is not None}
        out = [None if t is None else known[t] for t in batch]
        return pd.DataFrame([dict.fromkeys(FIELDS[kind]) if x is None else x for x in out]) if kind in FIELDS else pd.Series(out)

    return F.pandas_udf(own, kind)


NORMAL = "text string, error string, stable boolean"
CHECKED = f"is_valid boolean, needs_normalization boolean, conforming boolean, has_fatal_error boolean, findings {FINDINGS}"
FIELDS = {NORMAL: ["text", "error", "stable"], CHECKED: ["is_valid", "needs_normalization", "conforming", "has_fatal_error", "findings"]}


def _normal(text: str) -> dict:
    try:
        return {"text": mathtext.normalize(text)[0], "error": None, "stable": True}
    except mathtext.MathTextError as x:
        return {"text": None, "error": str(x), "stable": None}


def _checked(text: str) -> dict:
    return {k: [f._asdict() for f in v] if k == "findings" else v for k, v in mathtext.check(text)._asdict().items()}


def text_math(c: Column) -> Column:
    """struct(text, error, stable): never raises."""
    return _batched(_normal, NORMAL)(c)


def check_math(c: Column) -> Column:
    return _batched(_checked, CHECKED)(c)


def protected(c: Column) -> Column:
    return _batched(lambda t: [s._asdict() for s in mathtext.protected_spans(t)], SPANS)(c)


def math(c: Column) -> Column:
    return _batched(lambda t: [s._asdict() for s in mathtext.math_spans(t, mathtext.protected_spans(t))[0]], SPANS)(c)


def _lists(texts, rows, types: dict):
    """An Arrow array of lists of structs: rows(text) gives tuples; numbers and strings are kept by column, never as an object a row."""
    from array import array

    import pyarrow as pa

    kinds = {"int": ("i", pa.int32()), "bigint": ("q", pa.int64())}
    columns = [array(kinds[t][0]) if t in kinds else [] for t in types.values()]
    ends, none = array("i", [0]), []
    for text in texts:
        text = text.as_py()
        none.append(text is None)
        for row in rows(text) if text is not None else ():
            for column, x in zip(columns, row, strict=True):
                column.append(x)
        ends.append(len(columns[0]))
    parts = [pa.array(c, kinds[t][1]) if t in kinds else pa.array(c, pa.string()) for c, t in zip(columns, types.values(), strict=True)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, list(types)), mask=pa.array(none, pa.bool_()))


def _listed(rows, types: dict, c: Column) -> Column:
    def own(texts):
        return _lists(texts, rows, types)

    kind = ",".join(f"{name}:{t}" for name, t in types.items())
    return F.arrow_udf(own, f"array<struct<{kind}>>")(c)


def _lines(text: str):
    at = 0
    for pos, line in enumerate(text.split("\n")):
        yield pos, at, len(line), line.find(",")
        at += len(line) + 1


def line_places(c: Column) -> Column:
    """The lines of a text: pos from 0, the code point at which each begins, its length, the place of its first comma in it or -1."""
    return _listed(_lines, {"pos": "int", "at": "bigint", "length": "int", "comma": "int"}, c)


def word_places(c: Column, least: int) -> Column:
    """The words of a text, of `least` code points or more, parted by blanks and line feeds, with the code point at which each begins."""
    import re

    runs = re.compile(rf"[^ \n]{{{least},}}")
    return _listed(lambda t: ((m.start(), m.group()) for m in runs.finditer(t)), {"at": "bigint", "word": "string"}, c)
