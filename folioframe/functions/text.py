"""String functions as column expressions: trimming, character folding, spacing, redaction, images, paths."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: punctuation and its ASCII form
ASCII_PUNCTUATION = {
    "、": ",", "。": ".", "〈": "<", "〉": ">", "《": "<", "》": ">", "「": '"', "」": '"', "『": '"', "』": '"',
    "【": "[", "】": "]", "〔": "[", "〕": "]", "〖": "[", "〗": "]", "〘": "[", "〙": "]", "〚": "[", "〛": "]",
    "〜": "~", "〰": "~", "・": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "‘": "'", "’": "'",
    "“": '"', "”": '"', "‥": "..", "…": "...", "‧": ".", "′": "'", "″": '"', "※": "*", "！": "!", "，": ",",
    "．": ".", "：": ":", "；": ";", "？": "?", "（": "(", "）": ")", "［": "[", "］": "]", "｛": "{", "｝": "}",
    "－": "-", "～": "~", "﹁": "(", "﹂": ")", "﹃": "[", "﹄": "]", "﹅": "{", "﹆": "}",
}

# fixed values: code points that are never folded, as East Asian or as mathematics
EAST_ASIAN = ((0x2E80, 0x2FFF), (0x3000, 0x303F), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFE30, 0xFE4F), (0x20000, 0x3FFFF))
MATHEMATICAL = ((0x2070, 0x209F), (0x2150, 0x218F), (0x2460, 0x24FF), (0x2100, 0x214F), (0x1D400, 0x1D7FF))


@cache
def character_map() -> dict[str, str]:
    """Each character with one ASCII form: fullwidth ASCII, compatibility forms that NFKC makes pure ASCII, and the punctuation above, which has the last word."""

    def within(point: int, ranges) -> bool:
        return any(a <= point <= b for a, b in ranges)

    found = {}
    for point in range(0x80, 0x110000):
        char = chr(point)
        if 0xFF01 <= point <= 0xFF5D:
            found[char] = chr(point - 0xFEE0)
        elif unicodedata.category(char) not in ("Cc", "Cs", "Co", "Cn", "No") and not within(point, EAST_ASIAN) and not within(point, MATHEMATICAL):
            plain = unicodedata.normalize("NFKC", char)
            if plain and plain != char and plain.isascii():
                found[char] = plain
    return found | ASCII_PUNCTUATION


def strip(c: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def fold_characters(c: Column) -> Column:
    """Two ellipses are one; then every character of the map becomes ASCII."""
    c = F.replace(c, F.lit("……"), F.lit("…"))
    one = {k: v for k, v in character_map().items() if len(v) == 1 and len(k.encode("utf-16-le")) == 2}
    more = {k: v for k, v in character_map().items() if k not in one}  # forms of more than one character, and what translate can't take
    c = F.translate(c, "".join(one), "".join(one.values()))
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in more.items()])
    replaced = lambda x: F.aggregate(pairs, x, lambda s, p: F.replace(s, p["k"], p["v"]))
    some = f"[{min(more)}-\U0010ffff&&[{''.join(more)}]]"  # most characters are below the range, which is one comparison
    # a lambda's argument is computed once
    return F.transform(F.array(c), lambda x: F.when(x.rlike(some), replaced(x)).otherwise(x))[0]


def space_punctuation(c: Column) -> Column:
    """One blank after , ! ? : ; where none follows; after a period, unless it ends the text, stands between digits, before other punctuation, or ends the number that begins a line."""
    c = F.regexp_replace(c, r"(?U)([,!?:;])(?=\S)", "$1 ")
    return F.regexp_replace(c, r"(?Um)(?<!^\s{0,40}\d{1,40})\.(?![\s.,;:!?]|$)(?!(?<=\d\.)\d)", ". ")


def normalize_plain(c: Column) -> Column:
    return space_punctuation(fold_characters(c))


def rstrip_lines(c: Column) -> Column:
    return F.array_join(F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, r"(?U)\s+$", "")), "\n")


def is_numeric_literal(c: Column) -> Column:
    return strip(c).rlike(r"(?U)^[+-]?[\d,]+(\.\d+)?%?$")


def unbalanced_left_right(c: Column) -> Column:
    r"""Whether some $...$ without a line end has as many \left as \right. \rightarrow and the like don't count."""
    inner = F.regexp_extract_all(c, F.lit(r"\$([^$\n]*)\$"), F.lit(1))
    return F.exists(inner, lambda e: F.regexp_count(e, F.lit(r"\\left(?![a-z])")) != F.regexp_count(e, F.lit(r"\\right(?![a-z])")))


def redact_remote(c: Column) -> Column:
    """http, https and data values become a digest of themselves."""
    return F.when(F.lower(F.trim(c)).rlike("^(https?://|data:)"), F.concat(F.lit("<<remote:"), F.left(F.sha2(F.trim(c), 256), F.lit(16)), F.lit(">>"))).otherwise(c)


def looks_secret(c: Column) -> Column:
    """32 characters or more without white space, with a long opaque run, and upper, lower and digit in it."""
    return (F.length(c) >= 32) & ~c.rlike(r"(?U)\s") & c.rlike("[A-Za-z0-9_-]{32,}") & c.rlike("[A-Z]") & c.rlike("[a-z]") & c.rlike("[0-9]")


# fixed values: how image files begin, in hexadecimal
MAGIC = (("FFD8FF", "jpeg"), ("89504E470D0A1A0A", "png"), ("474946383761", "gif"), ("474946383961", "gif"), ("424D", "bmp"), ("49492A00", "tiff"), ("4D4D002A", "tiff"))


def image_format(hexed: Column) -> Column:
    """Of a file's first bytes in upper-case hexadecimal; null if none is known."""
    out = F.when((F.left(hexed, F.lit(8)) == "52494646") & (F.substring(hexed, 17, 8) == "57454250"), "webp")
    for head, name in MAGIC:
        out = out.when(F.startswith(hexed, F.lit(head)), name)
    return out


def safe_path(c: Column) -> Column:
    """A relative path: backslashes are slashes, empty parts, . and .. go."""
    return F.array_join(F.filter(F.split(F.replace(c, F.lit("\\"), F.lit("/")), "/"), lambda p: ~p.isin("", ".", "..")), "/")


def newline_style(c: Column) -> Column:
    crlf = F.regexp_count(c, F.lit("\r\n"))
    return F.when((crlf > 0) & (crlf >= F.regexp_count(c, F.lit("\n")) - crlf), "CRLF").otherwise("LF")


def with_newlines(c: Column, style: str) -> Column:
    plain = F.replace(c, F.lit("\r\n"), F.lit("\n"))
    return plain if style == "LF" else F.replace(plain, F.lit("\n"), F.lit("\r\n"))
