"""Line deduplication: equal lines by hash, near-equal ones by a segment-partition edit join. DataFrame functions only.

A line (trimmed, at least MIN_CHARS characters) is dropped if an equal line stands earlier, in the order of (doc_id,
row, line number), or a near one does: for lines of at least NEAR_CHARS characters one within as many edits as EDITS
gives for the length of the shorter one. With `words`, so is one that an earlier line equals but for one word, of any
length: another in its place, one more or one less (both of at least NEAR_CHARS characters and NEAR_WORDS words).
Blank and shorter lines are never touched, nor are the other lines' characters.

The edit join (after Li, Deng, Wang and Feng's Pass-Join, 2011) works on lines that are all different. A line of
length l, for which e edits are allowed, is cut into e + 1 segments; a line within e edits of it, as long or longer,
holds one of them at a place that the edits can have shifted only so far, so each line is hashed at the few places
that fit, for each length that a shorter partner can have. The segments are written once: they are counted and joined.
What meets is filtered by letter counts (an edit changes two of them by one at most; no pair is lost) and by the edit
distance of the ends, and verified by edit distance, bit-parallel over the diagonals of the band, of what is left without
their common beginning and end.

Two lines that differ by one word share a half of the shorter one's words. Lines whose halves occur once are left out;
of the others each word is masked and each is deleted, and equal results are grouped, so that no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spool

EDITS = ((24, 1), (48, 2))  # lines of at least so many characters may differ by so many edits
MIN_CHARS, NEAR_CHARS = 12, 24
HOT = 8  # lines that share a segment, beyond which they are compared by more than letters; no pair within the edits is lost
NEAR_WORDS = 5  # of fewer words a different one is a different line
BROADCAST_BYTES = 32 << 20  # of a side that is broadcast, by its own measure; beyond it the other side shuffles
_COUNTED = "etan"


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """The edit distance of two strings if it is at most `edits` (4 at most), else null.

    For e up to `edits` a set of diagonals is kept as bits: those on which the prefixes agree up to e edits. A
    character moves all of them at once; sets of fewer edits feed those of more by substitution (same diagonal),
    insertion (one down) and deletion (one up).
    """
    # a lambda's argument is computed once, whatever stands in the lambda is computed for each character
    return F.transform(F.array(F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"), F.length(a).alias("n"), F.length(b).alias("m"))), lambda s: _within(s, edits))[0]


def may_begin_alike(a: Column, b: Column, edits: int, first: int = 12) -> Column:
    """False where already the first characters of b can't be had from the beginning of a by `edits` edits: no diagonal is left after them."""
    some = F.struct(F.split(F.left(a, F.lit(first + edits)), "").alias("x"), F.split(F.left(b, F.lit(first)), "").alias("y"), F.length(a).alias("n"), F.least(F.length(b), F.lit(first)).alias("m"))
    return F.transform(F.array(some), lambda s: _left(s, edits) != 0)[0]


def ends_alike(a: Column, b: Column, allowed: Column, most: int, first: int = 64) -> Column:
    """False where the first or the last characters of a and b show that they are more than `allowed` edits apart, `most` at most.

    Of lines within e edits the first so many characters are within 2 e: e edits make one's those of the other, but for e more or less.
    """
    fits = F.when(F.greatest(F.length(a), F.length(b)) <= first, allowed).otherwise(2 * allowed)  # short lines are compared whole
    return F.levenshtein(F.left(a, F.lit(first)), F.left(b, F.lit(first)), 2 * most).between(0, fits) & F.levenshtein(F.right(a, F.lit(first)), F.right(b, F.lit(first)), 2 * most).between(0, fits)


def _within(s: Column, edits: int) -> Column:
    width, n, m, end = 2 * edits + 1, s["n"], s["m"], _left(s, edits)
    at = n - m + edits
    found = []
    for e in range(edits + 1):
        bit = F.call_function("shiftright", F.shiftright(end, e * width), at.cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
        found.append(F.when(bit, e))
    return F.when((at >= 0) & (at < width), F.coalesce(*found))


def _left(s: Column, edits: int) -> Column:
    """The sets of diagonals after the m characters of y."""
    width, full = 2 * edits + 1, (1 << (2 * edits + 1)) - 1
    x, y, m = s["x"], s["y"], s["m"]

    def part(state: Column, e: int) -> Column:
        return F.shiftright(state, e * width).bitwiseAND(F.lit(full).cast("long"))

    def step(state: Column, i: Column) -> Column:
        c = F.get(y, i)
        match = F.lit(0).cast("long")
        for d in range(-edits, edits + 1):
            match = match + F.when(((i + d) >= 0) & F.coalesce(F.get(x, i + d) == c, F.lit(False)), F.lit(1 << (d + edits)).cast("long")).otherwise(F.lit(0).cast("long"))
        new, out = None, F.lit(0).cast("long")
        for e in range(edits + 1):
            own = part(state, e).bitwiseAND(match)
            if e:
                before = part(state, e - 1)
                own = own.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(new, 1).bitwiseAND(F.lit(full).cast("long")))
            new = own
            out = out.bitwiseOR(F.shiftleft(own, e * width))
        return out

    start = sum(sum(1 << (d + edits) for d in range(e + 1)) << (e * width) for e in range(edits + 1))
    return F.when(m > 0, F.aggregate(F.sequence(F.lit(0), F.greatest(m - 1, F.lit(0))), F.lit(start).cast("long"), step)).otherwise(F.lit(start).cast("long"))


def _allowed(length: Column, edits) -> Column:
    """Edits that a line of this length may be apart from one as long or longer."""
    out = F.lit(0)
    for least, e in edits:
        out = F.when(length >= least, e).otherwise(out)
    return out


def _pieces(long: DataFrame, edits, probe: bool) -> DataFrame:
    """Adds h: the hashes of the lines' own segments, or of all places where a line may hold a segment of one as long or a few characters shorter. A row for each.

    Which places there are is a fixed array, so that a row's hash is one short expression, computed where the row is made.
    """
    specs = []
    for k, (least, e) in enumerate(edits):
        most = edits[k + 1][0] if k + 1 < len(edits) else 1 << 30
        for shift in range(e + 1) if probe else (0,):
            for i in range(e + 1):
                for o in range(max(-i, shift - (e - i)), min(i, shift + e - i) + 1) if probe else (0,):
                    specs.append((least, most, shift, i, o, e + 1))
    names = ("least", "most", "shift", "i", "o", "parts")
    each = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, spec, strict=True)]) for spec in specs]))
    size, own = F.col("size") - F.col("s.shift"), F.col("s.parts")
    base, extra = F.floor(size / own).cast("int"), size % own  # the last segments are longer by one
    start = base * F.col("s.i") + F.greatest(F.lit(0), F.col("s.i") - own + extra) + F.col("s.o")
    length = base + F.when(extra >= own - F.col("s.i"), 1).otherwise(0)
    rows = long.select("*", each.alias("s")).filter((size >= F.col("s.least")) & (size < F.col("s.most")))
    rows = rows.filter((start >= 0) & (start + length <= F.col("size")))
    return rows.withColumn("h", F.xxhash64("s.i", size, F.substring("line", start + 1, length))).drop("s", "line")


def _letters(line: Column) -> Column:
    out = F.lit(0).cast("long")
    for k, c in enumerate(_COUNTED):
        n = F.least(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit(""))), F.lit(127)).cast("long")
        out = out.bitwiseOR(F.shiftleft(n, 8 * k))
    return out


def _letters_apart(a: Column, b: Column) -> Column:
    byte = lambda x, k: F.shiftright(x, 8 * k).bitwiseAND(F.lit(127).cast("long"))
    out = F.lit(0).cast("long")
    for k in range(len(_COUNTED)):
        out = out + F.abs(byte(a, k) - byte(b, k))
    return out


def _agreed(a: Column, b: Column, most: Column, ends: bool, places: int = 24) -> Column:
    """How many characters a and b begin with (or end in) alike, `most` at most: by halving steps, so that few pieces are compared."""
    cut = (lambda x, n, s: F.substring(x, F.length(x) - n - s + 1, s)) if ends else (lambda x, n, s: F.substring(x, n + 1, s))
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(places, -1, -1)]), lambda s: s <= most)
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when((n + s <= most) & (cut(a, n, s) == cut(b, n, s)), n + s).otherwise(n))


def _middles(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """a and b without what they begin and end with alike, which leaves their edit distance as it is."""
    short = F.least(F.length(a), F.length(b))
    pairs = pairs.withColumn("_begin", F.explode(F.array(_agreed(F.col(a), F.col(b), short, False))))  # an array, so that it is computed once
    pairs = pairs.withColumn("_end", F.explode(F.array(_agreed(F.col(a), F.col(b), short - F.col("_begin"), True))))
    middle = lambda x: F.substring(x, F.col("_begin") + 1, F.length(x) - F.col("_begin") - F.col("_end"))
    return pairs.withColumns({a: middle(a), b: middle(b)}).drop("_begin", "_end")


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _small(df: DataFrame, bytes_of_row: Column | int = 64) -> DataFrame:
    """df, to be broadcast if its rows, by this measure, are few enough bytes."""
    total = df.agg(F.sum(bytes_of_row if isinstance(bytes_of_row, Column) else F.lit(bytes_of_row))).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def _without(text: Column, drop: Column) -> Column:
    """The text without the lines of these numbers; as it is where there are none."""
    lines = F.split(text, "\n")
    return F.when(drop.isNull(), text).otherwise(F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(drop, i)), "\n"))


def _lines(rows: DataFrame) -> DataFrame:
    """(doc_id, row, text) -> doc_id, row, pos, line (trimmed), size."""
    trimmed = F.transform(F.split("text", "\n"), _trimmed)  # here, so that a line is trimmed once
    return rows.select("doc_id", "row", F.posexplode(trimmed).alias("pos", "line")).withColumn("size", F.length("line"))


def _parities(line: Column) -> Column:
    """Two times 64 bits: whether the pairs of characters beside each other that hash to a bit are even or odd in number. An edit takes two such pairs away and brings two, at most."""
    own = F.split(line, "")
    pairs = F.filter(F.zip_with(own, F.slice(own, F.lit(2), F.greatest(F.length(line) - 1, F.lit(0))), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b))), lambda p: p.isNotNull())
    flip = lambda bits, p: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int")))
    start = F.struct(F.lit(0).cast("long").alias("parity"), F.lit(0).cast("long").alias("other"))
    return F.aggregate(pairs, start, lambda s, p: F.struct(flip(s["parity"], p).alias("parity"), flip(s["other"], F.shiftright(p, 20)).alias("other")))


def _signs(own: DataFrame, docs: DataFrame) -> DataFrame:
    """row, pos, parity and other of lines that share one of the segments `own` with more than HOT lines: lines made from one template all meet, and most that differ by more edits than are allowed differ in these bits too. No pair within the edits does."""
    hot = spool(own.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("h"), "hot")
    some = spool(own.join(_small(hot, 16), "h", "left_semi").select("row", "pos").distinct(), "hot lines")
    texts = docs.join(_small(some), "row").select("row", "pos", _trimmed(F.get(F.split("text", "\n"), F.col("pos"))).alias("line"))
    return spool(texts.select("row", "pos", _parities(F.col("line")).alias("s")).select("row", "pos", "s.parity", "s.other"), "signs")


def near_lines(lines: DataFrame, docs: DataFrame, edits=EDITS) -> DataFrame:
    """lines (doc_id, row, pos, line, size), all different and trimmed -> pairs (row_a, pos_a, row_b, pos_b, distance), a before b in the order of (doc_id, row, pos). docs (doc_id, row, text) has the lines' texts by number; row is unique. Lines may come without doc_id where row is in its order."""
    order = [c for c in ("doc_id", "row", "pos") if c in lines.columns]
    most = max(e for _, e in edits)
    long = lines.filter(F.col("size") >= min(n for n, _ in edits))
    long = long.withColumn("letters", _letters(F.col("line")))
    # one number for letters and size: a line has many pieces, and each of them shuffles
    pieces = lambda df, probe: _pieces(df, edits, probe).withColumn("letters", F.col("letters").bitwiseOR(F.shiftleft(F.col("size").cast("long"), 32))).drop("size")
    own = spool(pieces(long, False), "segments")
    signs = _small(_signs(own, docs))
    index, probes = own.join(signs, ["row", "pos"], "left"), pieces(long.join(signs, ["row", "pos"], "left"), True)
    side = lambda df, s: df.select("h", *[F.col(c).alias(f"{c}_{s}") for c in df.columns if c != "h"])
    at = lambda s: F.struct(*[F.col(f"{c}_{s}").alias(c) for c in order])
    size_x, size_y = (F.shiftright(f"letters_{s}", 32) for s in "xy")
    x, y = at("x"), at("y")
    # of two lines of one length either probes the other: once is enough
    once = (size_x < size_y) | (x < y)
    apart = _letters_apart(F.col("letters_x"), F.col("letters_y"))
    allowed = _allowed(size_x, edits)
    alike = [F.coalesce(F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) <= 4 * allowed, F.lit(True)) for c in ("parity", "other")]
    met = side(index, "x").join(side(probes, "y"), "h").filter(once & (apart <= 2 * allowed) & alike[0] & alike[1])
    met = spool(met.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct().select(F.col("a.row").alias("row_a"), F.col("a.pos").alias("pos_a"), F.col("b.row").alias("row_b"), F.col("b.pos").alias("pos_b")), "met")
    wanted = spool(met.select(F.col("row_a").alias("row"), F.col("pos_a").alias("pos")).union(met.select("row_b", "pos_b")).distinct(), "wanted")
    texts = docs.join(_small(wanted), "row").select("row", "pos", _trimmed(F.get(F.split("text", "\n"), F.col("pos"))).alias("line"))
    texts = spool(texts, "lines")
    side = lambda s: texts.select(F.col("row").alias(f"row_{s}"), F.col("pos").alias(f"pos_{s}"), F.col("line").alias(f"line_{s}"))
    both = met.join(side("a"), ["row_a", "pos_a"]).join(side("b"), ["row_b", "pos_b"])
    both = both.withColumn("allowed", _allowed(F.least(F.length("line_a"), F.length("line_b")), edits))
    both = both.filter(ends_alike(F.col("line_a"), F.col("line_b"), F.col("allowed"), most))
    # few bytes but long work: not to be gathered in a few partitions
    both = both.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    both = _middles(both, "line_a", "line_b").filter(may_begin_alike(F.col("line_a"), F.col("line_b"), most)).filter(may_begin_alike(F.reverse("line_a"), F.reverse("line_b"), most))
    both = both.withColumn("distance", within_edits(F.col("line_a"), F.col("line_b"), most)).filter(F.col("distance") <= F.col("allowed"))
    return both.select("row_a", "pos_a", "row_b", "pos_b", "distance")


def one_word_lines(lines: DataFrame, docs: DataFrame, near_chars: int = NEAR_CHARS, near_words: int = NEAR_WORDS) -> DataFrame:
    """lines (doc_id, row, pos, line, size), all different and trimmed -> distinct (row, pos) of those that an earlier line equals but for one word. docs (doc_id, row, text) has the lines' texts by number; row is unique."""
    line, n, i = F.col("line"), F.col("n"), F.col("i")
    counted = lambda df: df.withColumn("n", F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1).filter((F.length("line") >= near_chars) & (n >= near_words))
    words = lambda k: F.call_function("substring_index", line, F.lit(" "), k.cast("int"))

    def halves(m: Column) -> list[Column]:
        """Of a line of m words its halves, of one of m + 1 what must be one of them."""
        h = F.floor(m / 2)
        return [F.when(m >= near_words, F.xxhash64(m, F.lit(side), words(k))) for side, k in ((0, h), (1, h - m))]

    held = counted(lines).select("row", "pos", F.explode(F.array(*halves(n), *halves(n - 1))).alias("h")).filter("h is not null")
    shared = spool(held.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1").select("h"), "halves")
    wanted = spool(held.join(_small(shared, 16), "h").select("row", "pos").distinct(), "halved")
    texts = docs.join(_small(wanted), "row").select("doc_id", "row", "pos", _trimmed(F.get(F.split("text", "\n"), F.col("pos"))).alias("line"))

    each = counted(texts).repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))).select("doc_id", "row", "pos", "line", "n", F.explode(F.sequence(F.lit(-1), n - 1)).alias("i"))
    before, after = words(i), words(i + 1 - n)
    key = lambda *parts: F.unhex(F.md5(F.concat(*parts)))
    masked = key(F.lit("m"), i.cast("string"), F.lit(" "), before, F.lit(" "), after)
    deleted = key(F.lit("w"), before, F.when((i > 0) & (i < n - 1), " ").otherwise(""), after)
    made = F.when(i < 0, F.array(F.struct(F.lit("whole").alias("role"), key(F.lit("w"), line).alias("key")))).otherwise(F.array(F.struct(F.lit("masked").alias("role"), masked.alias("key")), F.struct(F.lit("deleted").alias("role"), deleted.alias("key"))))
    keys = spool(each.select("doc_id", "row", "pos", F.explode(made).alias("m")).select("doc_id", "row", "pos", "m.role", "m.key"), "words")
    at = F.struct("doc_id", "row", "pos")
    first = lambda role: F.min(F.when(F.col("role") == role, at)).alias(role)
    groups = keys.groupBy("key").agg(first("whole"), first("masked"), first("deleted"), F.count("*").alias("k")).filter("k > 1 and (masked is not null or (whole is not null and deleted is not null))").drop("k")
    earlier = F.when(F.col("role") == "masked", F.col("masked")).when(F.col("role") == "deleted", F.col("whole")).otherwise(F.col("deleted"))
    return keys.join(_small(spool(groups, "one word"), 160), "key").filter(earlier < at).select("row", "pos").distinct()


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """all (a struct of all columns, the text null), doc_id, row (unique and not null), text. Ids that are unique are the row's number; else the rows are numbered and written, so that the numbers stay. And whether the ids are the numbers."""
    slim = F.struct(*[(F.lit(None).cast(f.dataType) if f.name == text_col else F.col(f.name)).alias(f.name) for f in docs.schema.fields])
    rows = docs.select(slim.alias("all"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    repeated = docs.groupBy(F.col(id_col).alias("k")).agg(F.count("*").alias("n")).filter("n > 1 or k is null").limit(1).count()
    return (spool(rows.withColumn("row", F.monotonically_increasing_id()), "rows"), False) if repeated else (rows.withColumn("row", F.col("doc_id")), True)


def dedup_lines(docs: DataFrame, edits=EDITS, min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS, words: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row (all columns of docs as a struct, the text null), text (what is left), n_lines, n_equal, n_near, doc_id.

    edits: one number for all lines of at least near_chars characters, or pairs (least length, edits), 4 edits at most.
    Null texts stay null, with 0 lines; an empty table gives no rows. Rows with a null doc_id come first in the order and keep all
    their lines. Rows that repeat a doc_id are rows of their own, in any order among each other; of rows that are equal altogether one
    keeps its lines. Very long texts are split in one task, line by line. Names of docs' columns may be anything.
    """
    edits = tuple(sorted(edits)) if isinstance(edits, tuple) else ((near_chars, edits),)
    rows, numbers = _numbered(docs, id_col, text_col)
    found = spool(_lines(rows).filter(F.col("size") >= min_chars).select("doc_id", "row", "pos", F.unhex(F.md5("line")).alias("key")), "lines")
    at = F.struct("doc_id", "row", "pos")
    first = found.groupBy("key").agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1").select("key", "first")
    later = found.join(_small(spool(first, "repeated")), "key").filter(F.col("first") < at)
    drops = spool(later.groupBy("row").agg(F.collect_set("pos").alias("drop")), "equal")  # at most the lines of one document
    left = rows.join(_small(drops, 64 + 4 * F.size("drop")), "row", "left").select(
        "doc_id", "row", "all", _without(F.col("text"), F.col("drop")).alias("text"), F.when(F.col("doc_id").isNull(), F.col("text")).alias("whole"),
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"), F.when(F.col("doc_id").isNotNull(), F.coalesce(F.size("drop"), F.lit(0))).otherwise(0).alias("n_equal"),
    )
    left = spool(left, "unequal")

    own = left.select("doc_id", "row", "text")
    near = near_lines(_lines(own).drop(*["doc_id"] * numbers), own, edits).select(F.col("row_b").alias("row"), F.col("pos_b").alias("pos"))
    if words:
        near = near.union(one_word_lines(_lines(own), own, near_chars))
    named = F.col("doc_id").isNotNull()
    drops = spool(near.groupBy("row").agg(F.collect_set("pos").alias("drop")), "near")
    return left.join(_small(drops, 64 + 4 * F.size("drop")), "row", "left").select(
        F.col("all").alias("row"), F.when(named, _without(F.col("text"), F.col("drop"))).otherwise(F.col("whole")).alias("text"), F.col("n_lines").cast("long").alias("n_lines"), F.col("n_equal").cast("long").alias("n_equal"),
        F.when(named, F.coalesce(F.size("drop"), F.lit(0))).otherwise(0).cast("long").alias("n_near"), "doc_id",
    )


def clean(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs with the repeated lines dropped from the texts; all columns and rows stay, and n_chars, where there is one, follows."""
    out = dedup_lines(docs, text_col=text_col, **options)
    columns = [F.col("text") if c == text_col else F.coalesce(F.length("text").cast(docs.schema[c].dataType), F.col("row")[c]) if c == "n_chars" else F.col("row")[c] for c in docs.columns]
    return out.select(*[x.alias(c) for x, c in zip(columns, docs.columns, strict=True)])
