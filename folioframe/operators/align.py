"""Weak alignment of statements with blocks by containment of their first characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.shared import written

PROBES = (40, 28, 20, 14)
GRAM, STRIDE = 6, 7
MARKERS = ("参考答案", "答案", "解析", "解答", "解：", "证明")


def squeeze(c: Column) -> Column:
    """All white space goes; full-width marks are folded."""
    return F.regexp_replace(F.translate(c, "，。：；（）", ",.:;()"), r"(?U)\s+", "")


def probes(questions: DataFrame) -> DataFrame:
    """questions (question, statement) -> question, rank (0: longest), probe; those under six characters are left out."""
    text = squeeze(F.col("statement"))
    each = F.array(*[F.struct(F.lit(k).alias("rank"), F.left(text, F.lit(n)).alias("probe")) for k, n in enumerate(PROBES)])
    return questions.select("question", F.explode(each).alias("p")).select("question", "p.rank", "p.probe").filter(F.length("probe") >= GRAM)


def _squeezed(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("squeezed", squeeze(F.coalesce("content", F.lit("")))).filter(F.length("squeezed") >= GRAM).select("doc", "pos", "squeezed")


def candidates(asked: DataFrame, own: DataFrame, stride: int) -> DataFrame:
    """asked (probe), each once, of GRAM + stride - 1 characters or more -> probe, doc, pos of blocks (doc, pos, squeezed) that may contain it.

    Of a block, the hashed pieces of GRAM characters at every stride-th place are kept, if some probe has them at all. Where a
    block contains a probe, the pieces of the probe at every stride-th place from some place on are among them, all of them:
    so of each of the `stride` rows of places the probe only needs one piece, and takes the one that fewest blocks have. A
    beginning that many probes share, and a line that many blocks have, thus join nothing unless a probe has nothing else; a
    row with a piece that no block has is left out.
    """
    place = lambda c, i: F.xxhash64(F.substring(c, i, F.lit(GRAM)))
    heads = asked.withColumn("at", F.explode(F.sequence(F.lit(1), F.length("probe") - GRAM + 1))).select("probe", F.pmod("at", F.lit(stride)).alias("row"), place("probe", F.col("at")).alias("piece"))
    pieces = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("squeezed") - GRAM + 1, F.lit(stride)), lambda i: place("squeezed", i)))
    cut = written(own.select("doc", "pos", F.explode(pieces).alias("piece")).join(heads.select("piece").distinct(), "piece", "left_semi"), "pieces")
    counts = cut.groupBy("piece").agg(F.count("*").alias("n"))
    rarest = heads.join(counts, "piece", "left").groupBy("probe", "row").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("least"))
    chosen = rarest.filter("least.n > 0").select("probe", F.col("least.piece").alias("piece")).distinct()
    return cut.join(chosen, "piece").select("probe", "doc", "pos").distinct()


def contained(probe_table: DataFrame, blocks: DataFrame) -> DataFrame:
    """(question, rank, probe) with each block (doc, pos, content) that contains the probe.

    An equi-join on pieces instead of a nested loop (see candidates), with each different probe checked once on what meets.
    Probes too short for a stride meet the pieces at all places of the blocks. A block's text goes with its pieces only past
    the join.
    """
    own = _squeezed(blocks)
    asked = probe_table.select("probe").distinct()
    short = F.length("probe") < GRAM + STRIDE - 1
    met = candidates(asked.filter(~short), own, STRIDE)
    if asked.filter(short).limit(1).count():
        met = met.unionByName(candidates(asked.filter(short), own, 1))
    texts = own.select(F.col("doc").alias("_doc"), F.col("pos").alias("_pos"), "squeezed")
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("pos") == F.col("_pos"))  # a document without a number has blocks too
    held = met.join(texts, same).filter(F.contains("squeezed", F.col("probe"))).select("probe", "doc", "pos").distinct()
    return held.join(probe_table, "probe").select("question", "rank", "doc", "pos").distinct()


def starts(questions: DataFrame, blocks: DataFrame) -> DataFrame:
    """question, doc, start, confidence of each document in which a question is found: by the longest probe, in the first block."""
    found = contained(probes(questions), blocks)
    best = found.groupBy("question", "doc").agg(F.min(F.struct("rank", "pos")).alias("best"))
    return best.select("question", "doc", F.col("best.pos").alias("start"), F.when(F.col("best.rank") == 0, "exact").otherwise("approximate").alias("confidence"))


def spans(start_table: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds next_start and span (at least 1): to the next question of the document, the last to its end. sizes: doc, n."""
    by_question = W.partitionBy("doc").orderBy("question")
    out = start_table.join(sizes, "doc").withColumn("next_start", F.coalesce(F.lead("start").over(by_question), F.col("n")).cast("int"))
    return out.withColumn("span", F.greatest(F.lit(1), F.col("next_start") - F.col("start"))).drop("n")


def zone_start(blocks: DataFrame) -> DataFrame:
    """doc, zone_start: the first block of at most 30 characters that holds an answer marker; the number of blocks if none does."""
    text = squeeze(F.coalesce("content", F.lit("")))
    marked = (F.length(text) > 0) & (F.length(text) <= 30) & F.greatest(*[F.contains(text, F.lit(squeezed)) for squeezed in MARKERS])
    return blocks.groupBy("doc").agg(F.coalesce(F.min(F.when(marked, F.col("pos"))), F.count("*")).cast("int").alias("zone_start"))


def long_spans(span_table: DataFrame, blocks: DataFrame, threshold: int = 20) -> DataFrame:
    """question, doc, reason of spans over the threshold."""
    over = span_table.filter(F.col("span") > threshold).withColumn("pos", F.explode(F.sequence("start", F.col("next_start") - 1)))
    held = over.join(blocks.select("doc", "pos", "page_seq", "label", F.coalesce("content", F.lit("")).alias("content")), ["doc", "pos"])
    marked = F.greatest(*[F.contains("content", F.lit(m)) for m in MARKERS])
    per = held.groupBy("question", "doc").agg(F.max(F.col("label") == "number").alias("number"), F.max(marked).alias("marked"), F.min("page_seq").alias("first"), F.max("page_seq").alias("last"), F.count("*").alias("n"))
    reason = F.when(F.col("marked") & F.col("number"), "SOLUTION_BLEED").when(F.col("number"), "ALIGNMENT_DRIFT").when(F.col("first") != F.col("last"), "CROSS_PAGE").when(F.col("n") > threshold, "REAL_LONG_PROBLEM").otherwise("ALIGNMENT_DRIFT")
    return per.select("question", "doc", reason.alias("reason"))


def failures(questions: DataFrame, start_table: DataFrame, blocks: DataFrame) -> DataFrame:
    """question, reason of those found nowhere: empty, found by a later part (windows of 60, 40 and 24 characters by half), or not at all."""
    lost = questions.join(start_table.select("question").distinct(), "question", "left_anti").withColumn("text", squeeze(F.coalesce("statement", F.lit(""))))
    part = lambda n: lambda o: F.substring("text", o + 1, F.lit(n))  # noqa: E731  (a second argument, even one with a default, would be the element's index)
    parts = [F.transform(F.sequence(F.lit(0), F.greatest(F.length("text") - n - 1, F.lit(0)), F.lit(n // 2)), part(n)) for n in (60, 40, 24)]
    later = lost.select("question", F.explode(F.array_distinct(F.concat(*parts))).alias("probe")).filter(F.length("probe") >= 12).withColumn("rank", F.lit(0))
    hit = contained(later, blocks).select("question").distinct().withColumn("hit", F.lit(True))
    reason = F.when(F.col("text") == "", "SOLUTION_BLEED").when(F.col("hit"), "OCR_CONTENT_VARIATION").otherwise("ALIGNMENT_ALGORITHM_LIMIT")
    return lost.join(hit, "question", "left").select("question", reason.alias("reason"))


def units_of(evidence: DataFrame) -> DataFrame:
    """(units: an array of structs with unit_id and raw_text) -> unit_id, text; of a repeated id the last one."""
    each = evidence.select(F.posexplode("units").alias("k", "u")).filter("u.unit_id is not null")
    return each.groupBy(F.col("u.unit_id").alias("unit_id")).agg(F.max_by(F.coalesce("u.raw_text", F.lit("")), "k").alias("text"))


def statements(questions: DataFrame, units: DataFrame) -> DataFrame:
    """questions (question, parts: an array of structs unit_id, start, end, join_before) -> question, statement: the units' slices, separated as the parts after the first say.

    Parts of unknown units and empty slices are left out; a question of which nothing is left has an empty statement.
    """
    parts = questions.select("question", F.posexplode("parts").alias("k", "p")).select("question", "k", "p.*")
    start, end = F.coalesce("start", F.lit(0)), F.coalesce("end", F.lit(0))
    parts = parts.join(units, "unit_id").filter((F.col("text") != "") & (end > start))
    between = F.when(F.col("join_before") == "linebreak", "\n").when(F.col("join_before") == "paragraph", "\n\n").when(F.col("join_before") == "space", " ").otherwise("")
    cut = F.substring("text", start + 1, end - start)
    own = parts.groupBy("question").agg(F.array_sort(F.collect_list(F.struct("k", between.alias("sep"), cut.alias("cut")))).alias("own"))
    joined = F.concat(F.col("own")[0]["cut"], F.array_join(F.transform(F.slice("own", F.lit(2), F.greatest(F.size("own") - 1, F.lit(0))), lambda x: F.concat(x["sep"], x["cut"])), ""))
    return questions.select("question").distinct().join(own, "question", "left").select("question", F.coalesce(joined, F.lit("")).alias("statement"))


def starts_in_order(questions: DataFrame, blocks: DataFrame, cutoff: bool = False) -> DataFrame:
    """As `starts`, but a document's questions, in the order of their names, begin where the one before begins or later, and with cutoff before the answers begin where that is beyond. A document's hits are folded in one row."""
    hits = contained(probes(questions), blocks).groupBy("doc", "question").agg(F.collect_list(F.struct("rank", "pos")).alias("hits"))
    own = hits.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("question", "hits"))).alias("asked"))
    own = own.join(zone_start(blocks), "doc") if cutoff else own.withColumn("zone_start", F.lit(1 << 30))
    found = own.schema["asked"].dataType.elementType["question"].dataType.simpleString()
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<question:{found},rank:int,start:int>>").alias("found"))

    def step(s, x):
        upper = F.when(F.col("zone_start") > s["at"], F.col("zone_start")).otherwise(F.lit(1 << 30))
        best = F.array_min(F.filter(x["hits"], lambda h: (h["pos"] >= s["at"]) & (h["pos"] < upper)))
        row = F.struct(x["question"].alias("question"), best["rank"].alias("rank"), best["pos"].cast("int").alias("start"))
        return F.when(best.isNull(), s).otherwise(F.struct(best["pos"].cast("int").alias("at"), F.concat(s["found"], F.array(row)).alias("found")))

    out = own.select("doc", F.explode(F.aggregate("asked", start, step)["found"]).alias("f"))
    return out.select("f.question", "doc", "f.start", F.when(F.col("f.rank") == 0, "exact").otherwise("approximate").alias("confidence"))


def document_report(span_table: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc, aligned, exact, approximate, span_p50, span_p90, span_max, single, within_3, within_5, within_7, cross_page, same_block of `spans`' rows (that keep start, next_start, span, confidence)."""
    from .stats import nearest_rank

    pages = blocks.select("doc", F.col("pos"), "page_seq")
    page = lambda name, at: pages.select("doc", F.col("pos").alias(at), F.col("page_seq").alias(name))
    own = span_table.withColumn("last", F.greatest(F.col("next_start") - 1, F.col("start"))).join(page("first_page", "start"), ["doc", "start"], "left").join(page("last_page", "last"), ["doc", "last"], "left")
    count = lambda c, name: F.count_if(F.coalesce(c, F.lit(False))).alias(name)
    out = own.groupBy("doc").agg(
        F.count("*").alias("aligned"), count(F.col("confidence") == "exact", "exact"), count(F.col("confidence") != "exact", "approximate"), F.collect_list("span").alias("_spans"), F.max("span").alias("span_max"), count(F.col("span") == 1, "single"),
        *[count(F.col("span") <= k, f"within_{k}") for k in (3, 5, 7)], count(F.col("last_page") > F.col("first_page"), "cross_page"), count(F.col("next_start") == F.col("start"), "same_block"),
    )
    return out.select("doc", "aligned", "exact", "approximate", nearest_rank(F.col("_spans"), 0.5).alias("span_p50"), nearest_rank(F.col("_spans"), 0.9).alias("span_p90"), "span_max", "single", "within_3", "within_5", "within_7", "cross_page", "same_block")


def corpus_report(questions: DataFrame, span_table: DataFrame, reports: DataFrame) -> DataFrame:
    """One row: documents, questions, aligned questions, lost ones, spans and the shares within 3, 5 and 7 blocks (4 digits), mean (2) and greatest span."""
    ratio = lambda k: F.round(F.sum(f"within_{k}") / F.sum("aligned"), 4).alias(f"within_{k}_ratio")
    totals = reports.agg(F.count("*").alias("documents"), F.sum("aligned").alias("spans"), F.sum("cross_page").alias("cross_page"), F.sum("same_block").alias("same_block"), *[ratio(k) for k in (3, 5, 7)])
    found = span_table.agg(F.count_distinct("question").alias("aligned"), F.round(F.avg("span"), 2).alias("span_mean"), F.max("span").alias("span_max"))
    asked = questions.agg(F.count_distinct("question").alias("questions"))
    one = totals.crossJoin(F.broadcast(found)).crossJoin(F.broadcast(asked))  # one row each
    return one.withColumn("lost", F.col("questions") - F.col("aligned"))


def anomaly_report(failure_table: DataFrame, long_table: DataFrame) -> DataFrame:
    """kind, reason, n of `failures` and `long_spans`, most first."""
    rows = failure_table.select(F.lit("alignment_failure").alias("kind"), "reason").unionAll(long_table.select(F.lit("long_span").alias("kind"), "reason"))
    return rows.groupBy("kind", "reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind", "reason")
