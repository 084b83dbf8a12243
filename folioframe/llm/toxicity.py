"""Toxicity by class-conditional Kneser-Ney models.

Two models of the bytes of words, one of toxic and one of ordinary labelled texts: interpolated Kneser-Ney of strings up
to ORDER + 1 bytes within a blank, the word and a blank. A word counts once a text, so that one that a single text
repeats is as rare as it is. The longest strings have their class's counts, shorter ones the class's continuation
counts (how many different bytes stand before), and the shortest, to which both classes back off, share the
continuation counts of both, so that a rare expression is not held against the smaller class. What is taken off a
count grows with it (DISCOUNTS of 1, 2 and more): what one text alone has says nothing but by its shorter strings.

A text is judged by log-likelihood ratios, toxic against ordinary, of its words: of the whole text and of its worst
WINDOW words by length, of all its different words by length, and, since a few words make a long text toxic, of the
worst two and four different words and of what exceeds EXCESS. A logistic regression turns them into a probability.
It is fitted on labelled rows that its models haven't seen; the models that score then learn from those rows too.

Bounds: of all labelled rows outside the held-out fold about SAMPLE of each class are drawn by a hash of the id, before
their texts are read; a fifth of them, by a hash of the text, is for the regression. Every text is scored whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import learned, spool
from .langid import Model, _strings, count_strings, word_runs
from .tokens import by_chars, text_slices

ORDER = 7
SAMPLE = 6000
WINDOW = 12
EXCESS = 3.0
DISCOUNTS = (1.0, 1.6, 1.8)
SHARED = 1  # strings of up to so many bytes of context have the counts of both classes
WORDS_KEPT = 250_000  # of at most LONGEST bytes, with 16 bytes of figures
LONGEST = 64
CHARS = 1_500_000  # judged at once
THRESHOLD = 0.3
FEATURES = 7


def _taken(n: np.ndarray) -> np.ndarray:
    return np.minimum(n, np.select([n < 2, n < 3], DISCOUNTS[:2], DISCOUNTS[2]))


class KneserNey:
    """Frozen models of the classes 0 (ordinary) and 1 (toxic)."""

    def __init__(self, counted, order: int = ORDER):
        raw = Model(counted, ["0", "1"], order, totals=False)
        self.order, self.keys, self.n, self.left = order, [], [], []
        owns, wholes, shares = [], [], []
        for k in range(order + 1):
            n = raw.n[k].astype(np.float64)
            if k < order:  # continuation counts; what begins a word has no byte before it and keeps its own
                longer = raw.keys[k + 1]
                fresh = np.zeros_like(n)
                np.add.at(fresh, Model._find(raw.keys[k], longer & np.uint64((1 << (8 * (k + 1))) - 1)), raw.n[k + 1][:-1] > 0)
                begins = np.append((raw.keys[k] >> np.uint64(8 * k)) == 32, False) & (k > 0)  # a single blank ends one
                n = np.where(begins[:, None], n, np.maximum(fresh, n > 0))
                n[-1] = 0
            if k <= SHARED:
                n = np.repeat(n.sum(axis=1, keepdims=True), 2, axis=1)
            contexts = raw.keys[k - 1] if k else np.zeros(1, np.uint64)
            at = Model._find(contexts, raw.keys[k] >> np.uint64(8)) if k else np.zeros(len(raw.keys[k]), np.int64)
            total, taken = np.zeros((len(contexts) + 1, 2)), np.zeros((len(contexts) + 1, 2))
            np.add.at(total, at, n[:-1])
            np.add.at(taken, at, _taken(n[:-1]))
            total[-1] = taken[-1] = 0
            whole = np.maximum(total, 1)[np.append(at, len(contexts))]
            own = (n - _taken(n)) / whole
            raw.n[k] = None  # what is read further on is the next longer ones'
            # a string of which all is taken off in both classes has no share of its own: it can go without a change of any probability
            some = (own[:-1] > 0).any(axis=1)
            owns.append((some, np.vstack((own[:-1][some], np.zeros((1, 2))))))
            wholes.append(contexts)
            shares.append(np.where(total > 0, taken / np.maximum(total, 1), 1.0))
        # so can a context that gives all its weight away, as one that was never seen does
        for k in range(order + 1):
            some, own = owns[k]
            self.keys.append(raw.keys[k][some])
            self.n.append(own)
            open_ = (shares[k][:-1] < 1).any(axis=1) if k else np.ones(1, bool)
            self.left.append((wholes[k][open_], np.vstack((shares[k][:-1][open_], np.ones((1, 2))))))

    def probabilities(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(n x 2 probabilities of each byte of the words and the blanks that end them in both classes, number of the byte's word)."""
        strings, place, word = _strings(words, self.order)
        coded = place > 0
        places = place[coded]
        p = np.full((len(places), 2), 1 / 256)
        for k in range(self.order + 1):
            fits = places >= k
            own = np.where(fits, Model._find(self.keys[k], strings[k][coded]), len(self.keys[k]))
            contexts, left = self.left[k]
            if k:  # the context of k bytes ended one byte earlier
                before = np.concatenate((np.zeros(1, np.uint64), strings[k - 1][:-1]))[coded]
                at = np.where(fits, Model._find(contexts, before), len(contexts))
            else:
                at = np.zeros(len(places), np.int64)
            p = self.n[k][own] + left[at] * p
        return p, word[coded]

    def ratio(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihood of each word (with the blank that ends it) as toxic less that as ordinary."""
        p, word = self.probabilities(words)
        return np.bincount(word, np.log(p[:, 1]) - np.log(p[:, 0]), len(words))


#: Where too few rows can be fitted: the worst window alone.
PLAIN = (np.zeros(FEATURES), np.ones(FEATURES), np.array([0.0, 4.0, *[0.0] * (FEATURES - 2), -2.0]))


class Scorer:
    """Features of texts, each word judged once."""

    def __init__(self, model: KneserNey):
        self.model, self.place, self.table = model, {}, np.zeros((1 << 12, 2))

    def _words(self, vocabulary: list[bytes]) -> np.ndarray:
        """Ratio and bytes of each word."""
        place = self.place
        if len(place) > WORDS_KEPT:
            place.clear()
        out = np.zeros((len(vocabulary), 2))
        known = np.fromiter((place.get(w, -1) for w in vocabulary), np.int64, len(vocabulary))
        out[known >= 0] = self.table[known[known >= 0]]
        new = np.flatnonzero(known < 0)
        for i in range(0, len(new), 10000):
            at = new[i : i + 10000]
            some = [vocabulary[j] for j in at.tolist()]
            out[at, 0] = self.model.ratio(some)
            out[at, 1] = np.fromiter(map(len, some), np.float64, len(some)) + 1
        kept = [j for j in new.tolist() if len(vocabulary[j]) <= LONGEST]
        while len(place) + len(kept) > len(self.table):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
        self.table[len(place) : len(place) + len(kept)] = out[kept]
        place.update(zip([vocabulary[j] for j in kept], range(len(place), len(place) + len(kept)), strict=True))
        return out

    def features(self, texts: list[str]) -> np.ndarray:
        """n x FEATURES; zeros without words."""
        found, bounds = word_runs([t.lower() for t in texts])
        vocabulary, index = self._words(found.dictionary.to_pylist()), found.indices.to_numpy().astype(np.int64)
        out = np.zeros((len(texts), FEATURES))
        some = np.flatnonzero(np.diff(bounds))
        if len(some):
            own = vocabulary[index]
            sums = np.concatenate((np.zeros((1, 2)), np.cumsum(own, axis=0)))
            first, last = bounds[:-1][some], bounds[1:][some]
            whole = sums[last] - sums[first]
            out[some, 0] = whole[:, 0] / whole[:, 1]
            text = np.repeat(np.arange(len(some)), last - first)
            begin = np.minimum(np.arange(len(own)), np.maximum(first, last - WINDOW)[text])
            inner = sums[np.minimum(begin + WINDOW, last[text])] - sums[begin]
            out[some, 1] = np.maximum.reduceat(inner[:, 0] / inner[:, 1], first)
            # different words of each text, the worst first
            each = np.unique(text * len(vocabulary) + index)
            text, word = np.divmod(each, len(vocabulary))
            order = np.lexsort((-vocabulary[word, 0], text))
            ratios, first = vocabulary[word[order]], np.searchsorted(text, np.arange(len(some)))
            n = np.diff(np.append(first, len(text)))
            sums = np.concatenate((np.zeros((1, 2)), np.cumsum(ratios, axis=0)))
            for j, most in ((2, 2), (3, 4)):
                out[some, j] = sums[first + np.minimum(n, most), 0] - sums[first, 0]
            out[some, 4] = np.add.reduceat(np.maximum(ratios[:, 0] - EXCESS, 0), first) / np.sqrt(n)
            whole = sums[first + n] - sums[first]
            out[some, 5] = whole[:, 0] / whole[:, 1]
            out[some, 6] = np.log(n + 1)
        return out


def _features(model: KneserNey, batches):
    """(ids, features) of Arrow batches (id, text)."""
    scorer = Scorer(model)
    for keys, texts in by_chars(batches, CHARS):
        yield keys, scorer.features(texts)


def _has_words(x: np.ndarray) -> np.ndarray:
    return x[:, FEATURES - 1] > 0


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method: (mean, scale, weights with the constant last)."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * (len(w) - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


class Judge:
    def __init__(self, model: KneserNey, fit):
        self.model, self.fit = model, fit

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 of a text without words, which is no likelier under either model."""
        mean, scale, w = self.fit
        return np.where(_has_words(x), 1 / (1 + np.exp(-np.clip(np.column_stack(((x - mean) / scale, np.ones(len(x)))) @ w, -30, 30))), 0.0)


def train(labelled: DataFrame) -> Judge | None:
    """labelled (text, toxic), a bounded table (see labelled_texts) -> Judge; None where a class is missing. Rows without text or of other labels are left out; equal texts are on the same side of the split."""
    rows = spool(labelled.filter("toxic in (0, 1) and text is not null").select("text", F.col("toxic").cast("int").alias("class"), (F.pmod(F.xxhash64("text"), F.lit(5)) == 0).alias("fits")), "labelled")
    sizes = {(r["class"], r["fits"]): r["n"] for r in rows.groupBy("class", "fits").agg(F.count("*").alias("n")).collect()}
    if not all(any(sizes.get((c, f)) for f in (True, False)) for c in (0, 1)):
        return None
    if not all(sizes.get((c, f)) for c in (0, 1) for f in (True, False)):  # too few to fit
        return Judge(KneserNey(count_strings(rows.select("text", "class"), ORDER, each=True)), PLAIN)
    shared = labelled.sparkSession.sparkContext.broadcast(KneserNey(count_strings(rows.filter("not fits").select("text", "class"), ORDER, each=True)))

    def features(batches):
        import pyarrow as pa

        for keys, x in _features(shared.value, batches):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], ["class", "x"])

    got = rows.filter("fits").select("class", "text").mapInArrow(features, "class int, x array<double>").toArrow()
    x, y = np.array(got.column("x").to_pylist()).reshape(-1, FEATURES), got.column("class").to_numpy().astype(float)
    shared.destroy()  # one model at a time on the driver
    x, y = x[_has_words(x)], y[_has_words(x)]
    if len(set(y)) < 2:
        return Judge(KneserNey(count_strings(rows.select("text", "class"), ORDER, each=True)), PLAIN)
    return Judge(KneserNey(count_strings(rows.select("text", "class"), ORDER, each=True)), _fit(x, y))


def score(docs: DataFrame, judge: Judge | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for each row and whole text; null counts as empty, repeated and null ids are judged each. Score 0 where a text has no word, and where nothing could be learned. Long texts are judged alone; further columns are ignored."""
    from pyspark.sql.pandas.types import to_arrow_type

    shared = docs.sparkSession.sparkContext.broadcast(judge)  # bounded by the sample
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = to_arrow_type(rows.schema["doc_id"].dataType)

    def judged(batches):
        import pyarrow as pa

        own = shared.value
        for keys, x in _features(own.model, batches) if own else ((k, np.zeros((len(t), FEATURES))) for k, t in by_chars(batches)):
            p = own.score(x) if own else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return rows.mapInArrow(judged, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def clean(docs: DataFrame, judge: Judge | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that score threshold or more; all columns stay. Each row is judged by its own text, so ids may repeat or be null; null, empty and wordless texts stay."""
    if judge is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(judge)
    at = docs.columns.index(text_col)

    def keep(batches):
        import pyarrow as pa

        scorer = Scorer(shared.value.model)
        for b in batches:
            for start, texts in text_slices(b.column(at), CHARS):
                yield b.slice(start, len(texts)).filter(pa.array(shared.value.score(scorer.features(texts)) < threshold))

    return docs.mapInArrow(keep, docs.schema)


def labelled_texts(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of about `sample` labelled rows of each class outside the held-out fold.

    Of an id that is labelled more than once, the largest label counts. The rows are drawn by a hash of the id among the
    labels alone; the ids drawn, bounded by the sample, are broadcast, so that no text shuffles.
    """
    own = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (learned("doc_id", folds) != held)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = spool(own.withColumn("draw", F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))), "labels")
    sizes = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for kind, n in sizes.items():
        share = F.when(F.col("toxic") == kind, min(1.0, sample / n)).otherwise(share)
    drawn = own.filter(F.col("draw") < share * 1_000_003).select(F.col("doc_id").alias("labelled_id"), "toxic")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(F.broadcast(drawn), F.col("doc_id") == F.col("labelled_id")).select("text", "toxic")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold and score all rows: doc_id, held_out, score, predicted."""
    judged = score(docs, train(labelled_texts(docs, labels, folds, held)))
    return judged.select("doc_id", (learned("doc_id", folds) == held).alias("held_out"), "score", "predicted")
