"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to ORDER bytes with the counts of what followed. A byte's code length is
that of the longest context in which it was seen, plus the escapes from the longer ones (method C: the escape has as
many counts as the context has different followers); below order 0 all 256 bytes are alike. The statistics are frozen
after training, so that code lengths are exact and don't depend on the order of texts. Contexts begin anew at each word
(its first context is a blank), so that a text's code length is the sum over its words and a word is coded once.

The trees are made of a bounded sample of labelled rows: about SAMPLE of each language, chosen by a hash of the text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import learned
from .tokens import by_chars

ORDER = 4
SAMPLE = 2000  # labelled rows of each language, about
WORDS_KEPT = 700_000  # words whose code lengths a worker keeps

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def word_runs(texts: list[str]):
    """(words as a dictionary array, bounds of the texts): runs of ASCII letters and of bytes beyond ASCII."""
    import pyarrow as pa

    array = pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_binary())
    raw = np.frombuffer(array.buffers()[2] or b"", np.uint8)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[: len(array) + 1]
    letter = _LETTER[raw]
    cut = np.ones(len(raw), bool)
    cut[1:] = letter[1:] != letter[:-1]
    cut[offsets[:-1][offsets[:-1] < len(raw)]] = True
    starts = np.flatnonzero(cut)
    segments = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(raw)])
    own = letter[starts]
    bounds = np.concatenate(([0], np.cumsum(own)))[np.searchsorted(starts, offsets)]
    return segments.filter(pa.array(own)).dictionary_encode(), bounds


def _strings(words: list[bytes], order: int):
    """The packed strings of 1 to order + 1 bytes (8 at most) that end at each byte of the words between blanks, each byte's place in its word (strings that are longer than the place allows mean nothing; place 0, the leading blank, is not coded), and the word's number."""
    raw = np.frombuffer(b"".join([b" " + w + b" " for w in words]), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    place = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
    out = [raw]
    for k in range(1, order + 1):
        earlier = np.concatenate((np.zeros(k, np.uint64), raw[: max(0, len(raw) - k)]))[: len(raw)]
        out.append(out[-1] | (earlier << np.uint64(8 * k)))
    return out, place, np.repeat(np.arange(len(words)), size)


class Model:
    """Frozen counts of all languages: for each length the sorted packed strings, with their counts as (context, byte), and as contexts the followers' total and number."""

    def __init__(self, counted, langs: list[str], order: int, totals: bool = True):
        """counted: arrays (lang, k, gram, n), k + 1 being the gram's bytes. Without totals only the strings' own counts are kept."""
        self.langs, self.order, self.keys, self.n, self.total, self.kinds = langs, order, [], [], [], []
        lang, length, gram, n = counted
        gram = gram.astype(np.uint64)
        for k in range(order + 1):
            own = length == k
            keys = np.unique(gram[own])
            table = np.zeros((len(keys) + 1, len(langs)), np.float64 if totals else np.float32)
            np.add.at(table, (np.searchsorted(keys, gram[own]), lang[own]), n[own])
            self.keys.append(keys)
            self.n.append(table)
        for k in range(order + 1 if totals else 0):  # what follows each context of k bytes
            keys = self.keys[k - 1] if k else np.zeros(1, np.uint64)
            total, kinds = np.zeros((len(keys) + 1, len(langs))), np.zeros((len(keys) + 1, len(langs)))
            at = self._find(keys, self.keys[k] >> np.uint64(8)) if k else np.zeros(len(self.keys[k]), np.int64)
            np.add.at(total, at, self.n[k][:-1])
            np.add.at(kinds, at, self.n[k][:-1] > 0)
            total[-1] = kinds[-1] = 0
            self.total.append(total)
            self.kinds.append(kinds)

    @staticmethod
    def _find(keys: np.ndarray, packed: np.ndarray) -> np.ndarray:
        """Rows of packed strings; the last row, of zeros, for those that were never seen."""
        at = np.minimum(np.searchsorted(keys, packed), max(0, len(keys) - 1))
        return np.where(keys[at] == packed, at, len(keys)) if len(keys) else np.zeros(len(packed), np.int64)

    def bits(self, words: list[bytes]) -> np.ndarray:
        """Code length of each word (with the blank that ends it) in each language."""
        strings, place, word = _strings(words, self.order)
        coded = place > 0
        found = [np.where(place >= k, self._find(keys, s), len(keys)) for k, (keys, s) in enumerate(zip(self.keys, strings, strict=True))]
        cost = np.full((int(coded.sum()), len(self.langs)), 8.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            for k in range(self.order + 1):
                # the context of k bytes ended one byte earlier
                context = np.concatenate(([0], found[k - 1][:-1]))[coded] if k else np.zeros(len(cost), np.int64)
                total, kinds, own = self.total[k][context], self.kinds[k][context], self.n[k][found[k][coded]]
                whole = total + kinds
                better = np.where(own > 0, -np.log2(own / whole), cost - np.log2(kinds / whole))
                cost = np.where((total > 0) & (place[coded] >= k)[:, None], better, cost)
        out = np.zeros((len(words), len(self.langs)))
        for j in range(len(self.langs)):
            out[:, j] = np.bincount(word[coded], cost[:, j], len(words))
        return out


def count_strings(drawn: DataFrame, order: int, each: bool = False):
    """drawn (text, class int) -> arrays (class, k, gram, n) of the packed strings of all words; with `each` a word counts once a text, and texts are lower-cased. Counted where the rows are and summed; what comes to the driver is bounded by the sample that is drawn."""

    def count(batches):
        import pyarrow as pa

        for b in batches:
            text, kind = b.column(0).to_pylist(), np.array(b.column(1).to_pylist())
            for j in np.unique(kind):
                some = [text[r] for r in np.flatnonzero(kind == j)]
                for _, texts in by_chars([pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some, pa.string())], ["k", "t"])]):
                    found, bounds = word_runs([t.lower() for t in texts] if each else texts)
                    index, size = found.indices.to_numpy().astype(np.int64), len(found.dictionary)
                    if each and size:
                        index = np.unique(np.repeat(np.arange(len(texts)), np.diff(bounds)) * size + index) % size
                    weight = np.bincount(index, minlength=size)
                    strings, place, word = _strings(found.dictionary.to_pylist(), order)
                    for k, s in enumerate(strings):
                        own = (place > 0) & (place >= k)
                        grams, at = np.unique(s[own], return_inverse=True)
                        n = np.bincount(at, weight[word[own]], len(grams)).astype(np.int64)
                        yield pa.RecordBatch.from_pydict({"class": pa.array(np.full(len(grams), j, np.int32)), "k": pa.array(np.full(len(grams), k, np.int32)), "gram": pa.array(grams.view(np.int64)), "n": pa.array(n)})

    counted = drawn.mapInArrow(count, "class int, k int, gram long, n long").groupBy("class", "k", "gram").agg(F.sum("n").alias("n")).toArrow()
    own = {c: counted.column(c).to_numpy() for c in ("class", "k", "gram", "n")}
    return own["class"], own["k"], own["gram"].astype(np.int64).view(np.uint64), own["n"]


def train(labelled: DataFrame, order: int = ORDER, sample: int = SAMPLE) -> Model:
    """labelled (text, lang) -> frozen statistics."""
    rows = labelled.filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    langs = sorted(sizes)
    if not langs:
        return Model((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], order)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))])
    drawn = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < F.element_at(share, F.col("lang")) * 1_000_003)
    number = F.element_at(F.create_map(*[F.lit(x) for k, lang in enumerate(langs) for x in (lang, k)]), F.col("lang"))
    return Model(count_strings(drawn.select("text", number.cast("int").alias("class")), order), langs, order)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for each row and whole text. `und` with score 0 for null texts, texts without letters, and if nothing was learned.

    score: the share of the best language if each weighs 2 to the power of minus its code length per word. Ties go to
    the first language by name.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = to_arrow_type(rows.schema["doc_id"].dataType)

    def judge(batches):
        import pyarrow as pa

        own = shared.value
        place: dict[bytes, int] = {}
        table = np.zeros((1 << 12, max(1, len(own.langs))), np.float32)
        for keys, texts in by_chars(batches, 5_000_000):
            found, bounds = word_runs(texts)
            vocabulary, index = found.dictionary.to_pylist(), found.indices.to_numpy()
            if len(place) > WORDS_KEPT:
                place.clear()
            new = [w for w in vocabulary if w not in place]
            while len(place) + len(new) > len(table):
                table = np.concatenate((table, np.zeros_like(table)))
            if own.langs:
                for i in range(0, len(new), 20000):
                    table[len(place) + i : len(place) + min(i + 20000, len(new))] = own.bits(new[i : i + 20000])
            place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
            rows_ = np.fromiter(map(place.__getitem__, vocabulary), np.int64, len(vocabulary))[index]
            sums = np.zeros((len(index) + 1, table.shape[1]))
            np.cumsum(table[rows_], axis=0, dtype=np.float64, out=sums[1:])
            bits, n = sums[bounds[1:]] - sums[bounds[:-1]], np.diff(bounds)
            best = bits.argmin(axis=1)
            each = bits / np.maximum(n, 1)[:, None]
            score = 1 / np.exp2(each[np.arange(len(each)), best][:, None] - each).sum(axis=1)
            # only texts of runs without ASCII letters can lack letters; those are looked at
            none = [not own.langs or m == 0 or not any(c.isalpha() for c in t) for t, m in zip(texts, n.tolist(), strict=True)]
            langs = ["und" if x else own.langs[k] for k, x in zip(best.tolist(), none, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(langs, pa.string()), pa.array(np.where(none, 0.0, score))], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(judge, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from rows whose fold is not `held` and judge all rows: doc_id, held_out, lang_pred, score. A null doc_id counts as -1 for the fold."""
    labelled = docs.filter(learned(id_col, folds) != held).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    judged = predict(docs, train(labelled), id_col, text_col)
    return judged.select("doc_id", (learned("doc_id", folds) == held).alias("held_out"), "lang_pred", "score")
