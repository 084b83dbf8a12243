"""Byte-pair encoding and decoding with a minimal acyclic transducer of frequent words.

1. Words (pre-tokens) are counted over all texts, each worker combining its own before they are shuffled.
2. The most frequent ones, `WORDS` at most, are merged once and compiled into a transducer whose transitions read a byte and
   write token ids; it is minimal, so that words share their beginnings and, where what is still to be written is the
   same, their endings too. As flat arrays it becomes a file in the shared folder, which Spark hands to every executor;
   workers map it into memory and run all distinct words of a batch through it at once, byte by byte.
3. A word that the transducer doesn't accept is merged by the ranks of the tokenizer itself. The lexicon is thus only a
   matter of speed: ids are the same whatever it holds.

Decoding writes the bytes of each id.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import uuid
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, rows_of
from .tokens import _KIND, _NOT_RUNS, by_chars, default_tokenizer

WORDS = 100_000  # words of the lexicon at most
LONGEST = 32  # bytes of a word of the lexicon at most
SLICE = 1_000_000  # characters of a long text that are encoded at once, if a blank follows
CACHE = 24_000_000  # bytes of unseen words and ids that a worker keeps, and 100 for each

_CUT = re.compile(r"(?<=\S) (?=\S)")


# ---- merges


class Merges:
    """What the tokenizer's file says: ranks of merges, ids of bytes, added tokens. encode() is for one pre-token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # fixed values: bytes that byte-level vocabularies write as themselves
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        model = spec["model"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or spec["pre_tokenizer"]["add_prefix_space"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("not a plain byte-level BPE")
        vocab = model["vocab"]
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()} | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.of_byte = [vocab[c] for c in sorted(byte_of, key=byte_of.get)]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.table = np.frombuffer(b"".join(table), np.uint8)
        self.sizes = np.array([len(t) for t in table])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def encode(self, word: bytes) -> list[int]:
        """Merges the pair of the lowest rank, the leftmost first, until none is left: a heap over a linked list."""
        ids = [self.of_byte[b] for b in word]
        n, ranks = len(ids), self.ranks
        if n < 2:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*found, i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := ranks.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, merged, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = merged, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if y < n and (found := ranks.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (*found, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.table[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


# ---- the transducer


class _Node:
    __slots__ = ("edges", "final")

    def __init__(self):
        self.edges, self.final = {}, None  # byte -> [output, node]; output at the end of a word, or None

    def key(self):
        return self.final, tuple((b, out, id(node)) for b, (out, node) in sorted(self.edges.items()))


def compile_words(words: dict[bytes, tuple[int, ...]]) -> dict[str, np.ndarray]:
    """The minimal transducer of words and their ids, as arrays.

    Words are added in order, so that all but the path of the last one is final. Outputs stand as early as they can: what a
    transition wrote is cut to what the new word also writes, and the rest is moved behind it. A finished state is replaced
    by an equal one, if there is any.
    """
    root, known, path, last = _Node(), {}, [], b""

    def close(to: int) -> None:
        """States of the last path below depth `to` are finished."""
        while len(path) > to:
            parent, byte = path.pop()
            edge = parent.edges[byte]
            edge[1] = known.setdefault(edge[1].key(), edge[1])

    for word in sorted(words):
        left = tuple(words[word])
        shared = len(os.path.commonprefix([word, last]))
        close(shared)
        for parent, byte in path:
            edge = parent.edges[byte]
            keep = len(os.path.commonprefix([edge[0], left]))
            if rest := edge[0][keep:]:
                node = edge[1]
                for below in node.edges.values():
                    below[0] = rest + below[0]
                if node.final is not None:
                    node.final = rest + node.final
                edge[0] = edge[0][:keep]
            left = left[keep:]
        at = path[-1][0].edges[path[-1][1]][1] if path else root
        for byte in word[shared:]:
            node = _Node()
            at.edges[byte] = [left, node]
            path.append((at, byte))
            left, at = (), node
        at.final = left
        last = word
    close(0)

    number, order = {id(root): 0}, [root]
    for node in order:
        for _, (_, below) in sorted(node.edges.items()):
            if id(below) not in number:
                number[id(below)] = len(order)
                order.append(below)
    keys, targets, outputs = [], [], []
    for k, node in enumerate(order):
        for byte, (out, below) in sorted(node.edges.items()):
            keys.append(k << 8 | byte)
            targets.append(number[id(below)])
            outputs.append(out)
    finals = [n.final for n in order]
    outputs += [f or () for f in finals]  # those of a state's end stand behind those of the transitions
    sizes = [len(o) for o in outputs]
    return {
        "keys": np.array(keys, np.int64), "targets": np.array(targets, np.int32), "accepts": np.array([f is not None for f in finals], np.uint8),
        "starts": np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), "ids": np.array([i for o in outputs for i in o], np.int32),
    }


_HEAD = 16
_PARTS = (("keys", np.int64), ("targets", np.int32), ("accepts", np.uint8), ("starts", np.int64), ("ids", np.int32))


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """A head of sizes, then each array at a multiple of eight bytes."""
    head = np.zeros(_HEAD, np.int64)
    head[: len(_PARTS)] = [len(arrays[name]) for name, _ in _PARTS]
    return head.tobytes() + b"".join((raw := arrays[name].astype(kind).tobytes()) + bytes(-len(raw) % 8) for name, kind in _PARTS)


class Transducer:
    """Over a buffer, such as a file that is mapped into memory."""

    def __init__(self, buffer):
        sizes, at = np.frombuffer(buffer, np.int64, _HEAD), 8 * _HEAD
        for (name, kind), n in zip(_PARTS, sizes, strict=False):
            setattr(self, name, np.frombuffer(buffer, kind, int(n), at))
            at += -(-int(n) * np.dtype(kind).itemsize // 8) * 8

    @classmethod
    def of_file(cls, path: str) -> Transducer:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def run(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(accepted, ids of all accepted words behind each other, where each word's begin and the last one's end). All words take their k-th step at once."""
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        alive = np.flatnonzero((sizes > 0) & (sizes <= LONGEST)) if len(self.keys) else np.zeros(0, np.int64)
        raw, begins = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
        state, accepted = np.zeros(n, np.int64), np.zeros(n, bool)
        went = np.full((n, min(LONGEST, int(sizes.max(initial=0))) + 1), -1, np.int64)  # transitions taken, and the end
        step = 0
        while len(alive):
            key = state[alive] << 8 | raw[begins[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            fits = self.keys[at] == key
            alive, at = alive[fits], at[fits]
            went[alive, step] = at
            state[alive] = self.targets[at]
            step += 1
            done = sizes[alive] == step
            ended = alive[done & (self.accepts[state[alive]] > 0)]
            accepted[ended] = True
            went[ended, step] = len(self.keys) + state[ended]
            alive = alive[~done]
        went[~accepted] = -1
        taken = went[went >= 0]
        of = np.repeat(np.arange(n), (went >= 0).sum(1))
        lens = (self.starts[1:] - self.starts[:-1])[taken]
        ends = np.cumsum(lens)
        ids = self.ids[np.repeat(self.starts[taken] - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)]
        return accepted, ids, np.concatenate(([0], np.cumsum(np.bincount(of, lens, n)))).astype(np.int64)


# ---- pre-tokens of texts


class Words:
    """Cuts texts into the pre-tokens of the tokenizer's file: plain runs by kinds of bytes, all else by the library's own rule."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.rule = Tokenizer.from_file(path).pre_tokenizer
        self.merges = Merges(path)

    def cut(self, texts: list[str]):
        """(distinct words as bytes, number of each occurrence, where each text's occurrences begin and the last one's end). Added tokens are words that begin with a zero byte and hold their id."""
        import pyarrow as pa
        import pyarrow.compute as pc

        vocab: dict[bytes, int] = {}
        where: list[np.ndarray] = [None] * len(texts)
        array = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(array, _NOT_RUNS).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~odd)
        if len(plain):
            self._runs(array.take(pa.array(plain)), plain, vocab, where)
        for k in np.flatnonzero(odd):
            where[k] = self._by_rule(texts[k], vocab)
        bounds = np.concatenate(([0], np.cumsum([len(w) for w in where]))).astype(np.int64)
        return list(vocab), np.concatenate(where) if where else np.zeros(0, np.int64), bounds

    def _runs(self, array, places, vocab, where) -> None:
        import pyarrow as pa

        raw = np.frombuffer(array.buffers()[2] or b"", np.uint8)
        offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
        raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
        kind = _KIND[raw]
        cut = kind < 2
        cut[1:] |= (kind[1:] != kind[:-1]) & (kind[:-1] != 0)
        cut[offsets[:-1][offsets[:-1] < len(raw)]] = True
        starts = np.flatnonzero(cut)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(raw.tobytes())]).dictionary_encode()
        number = np.fromiter((vocab.setdefault(w, len(vocab)) for w in words.dictionary.to_pylist()), np.int64, len(words.dictionary))
        flat = number[words.indices.to_numpy()]
        for k, part in zip(places, np.split(flat, np.searchsorted(starts, offsets[1:-1])), strict=True):
            where[k] = part

    def _by_rule(self, text: str, vocab: dict[bytes, int]) -> np.ndarray:
        out, at, merges = [], 0, self.merges
        for m in [*merges.added_pattern.finditer(text), None]:
            if part := text[at : m.start() if m else len(text)]:
                out += [vocab.setdefault(part[a:b].encode(), len(vocab)) for _, (a, b) in self.rule.pre_tokenize_str(part)]
            if m:
                out.append(vocab.setdefault(b"\0" + str(merges.added[m[0]]).encode() + b"\0", len(vocab)))
                at = m.end()
        return np.array(out, np.int64)


class Encoder:
    """ids of texts by a transducer, and by merges where it doesn't accept a word."""

    def __init__(self, path: str, lexicon: str | None):
        self.words = Words(path)
        self.merges = self.words.merges
        self.lexicon = Transducer.of_file(lexicon) if lexicon else None
        self.unseen, self.held = {}, 0
        self.texts_of = [str(i) for i in range(len(self.merges.sizes))]

    def _merge(self, word: bytes) -> np.ndarray:
        if word[:1] == b"\0" and word[-1:] == b"\0" and len(word) > 2 and word[1:-1].isdigit():
            return np.array([int(word[1:-1])], np.int32)
        if (ids := self.unseen.get(word)) is None:
            if self.held > CACHE:
                self.unseen.clear()
                self.held = 0
            ids = self.unseen[word] = np.array(self.merges.encode(word), np.int32)
            self.held += len(word) + 4 * len(ids) + 100
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts behind each other, where each text's begin and the last one's end)."""
        words, where, bounds = self.words.cut(texts)
        n = len(words)
        if self.lexicon:
            accepted, ids, at = self.lexicon.run(words)
        else:
            accepted, ids, at = np.zeros(n, bool), np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        sizes, starts = np.diff(at), at[:-1].copy()
        rest = np.flatnonzero(~accepted)
        more = [self._merge(words[k]) for k in rest]
        sizes[rest] = [len(m) for m in more]
        starts[rest] = len(ids) + np.cumsum(sizes[rest]) - sizes[rest]
        flat = np.concatenate([ids, *more]) if more else ids
        lens = sizes[where]
        ends = np.cumsum(lens)
        out = flat[np.repeat(starts[where] - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)]
        return out, np.concatenate(([0], ends))[bounds].astype(np.int64)

    def listed(self, ids: np.ndarray) -> str:
        return ",".join(map(self.texts_of.__getitem__, ids.tolist()))


def slices(text: str, chars: int = SLICE):
    """A text in parts that are cut before a blank between two other characters, where no pre-token and no added token goes on."""
    at = 0
    while len(text) - at > chars and (m := _CUT.search(text, at + chars)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, lexicon: str | None = None) -> Encoder:
    """One for each worker process; lexicon: the name of a file that Spark handed out."""
    key = (path, lexicon)
    if key not in _encoders:
        from pyspark import SparkFiles

        _encoders.clear()
        _encoders[key] = Encoder(path, lexicon and SparkFiles.get(lexicon))
    return _encoders[key]


# ---- with Spark


def word_counts(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word binary, n): how often each pre-token of LONGEST bytes at most stands in all texts."""
    tokenizer = tokenizer or default_tokenizer()

    def count(batches):
        import pyarrow as pa

        words = Words(tokenizer)
        total: Counter = Counter()
        for _, texts in by_chars(batches, SLICE):
            for part in _batches(texts):
                known, where, _ = words.cut(part)
                for w, n in zip(known, np.bincount(where, minlength=len(known)).tolist(), strict=True):
                    if len(w) <= LONGEST and w[:1] != b"\0":
                        total[w] += n
            if len(total) > 300_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
                total.clear()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    return rows_of(docs, id_col, text_col).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _batches(texts: list[str]):
    """The texts, long ones in slices: lists of about SLICE characters."""
    out, n = [], 0
    for t in texts:
        for part in slices(t):
            out.append(part)
            n += len(part)
            if n >= SLICE:
                yield out
                out, n = [], 0
    if out:
        yield out


def build(docs: DataFrame, tokenizer: str | None = None, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Counts, merges and compiles the `words` most frequent words that stand twice at least (ties to the smaller word); the name under which SparkFiles has the file."""
    tokenizer = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    counts = word_counts(docs, tokenizer, id_col, text_col)
    frequent = counts.filter("n > 1").orderBy(F.desc("n"), "word").limit(words).select("word").toArrow().column(0).to_pylist()
    merges = Merges(tokenizer)
    data = to_bytes(compile_words({w: tuple(merges.encode(w)) for w in frequent}))
    return _hand_out(spark, data)


def _hand_out(spark: SparkSession, data: bytes) -> str:
    """A file in the shared folder, which each executor fetches before its first task, new ones too."""
    name = f"lexicon-{uuid.uuid4().hex}"
    folder = fresh_path(spark, "lexicon")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    for at in range(0, len(data), 1 << 20):
        out.write(data[at : at + (1 << 20)])
    out.close()
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def encode(docs: DataFrame, tokenizer: str | None = None, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids: doc_id, ids array<int>. As the library encodes it without special tokens added; those that stand in a text are found there.

    Null texts count as empty and have no ids. Texts of any length are encoded whole; all ids of a document are one value.
    Rows are each encoded, equal ones alike; ids that are null or repeat are kept. Other columns of docs are not looked at.
    An empty table gives no rows.
    """
    import pyarrow as pa

    def rows(code, keys, texts):
        got = [[] for _ in keys]
        for k, ids in _encoded(code, texts):
            got[k].append(ids)
        return [pa.array([np.concatenate(g) if g else [] for g in got], pa.list_(pa.int32()))]

    return _encode(docs, tokenizer, words, id_col, text_col, rows, "ids array<int>")


def _encoded(code: Encoder, texts: list[str]):
    """(number of the text, ids of a slice of it), in order."""
    parts, of, n = [], [], 0
    for k, t in enumerate(texts):
        for part in slices(t):
            parts.append(part)
            of.append(k)
            n += len(part)
            if n >= SLICE:
                ids, at = code.encode(parts)
                yield from ((j, ids[a:b]) for j, a, b in zip(of, at, at[1:], strict=False))
                parts, of, n = [], [], 0
    if parts:
        ids, at = code.encode(parts)
        yield from ((j, ids[a:b]) for j, a, b in zip(of, at, at[1:], strict=False))


def _encode(docs: DataFrame, tokenizer: str | None, words: int, id_col: str, text_col: str, rows, columns: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    tokenizer = tokenizer or default_tokenizer()
    lexicon = build(docs, tokenizer, words, id_col, text_col) if words else None
    own = rows_of(docs, id_col, text_col)
    kind, names = to_arrow_type(own.schema["doc_id"].dataType), ["doc_id", *(c.split()[0] for c in columns.split(", "))]

    def run(batches):
        import pyarrow as pa

        code = encoder(tokenizer, lexicon)
        for keys, texts in by_chars(batches, SLICE):
            yield pa.RecordBatch.from_arrays([pa.array(keys, kind), *rows(code, keys, texts)], names)

    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, {columns}")


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text): the bytes of all ids, special tokens included; bytes that are no UTF-8 become U+FFFD. Null ids give a null text, unknown ids write nothing."""
    from pyspark.sql.pandas.types import to_arrow_type

    tokenizer = tokenizer or default_tokenizer()
    kind = to_arrow_type(encoded.schema["doc_id"].dataType)

    def run(batches):
        import pyarrow as pa

        merges = encoder(tokenizer).merges
        for b in batches:
            texts = [None if ids.as_py() is None else _text(merges, np.array(ids.values)) for ids in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def _text(merges: Merges, ids: np.ndarray) -> str:
    return merges.decode(ids[(ids >= 0) & (ids < len(merges.sizes))]).decode("utf-8", "replace")


def digests(docs: DataFrame, tokenizer: str | None = None, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As encode() and decode(), but of ids and text only their SHA-256: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256. Hashed slice by slice, so that no document's ids are one value."""
    import codecs

    import pyarrow as pa

    def rows(code, keys, texts):
        n = [0] * len(keys)
        lists, decoded = [hashlib.sha256() for _ in keys], [hashlib.sha256() for _ in keys]
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        last = -1
        for k, ids in _encoded(code, texts):
            if k != last and last >= 0:
                decoded[last].update(reader.decode(b"", True).encode())
                reader.reset()
            last = k
            if len(ids):
                lists[k].update(((n[k] and "," or "") + code.listed(ids)).encode())
                n[k] += len(ids)
                decoded[k].update(reader.decode(code.merges.decode(ids)).encode())
        if last >= 0:
            decoded[last].update(reader.decode(b"", True).encode())
        return [pa.array(n, pa.int64()), pa.array([x.hexdigest() for x in lists]), pa.array([x.hexdigest() for x in decoded])]

    return _encode(docs, tokenizer, words, id_col, text_col, rows, "n_tokens long, ids_sha256 string, decoded_sha256 string")
