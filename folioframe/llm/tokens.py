"""Token ids of whole texts by the tokenizers library, each distinct stretch of text encoded once.

A byte-level BPE of this kind merges only within pre-tokens. Texts are cut at places that surely part pre-tokens, each
distinct piece of a batch is looked up in a bounded cache, and only pieces that are not in it go through the library.
The ids are those of the whole text. Two ways to cut:

- texts of letters, digits and common marks in which no two blanks meet: at the ends of each run of one kind;
- all others: at blanks that stand between two characters which are not white space.
"""

from __future__ import annotations

import os
import re

import numpy as np

CACHE = 48_000_000  # bytes of pieces and ids that a worker keeps, and 100 for each piece; when they are more, the cache starts again

_BLANK = re.compile(r"(?<=\S) (?=\S)")
_LETTERS, _MARKS = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}", r".,;:!?%&*$#()\"/=_+\-|@"
#: What a text of runs doesn't have; < and ' are left out because of special tokens and contractions.
_NOT_RUNS = rf"[^{_LETTERS}0-9{_MARKS} \n]|[ \n][ \n]| $"
#: Of each byte of a text of runs: 0 blank, 1 newline, 2 mark, 3 digit, 4 letter (all bytes of letters beyond ASCII).
_KIND = np.full(256, 2, np.uint8)
_KIND[32], _KIND[10], _KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 0, 1, 3, 4, 4, 4


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """encode(texts) -> (ids, offsets): ids of all texts behind each other, and where each text's begin."""

    def __init__(self, path: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 65536 else np.uint32
        letters = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # fixed values: bytes that byte-level vocabularies write as themselves
        self.alphabet = {b: b for b in letters} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in letters)}
        self.limit, self.cache, self.held = cache, {}, 0

    def _encode(self, pieces: list[str]) -> list[bytes]:
        kind = self.kind
        return [np.array(e.ids, dtype=kind).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _encode_runs(self, runs: list[str]) -> list[bytes]:
        """Of pre-tokens: straight by the library's model, which takes bytes in the vocabulary's own letters."""
        tokenize, alphabet, kind = self.tokenizer.model.tokenize, self.alphabet, self.kind
        coded = [[t.id for t in tokenize(r.encode().decode("latin-1").translate(alphabet))] for r in runs]
        flat = np.array([i for c in coded for i in c], kind).tobytes()
        ends = np.cumsum([len(c) for c in coded]) * np.dtype(kind).itemsize
        return [flat[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _pieces(self, pieces: list[str], runs: bool) -> list[bytes]:
        """Ids of each piece, by the cache."""
        cache = self.cache
        if self.held > self.limit:
            cache.clear()
            self.held = 0
        new = list({p for p in pieces if p not in cache})
        for i in range(0, len(new), 4096):
            some = new[i : i + 4096]
            coded = (self._encode_runs if runs else self._encode)(some)
            self.held += sum(map(len, some)) + sum(map(len, coded)) + 100 * len(some)
            cache.update(zip(some, coded, strict=True))
        return [cache[p] for p in pieces]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa
        import pyarrow.compute as pc

        if not texts:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        array = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(array, _NOT_RUNS).to_numpy(zero_copy_only=False)
        some = [np.flatnonzero(~odd), np.flatnonzero(odd)]
        got = [f(array.take(pa.array(k))) if len(k) else (np.zeros(0, self.kind), np.zeros(1, np.int64)) for f, k in zip((self._by_runs, self._by_blanks), some, strict=True)]
        if not len(some[1]) or not len(some[0]):
            ids, offsets = got[bool(len(some[1]))]
            return ids.astype(np.uint32), offsets
        sizes = np.zeros(len(texts), np.int64)
        for k, (_, o) in zip(some, got, strict=True):
            sizes[k] = np.diff(o)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        out = np.empty(offsets[-1], np.uint32)
        for k, (ids, o) in zip(some, got, strict=True):
            out[np.repeat(offsets[k] - o[:-1], np.diff(o)) + np.arange(len(ids))] = ids
        return out, offsets

    def _gather(self, coded: list[bytes], where: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lens = np.fromiter(map(len, coded), np.int64, len(coded)) // np.dtype(self.kind).itemsize
        flat = np.frombuffer(b"".join(coded), self.kind)
        starts = np.concatenate(([0], np.cumsum(lens)))[:-1]
        n = lens[where]
        ends = np.cumsum(n)
        ids = flat[np.repeat(starts[where] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate(([0], ends))[bounds]

    def _by_runs(self, array) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa

        raw = np.frombuffer(array.buffers()[2], np.uint8)
        offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
        raw = raw[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kind = _KIND[raw]
        cut = kind < 2
        cut[1:] |= (kind[1:] != kind[:-1]) & (kind[:-1] != 0)
        cut[offsets[:-1][offsets[:-1] < len(raw)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts, len(raw)).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(raw)).dictionary_encode()
        bounds = np.searchsorted(starts, offsets)
        return self._gather(self._pieces(words.dictionary.to_pylist(), True), words.indices.to_numpy().astype(np.int64), bounds)

    def _by_blanks(self, array) -> tuple[np.ndarray, np.ndarray]:
        cut = [[c[0], *(" " + x for x in c[1:])] for c in map(_BLANK.split, array.to_pylist())]
        bounds = np.concatenate(([0], np.cumsum([len(c) for c in cut])))
        vocab: dict[str, int] = {}
        where = np.fromiter((vocab.setdefault(x, len(vocab)) for c in cut for x in c), np.int64, bounds[-1])
        return self._gather(self._pieces(list(vocab), False), where, bounds)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def by_chars(batches, chars: int = 2_000_000):
    """(ids, texts) lists of about so many characters from Arrow batches of (id, text): bounded memory for long texts."""
    keys, texts, n = [], [], 0
    for b in batches:
        for at in range(0, b.num_rows, 256):
            some = b.slice(at, 256)
            for k, t in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                keys.append(k)
                texts.append(t or "")
                n += len(texts[-1])
                if n >= chars:
                    yield keys, texts
                    keys, texts, n = [], [], 0
    if keys:
        yield keys, texts


def text_slices(column, chars: int = 2_000_000):
    """(start, texts) of a column of texts, slices of about so many characters one after the other."""
    start, texts, n = 0, [], 0
    for at in range(0, len(column), 256):
        for t in column.slice(at, 256).to_pylist():
            texts.append(t or "")
            n += len(texts[-1])
            if n >= chars:
                yield start, texts
                start, texts, n = start + len(texts), [], 0
    if texts:
        yield start, texts
