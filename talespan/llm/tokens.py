"""Problem 7: encoding of the whole corpus with a public byte-level BPE tokenizer.

Method: batched numpy merge rounds. The symbols of many words lie in one flat array; each round
looks every neighbouring pair up by binary search over the sorted pair keys, finds the lowest
rank of each word and merges all its occurrences, until no pair has a rank.

Texts are first cut at single blanks between non-blanks, where the tokenizer's own split always
cuts, so a unit (a blank and what follows) has the same ids wherever it occurs. Units are
remembered per Python worker (bounded, forgetting costs only time); only new ones are split and
merged, and the ids of a batch are gathered by numpy. One pass without any shuffle.

Cases: null and empty texts get an empty list; the special token's text is ordinary text;
duplicates are encoded like any other row; texts of any length are encoded whole; null doc_id
stays null; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame

from talespan.runtime import local_file, share_file, spread

#: Unicode white space, as tokenizers understand \s.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_RUN = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_MOST_UNITS = 1_000_000
_BATCH_CHARS = 4_000_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary file lies: the installed package's path, else /opt/tokenizers."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return f"/opt/tokenizers/{name}"


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeTable:
    """Ids of single bytes and, for every pair that merges, its key, rank and product."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.of_byte = np.zeros(256, np.int64)
        for c, b in _byte_alphabet().items():
            self.of_byte[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        keys = left << 20 | right
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each word). No word may be empty."""
        raw = [w.encode("utf-8") for w in words]
        sym = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        done_sym, done_word = [], []
        none = len(self.keys)
        while len(sym):
            same = word[:-1] == word[1:]
            key = sym[:-1] << 20 | sym[1:]
            at = np.searchsorted(self.keys, key)
            at[at == none] = 0
            hit = same & (self.keys[at] == key)
            rank = np.where(hit, self.rank[at], none)
            rank = np.append(rank, none)
            first = np.r_[0, np.flatnonzero(~same) + 1]
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(sym)])
            of_word = np.repeat(least, size)
            live = of_word < none
            if not live.all():
                done_sym.append(sym[~live])
                done_word.append(word[~live])
            merge = live & (rank == of_word)
            # In x x x only every second pair of a row of equal pairs merges.
            where = np.flatnonzero(merge)
            if len(where) > 1:
                near = np.diff(where) == 1
                if near.any():
                    heads = np.r_[0, np.flatnonzero(~near) + 1]
                    place = np.arange(len(where)) - np.repeat(heads, np.diff(np.r_[heads, len(where)]))
                    merge[where[place % 2 == 1]] = False
                    where = np.flatnonzero(merge)
            keep = live.copy()
            keep[where + 1] = False
            sym[where] = self.product[at[where]]
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return np.empty(0, np.int32), np.zeros(len(raw), np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.int32), np.bincount(word, minlength=len(raw))


class _Units(dict):
    """Unit -> number; an unknown unit gets the next number and is noted as new."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, unit):
        n = self[unit] = len(self)
        self.new.append(unit)
        return n


class Encoder:
    """Encodes batches of texts; remembers units and words it has met."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        self._forget()

    def _forget(self) -> None:
        self.units, self.words = _Units(), _Units()
        self.flat = np.empty(1 << 16, np.int32)
        self.used = 0
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.word_ids: list[np.ndarray] = []

    def _learn(self) -> None:
        """Ids of the new units: a str follows a blank, a tuple starts a text."""
        new, self.units.new = self.units.new, []
        split = [_WORDS.findall(u[0] if isinstance(u, tuple) else " " + u) for u in new]
        numbers = [[self.words[w] for w in ws] for ws in split]
        fresh, self.words.new = self.words.new, []
        if fresh:
            ids, sizes = self.table.encode(fresh)
            self.word_ids += np.split(ids, np.cumsum(sizes)[:-1])
        sizes, parts = [], []
        for ns in numbers:
            got = [self.word_ids[n] for n in ns]
            parts += got
            sizes.append(sum(map(len, got)))
        ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(len(self.flat), np.int32)])
        self.flat[self.used:self.used + len(ids)] = ids
        sizes = np.array(sizes, np.int64)
        self.start = np.r_[self.start, self.used + np.cumsum(sizes) - sizes]
        self.size = np.r_[self.size, sizes]
        self.used += len(ids)

    def _numbers(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(unit numbers of all texts in a row, number of units of each text)."""
        if len(self.units) > _MOST_UNITS:
            self._forget()
        get, run, rows, counts = self.units.__getitem__, _RUN.search, [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                units = text.split(" ") if not run(text) else _CUT.split(text)
                units[0] = (units[0],)
                rows.append(np.fromiter(map(get, units), np.int64, len(units)))
                counts[i] = len(units)
        if self.units.new:
            self._learn()
        return np.concatenate(rows) if rows else np.empty(0, np.int64), counts

    @staticmethod
    def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(values)]
        ends = np.cumsum(counts)
        return total[ends] - total[ends - counts]

    def counts(self, texts: list) -> np.ndarray:
        """Number of ids of each text."""
        numbers, counts = self._numbers(texts)
        return self._per_text(self.size[numbers], counts)

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of the texts, one more than texts)."""
        numbers, counts = self._numbers(texts)
        size = self.size[numbers]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        gather = np.arange(total) + np.repeat(self.start[numbers] - (ends - size), size)
        return self.flat[gather], np.r_[0, np.cumsum(self._per_text(size, counts))]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The Python worker's encoder for a vocabulary file; kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(local_file(path))
    return _ENCODERS[path]


def slices(batch: pa.RecordBatch, column: int, most: int = _BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text; a longer text is a slice of its own."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def encode_documents(documents: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and ids (list of token ids) of every row."""
    path = share_file(documents.sparkSession, path or tokenizer_path())
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for part in slices(batch, 1):
                ids, offsets = enc.encode(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[id_col, "ids"])

    return spread(documents.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def count_tokens(documents: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and n_tokens of every row."""
    path = share_file(documents.sparkSession, path or tokenizer_path())
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for part in slices(batch, 1):
                n = enc.counts(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64())], names=[id_col, "n_tokens"])

    return spread(documents.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint")
