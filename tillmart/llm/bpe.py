"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

Every word of a batch is one row of a segment tree whose leaves are the ranks of its adjacent
symbol pairs; an inner node keeps the smaller child, the left one on ties. The root therefore names
the leftmost pair of lowest rank. A merge replaces two symbols, changes at most three leaves and
repairs their paths to the root: a logarithmic number of nodes. Rows advance together in numpy
until no row has a pair that can merge. Words are grouped by the power of two that holds them, so a
long word costs its own length only.

The vocabulary file is in the format of the ``tokenizers`` library: NFC, runs of white space to one
blank, lower case, split into words, single digits and runs of signs, bytes as printable characters,
a suffix on the last symbol of a word. Special tokens in a text become their own ids. Decoding joins
the tokens' strings with blanks, as the library does for a file without a decoder.

Defined cases: null is an empty text, which has no tokens and decodes to an empty text. Characters
that Unicode assigned after version 15.1 may be split otherwise than by another library, whose tables
differ.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.frames import add_columns

#: The pattern that splits a text into words, as the vocabulary file has it.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for lower-case ASCII text.
ASCII_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\r\x0b\x0ca-z0-9]+"
#: Bytes of distinct words and their ids that a task keeps between batches, with what Python adds to each.
KEPT_BYTES, WORD_BYTES = 24 << 20, 160
#: Bytes of a batch of texts that are encoded at a time.
BATCH_BYTES = 2 << 20
#: Above all ranks (ids, and so merges, have 20 bits); times a row's width it stays below 2**63.
_NONE = np.int64(1 << 20)


def byte_characters() -> list[str]:
    """Byte-level BPE's printable character of every byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Bpe:
    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*ids.values(), *self.specials.values()]) + 1)
        for token, i in [*ids.items(), *self.specials.items()]:
            self.tokens[i] = token
        shown = byte_characters()
        self.inner = np.array([ids[c] for c in shown])
        self.final = np.array([ids[c + suffix] for c in shown])
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([ids[a] << 20 | ids[b] for a, b in pairs])
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([ids[a + b] for a, b in pairs])  # by rank
        self.special = regex.compile("|".join(map(regex.escape, self.specials)) or "(?!)")
        self.words = regex.compile(WORDS)
        self.ascii_words = re.compile(ASCII_WORDS)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``_NONE`` where it doesn't merge or a side is missing (-1)."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], _NONE)

    def split(self, text: str) -> list[str]:
        """Normalised words; special tokens stay as they are in the text, marked by a NUL before."""
        if "<|" not in text:
            return self._words(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += self._words(text[at : found.start()])
            out.append("\0" + found[0])
            at = found.end()
        return out + self._words(text[at:])

    def _words(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma
        return self.words.findall(text.lower())

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        raw = [w.encode() for w in words]
        sizes = np.array([len(b) for b in raw])
        for k, word in enumerate(words):
            if word[0] == "\0" and word[1:] in self.specials:
                out[k] = np.array([self.specials[word[1:]]])
                sizes[k] = 0
        width = 2
        while (sizes > width // 2).any() or width == 2:
            rows = np.flatnonzero((sizes > (width // 2 if width > 2 else 0)) & (sizes <= width))
            step = max(1, (1 << 18) // width)
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                symbols, kept = self._merge([raw[k] for k in part], sizes[part], width)
                ends = np.cumsum(kept)
                for k, ids in zip(part, np.split(symbols, ends[:-1]), strict=True):
                    out[k] = ids
            width *= 2
        return out

    def _merge(self, raw: list[bytes], sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left of all rows in a row, and their number per row."""
        n, all_rows = len(raw), np.arange(len(raw))
        places = np.arange(width)
        used = places < sizes[:, None]
        symbols = np.full((n, width), -1)
        symbols[used] = self.inner[np.frombuffer(b"".join(raw), np.uint8)]
        symbols[all_rows, sizes - 1] = self.final[[b[-1] for b in raw]]
        after = np.minimum(np.tile(places + 1, (n, 1)), width)  # next and previous symbol still there
        before = np.tile(places - 1, (n, 1))
        tree = np.full((n, 2 * width), _NONE * width)  # rank * width + place, so that ties go left
        right = np.concatenate([symbols[:, 1:], np.full((n, 1), -1)], 1)
        tree[:, width:] = self.rank(symbols, right) * width + places
        level = width // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        live = np.flatnonzero(tree[:, 1] < _NONE * width)
        while len(live):
            rank, at = np.divmod(tree[live, 1], width)
            gone = after[live, at]
            symbols[live, at] = self.merged[rank]
            symbols[live, gone] = -1
            new = after[live, gone]
            after[live, at] = new
            inside = new < width
            before[live[inside], new[inside]] = at[inside]
            previous = before[live, at]
            following = np.where(inside, symbols[live, np.minimum(new, width - 1)], -1)
            earlier = np.where(previous >= 0, symbols[live, np.maximum(previous, 0)], -1)
            own = symbols[live, at]
            self._set(tree, live, at, self.rank(own, following) * width + at, width)
            self._set(tree, live, gone, np.full(len(live), _NONE * width), width)
            has = previous >= 0
            self._set(tree, live[has], previous[has], (self.rank(earlier, own) * width + previous)[has], width)
            live = live[tree[live, 1] < _NONE * width]
        left = symbols >= 0
        return symbols[left], left.sum(1)

    @staticmethod
    def _set(tree: np.ndarray, rows: np.ndarray, at: np.ndarray, values: np.ndarray, width: int) -> None:
        """Point update of one leaf per row, up to the root."""
        node = at + width
        tree[rows, node] = values
        while width > 1:
            node, width = node >> 1, width >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def encode_distinct(self, texts: list[str | None]) -> tuple[list[list[int]], list[np.ndarray]]:
        """Per text the places of its words in a list of the distinct words' ids."""
        seen: dict[str, int] = {}
        docs = [[seen.setdefault(w, len(seen)) for w in self.split(t)] if t else [] for t in texts]
        return docs, self.encode_words(list(seen))

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        docs, words = self.encode_distinct(texts)
        lists = [w.tolist() for w in words]
        return [[i for k in doc for i in lists[k]] for doc in docs]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(1)
def parsed(vocabulary: str) -> Bpe:
    return Bpe(vocabulary)


def read(path: str) -> str:
    """The text of a vocabulary file, which only the driver has to see; executors get it by broadcast."""
    with open(path, encoding="utf-8") as file:
        return file.read()


class Encoder:
    """Ids of one batch of texts after the other; words that came before are looked up."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.clear()

    def clear(self) -> None:
        self.seen: dict[str, int] = {}  # words of this and earlier batches, in the order of the lists
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)  # their ids in a row
        self.held = 0

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and per text the offset of its first."""
        seen = self.seen
        docs = [[seen.setdefault(w, len(seen)) for w in self.bpe.split(t)] if t else [] for t in texts.to_pylist()]
        fresh = list(islice(seen, len(self.sizes), None))
        new = self.bpe.encode_words(fresh)
        self.flat = np.concatenate([self.flat, *new]).astype(np.int32)
        self.sizes = np.concatenate([self.sizes, np.array([len(w) for w in new], np.int64)])
        starts = np.cumsum(self.sizes) - self.sizes
        words = np.fromiter(chain.from_iterable(docs), np.int64)
        ends = np.concatenate([[0], np.cumsum(self.sizes[words])]).astype(np.int64)
        ids = self.flat[np.repeat(starts[words] - ends[:-1], self.sizes[words]) + np.arange(ends[-1])]
        offsets = ends[np.cumsum([0, *map(len, docs)])]
        self.held += sum(map(len, fresh)) + sum(w.nbytes for w in new) + WORD_BYTES * len(fresh)
        if self.held > KEPT_BYTES:
            self.clear()
        return ids, offsets


def _lists(ids: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)), pa.array(np.diff(offsets))]


def _joined(tokens: pa.Array, ids: pa.Array, offsets: np.ndarray) -> pa.Array:
    parts = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), tokens.take(ids))
    return pc.binary_join(parts, pa.scalar(" ", pa.large_string()))


_IDS = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType())]
_DECODED = T.StructField("decoded", T.StringType())


def encode(df: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (array of int) and ``n_tokens``; ``vocabulary`` is a file of the driver's."""
    held = df.sparkSession.sparkContext.broadcast(read(vocabulary))

    def run(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        encoder = Encoder(parsed(held.value))
        for column in columns:
            yield _lists(*encoder(column))

    return add_columns(df, text, _IDS, run, BATCH_BYTES)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``; null ids decode to an empty text."""
    held = df.sparkSession.sparkContext.broadcast(read(vocabulary))

    def run(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        tokens = pa.array(parsed(held.value).tokens, pa.large_string())
        for column in columns:
            offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())])
            yield [_joined(tokens, column.flatten(), offsets)]

    return add_columns(df, ids, [_DECODED], run, BATCH_BYTES)


def encode_decode(df: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``, ``n_tokens`` and ``decoded``: both ways in one Python stage, so that a core has one
    worker, and one vocabulary, at a time."""
    held = df.sparkSession.sparkContext.broadcast(read(vocabulary))

    def run(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        bpe = parsed(held.value)
        encoder, tokens = Encoder(bpe), pa.array(bpe.tokens, pa.large_string())
        for column in columns:
            ids, offsets = encoder(column)
            yield [*_lists(ids, offsets), _joined(tokens, pa.array(ids), offsets)]

    return add_columns(df, text, [*_IDS, _DECODED], run, BATCH_BYTES)


def digests(df: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``, ``n_tokens`` and ``decoded`` by ``encode_decode``, and SHA-256 of the
    ids', joined by blanks, and of the decoded text."""
    both = encode_decode(df, vocabulary, text)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.withColumns({"ids_sha256": F.sha2(ids, 256), "decoded_sha256": F.sha2("decoded", 256)})
