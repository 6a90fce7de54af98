"""Language-model scoring with Brown's class-based bigrams.

P(w | previous) = P(class(w) | class(previous)) * P(w | class(w)). Classes come from exchange
clustering: the ``CORE`` most frequent training words are moved between ``CLASSES`` classes as long as
that raises the likelihood of their bigrams, and every other training word goes to the class that its
neighbours make most likely. From this start sweeps exchange all words of all training documents: the
neighbours' classes of every word are counted, sharded by hash, each word moves to its best class under
the class bigrams so far, and the bigrams are counted anew, until a sweep gains less than ``GAIN`` a
token; one that loses likelihood is undone. The end of a text is a class of its own; unseen words, and
before the sweeps words without a clustered neighbour, form one more.

A token is a word ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, known by its 64-bit hash, or the end.

Texts are tokenised once, into blocks of documents: sorted distinct hashes and the tokens' places among
them. What a block says about its words is cut into slices by hash range (shards), summed per shard,
and answered in the order of the slices, so no word, text or vocabulary passes the driver: it gets N,
V, the core words, their classes and class totals only, all of fixed size. A frequent word costs one
entry per block.

Smoothing: words (c + 0.5) / (N_class + 0.5 * types), with one type for unseen words; transitions are
mixed with the classes' own shares, weighing ``BLEND`` tokens. Both sum to one.

Defined cases: null is an empty text, which has one token (the end); without training rows every
token has probability 1; rows with null ids are scored and never learned from where the caller says
so; repeated rows are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.hashing import slices, word_hashes
from tillmart.workspace import Workspace

CORE = 1024
CLASSES = 32
SWEEPS = 10
#: Of log-likelihood (natural) per training token.
GAIN = 0.002
BLEND = 50.0
BLOCK_TOKENS = 1 << 19
SHARD_ENTRIES = 400_000
END = np.uint64(0x6A09E667F3BCC908)
END_CLASS, OTHER = CLASSES, CLASSES + 1  # numbers of the two extra classes
KINDS = CLASSES + 2

_BLOCKS = "block bigint, doc_ids array<bigint>, train array<boolean>, offsets binary, tokens binary, vocabulary binary, n_vocabulary bigint"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(a.tobytes())


def _unpack(b: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _table(names: str, rows: list[tuple]) -> pa.Table:
    """An Arrow table from rows; ``names`` is a Spark schema of bigint, double, binary and arrays."""
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(),
        "array<bigint>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "boolean": pa.bool_(),
    }
    fields = [f.strip().split(" ") for f in names.split(",")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.table([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def encode(docs: DataFrame) -> DataFrame:
    """Blocks of ``docs`` (doc_id, text, train)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids: list = []
        train: list = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def block() -> Iterator[pa.RecordBatch]:
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
            vocabulary, places = np.unique(np.concatenate(parts), return_inverse=True)
            row = ((task << 32) + number, ids, train, offsets.tobytes(), _pack(places.astype(np.uint32)), vocabulary.tobytes(), len(vocabulary))
            yield from _table(_BLOCKS, [row]).to_batches()

        for batch in batches:
            for part in slices(batch):
                hashes, first = word_hashes(part.column(1))
                n = part.num_rows
                tokens = np.full(len(hashes) + n, END, np.uint64)
                inner = np.ones(len(tokens), bool)
                inner[first[1:] + np.arange(n)] = False
                tokens[inner] = hashes
                ids += part.column(0).to_pylist()
                train += part.column(2).to_pylist()
                parts.append(tokens)
                sizes.append(np.diff(first) + 1)
                if sum(map(len, parts)) >= BLOCK_TOKENS:
                    yield from block()
                    number += 1
                    ids, train, parts, sizes = [], [], [], []
        if ids:
            yield from block()

    return docs.select(F.col("doc_id").cast("bigint"), "text", "train").mapInArrow(run, _BLOCKS)


@dataclass
class Block:
    number: int
    ids: list
    train: np.ndarray  # per document
    offsets: np.ndarray
    tokens: np.ndarray
    vocabulary: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        return cls(
            row["block"], row["doc_ids"], np.array(row["train"], bool), np.frombuffer(row["offsets"], np.int64),
            _unpack(row["tokens"], np.uint32), np.frombuffer(row["vocabulary"], np.uint64),
        )

    def learned(self) -> np.ndarray:
        """Per token whether its document is for training."""
        return np.repeat(self.train, np.diff(self.offsets))

    def before(self, values: np.ndarray, start: int) -> np.ndarray:
        """Per token the value of the one before; a text starts after an end."""
        return np.concatenate([np.array([start], values.dtype), values[:-1]])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block.of(batch.slice(i, 1).to_pylist()[0])


def _shards(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bounds of the slices of sorted hashes: shard k has [bounds[k], bounds[k + 1])."""
    of = ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
    return np.searchsorted(of, np.arange(n + 1))


def count(blocks: DataFrame, n_shards: int) -> DataFrame:
    """Per shard: n training tokens, v distinct ones, and its most frequent words with counts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            counts = np.bincount(b.tokens[b.learned()], minlength=len(b.vocabulary))
            bounds = _shards(b.vocabulary, n_shards)
            rows = []
            for k in np.flatnonzero(np.diff(bounds)):
                own = slice(bounds[k], bounds[k + 1])
                seen = counts[own] > 0
                rows.append((int(k), b.vocabulary[own][seen].tobytes(), _pack(counts[own][seen].astype(np.uint32))))
            yield from _table("shard bigint, hashes binary, counts binary", rows).to_batches()

    def add(table: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()])
        counts = np.concatenate([_unpack(x, np.uint32) for x in table["counts"].to_pylist()])
        words, at = np.unique(hashes, return_inverse=True)
        total = np.bincount(at, counts, len(words)).astype(np.int64)
        top = np.lexsort((words.view(np.int64), -total))[:CORE]  # ties as Spark orders them
        row = (int(total.sum()), len(words), words[top].view(np.int64).tolist(), total[top].tolist())
        return _table("n bigint, v bigint, words array<bigint>, counts array<bigint>", [row])

    pieces = blocks.mapInArrow(cut, "shard bigint, hashes binary, counts binary")
    return pieces.groupBy("shard").applyInArrow(add, "n bigint, v bigint, words array<bigint>, counts array<bigint>")


def core_bigrams(blocks: DataFrame, core: np.ndarray) -> DataFrame:
    """Counts (i, j, n) of core word i before core word j in training documents; ``core`` is sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(core)
        held = np.zeros(size * size, np.int64)
        for b in _blocks(batches):
            own = _places(core, b.vocabulary)[b.tokens]
            last = b.before(own, int(np.searchsorted(core, END)))
            both = (own >= 0) & (last >= 0) & b.learned()
            held += np.bincount(last[both] * size + own[both], minlength=size * size)
        at = np.flatnonzero(held)
        for start in range(0, len(at), 100_000):
            part = at[start : start + 100_000]
            columns = [pa.array(x.astype(np.int64)) for x in (part // size, part % size, held[part])]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "n"])

    return blocks.mapInArrow(run, "i bigint, j bigint, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n"))


def _places(core: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Place of each word in the sorted core, -1 outside."""
    at = np.minimum(np.searchsorted(core, words), len(core) - 1)
    return np.where(core[at] == words, at, -1)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, end: int) -> np.ndarray:
    """Classes of the core words: each word in turn, frequent ones first, goes where the bigrams'
    likelihood is highest, until nothing moves or ``SWEEPS`` are over. ``end`` keeps its own class."""
    size = len(bigrams)
    order = [w for w in np.argsort(-bigrams.sum(0), kind="stable") if w != end]
    classes = np.full(size, END_CLASS)
    classes[order] = np.arange(len(order)) % CLASSES
    member = np.zeros((size, CLASSES + 1))
    member[np.arange(size), classes] = 1
    table = member.T @ bigrams @ member
    for _ in range(SWEEPS):
        moved = 0
        for w in order:
            old, self_pairs = classes[w], bigrams[w, w]
            member[w, old] = 0
            left, right = bigrams[:, w] @ member, bigrams[w] @ member  # without the word's own pairs
            table[:, old] -= left
            table[old] -= right
            table[old, old] -= self_pairs
            gain = (_xlogx(table + left[:, None]) - _xlogx(table)).sum(0) + (_xlogx(table + right) - _xlogx(table)).sum(1)
            own = np.diag(table)
            gain += _xlogx(own + left + right + self_pairs) - _xlogx(own + left) - _xlogx(own + right) + _xlogx(own)
            for sums, more in ((table.sum(0), left.sum() + self_pairs), (table.sum(1), right.sum() + self_pairs)):
                gain -= _xlogx(sums + more) - _xlogx(sums)
            new = int(gain[:CLASSES].argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            table[:, new] += left
            table[new] += right
            table[new, new] += self_pairs
            member[w, new] = 1
            classes[w] = new
            moved += new != old
        if not moved:
            break
    return classes


@dataclass
class Core:
    words: np.ndarray  # sorted hashes
    classes: np.ndarray
    evidence: np.ndarray  # log-likelihood of a class given one neighbour: 2 * (CLASSES + 1) x CLASSES


#: Classes that words can move to; unseen words are like those of OTHER.
_OPEN = np.array([*range(CLASSES), OTHER])


def evidence(table: np.ndarray) -> np.ndarray:
    """Log-likelihood of a class given the class before, then given the one after, from class bigrams."""
    table, to = table + 0.1, _OPEN[_OPEN < len(table)]
    left = np.log(table / table.sum(1, keepdims=True) / table.sum(0))[:, to]
    right = np.log(table / table.sum(1, keepdims=True)).T[:, to]
    return np.concatenate([left, right])


def cluster(bigrams: DataFrame, core: np.ndarray) -> Core:
    """Exchange clustering of at most CORE**2 counts, in one task."""
    size, end = len(core), int(np.searchsorted(core, END))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((size, size))
        for f in frames:
            counts[f["i"], f["j"]] = f["n"]
        classes = exchange(counts, end)
        member = np.eye(CLASSES + 1)[classes]
        found = evidence(member.T @ counts @ member)
        yield pd.DataFrame({"classes": [classes.astype(np.int64).tobytes()], "evidence": [found.tobytes()]})

    row = bigrams.repartition(1).mapInPandas(run, "classes binary, evidence binary").first()
    if row is None:  # no training text
        return Core(core, np.full(size, END_CLASS), np.zeros((2 * CLASSES + 2, CLASSES)))
    return Core(core, np.frombuffer(row[0], np.int64), np.frombuffer(row[1]).reshape(-1, CLASSES))


_PIECE = "shard bigint, block bigint, hashes binary, counts binary, places binary, codes binary, times binary"
_REPLY = "block bigint, shard bigint, counts binary, classes binary, totals array<bigint>"


def classify(blocks: DataFrame, core: Core, n_shards: int) -> DataFrame:
    """Per block and shard the counts and classes of the slice's words, in the slice's order. Rows of
    block -1 hold a shard's totals per class: tokens, then words."""
    contexts = CLASSES + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            size, learned = len(b.vocabulary), b.learned()
            counts = np.bincount(b.tokens[learned], minlength=size)
            at = _places(core.words, b.vocabulary)
            known = np.where(at >= 0, core.classes[at], -1)  # per word of the block
            around = known[b.tokens]
            last = b.before(around, END_CLASS)
            following = np.append(around[1:], -1)
            codes = []
            for side, context in ((0, last), (contexts, following)):
                use = learned & (around < 0) & (context >= 0)
                codes.append(b.tokens[use].astype(np.int64) * (2 * contexts) + side + context[use])
            pairs, times = np.unique(np.concatenate(codes), return_counts=True)
            word, code = pairs // (2 * contexts), (pairs % (2 * contexts)).astype(np.uint8)
            yield from _table(_PIECE, _pieces(b, counts, word, code, times, n_shards)).to_batches()

    return decided(blocks.mapInArrow(cut, _PIECE), core)


def _pieces(b: Block, counts: np.ndarray, word: np.ndarray, code: np.ndarray, times: np.ndarray, n_shards: int) -> list[tuple]:
    """A block's rows, one per shard: its words with counts, and how often each has which neighbour."""
    bounds = _shards(b.vocabulary, n_shards)
    cuts = np.searchsorted(word, bounds)
    rows = []
    for k in np.flatnonzero(np.diff(bounds)):
        own, pair = slice(bounds[k], bounds[k + 1]), slice(cuts[k], cuts[k + 1])
        packed = [_pack(x) for x in (counts[own].astype(np.uint32), (word[pair] - bounds[k]).astype(np.uint32), code[pair], times[pair].astype(np.uint32))]
        rows.append((int(k), b.number, b.vocabulary[own].tobytes(), *packed))
    return rows


def decided(pieces: DataFrame, core: Core) -> DataFrame:
    """The replies to pieces: core words have the core's classes, others the class of most evidence."""

    def decide(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")  # sums of floats in one order, whatever arrives first
        hashes = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        counts, places, times = ([_unpack(x, np.uint32) for x in table[c].to_pylist()] for c in ("counts", "places", "times"))
        codes = np.concatenate([_unpack(x, np.uint8) for x in table["codes"].to_pylist()])
        words, at = np.unique(np.concatenate(hashes), return_inverse=True)
        starts = np.cumsum([0, *map(len, hashes)])
        total = np.bincount(at, np.concatenate(counts), len(words)).astype(np.int64)
        entry = np.concatenate([at[s + p] for s, p in zip(starts, places, strict=False)])
        pairs, place = np.unique(entry * len(core.evidence) + codes, return_inverse=True)
        weight = np.bincount(place, np.concatenate(times), len(pairs))
        entry, codes = pairs // len(core.evidence), pairs % len(core.evidence)
        classes = np.full(len(words), OTHER)
        for low in range(0, len(words), 512):  # bounds the memory of the class scores
            span = slice(*np.searchsorted(entry, [low, low + 512]))
            if span.start < span.stop:
                own, first = np.unique(entry[span], return_index=True)
                scores = core.evidence[codes[span]] * weight[span][:, None]
                classes[own] = _OPEN[np.add.reduceat(scores, first).argmax(1)]
        inside = _places(core.words, words)
        classes = np.where(inside >= 0, core.classes[inside], classes)
        totals = np.concatenate([np.bincount(classes, total, KINDS), np.bincount(classes, total > 0, KINDS)])
        rows = [(-1, 0, b"", b"", totals.astype(np.int64).tolist())]
        shard = table["shard"][0].as_py()
        for k, number in enumerate(table["block"].to_pylist()):
            own = at[starts[k] : starts[k + 1]]
            rows.append((number, shard, _pack(total[own]), _pack(classes[own].astype(np.uint8)), None))
        return _table(_REPLY, rows)

    return pieces.groupBy("shard").applyInArrow(decide, _REPLY)


def neighbours(blocks: DataFrame, replies: DataFrame, n_shards: int) -> DataFrame:
    """Pieces of all training words but the end, with the neighbours' classes in ``replies``. Rows of shard
    -1 hold a block's class bigrams."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table(_PIECE, [])
        b = Block.of(left.to_pylist()[0])
        answers = sorted(right.to_pylist(), key=lambda r: r["shard"])
        kinds = np.concatenate([_unpack(r["classes"], np.uint8) for r in answers]).astype(np.int64)[b.tokens]
        learned = b.learned()
        last, following = b.before(kinds, END_CLASS), np.append(kinds[1:], END_CLASS)
        bigrams = np.bincount((last * KINDS + kinds)[learned], minlength=KINDS * KINDS)
        use = learned & (b.vocabulary != END)[b.tokens]
        codes = [b.tokens[use].astype(np.int64) * (2 * KINDS) + side + context[use] for side, context in ((0, last), (KINDS, following))]
        pairs, times = np.unique(np.concatenate(codes), return_counts=True)
        counts = np.bincount(b.tokens[learned], minlength=len(b.vocabulary))
        rows = _pieces(b, counts, pairs // (2 * KINDS), (pairs % (2 * KINDS)).astype(np.uint8), times, n_shards)
        return _table(_PIECE, [*rows, (-1, b.number, b"", bigrams.astype(np.int64).tobytes(), b"", b"", b"")])

    return blocks.groupBy("block").cogroup(replies.where("block >= 0").drop("totals").groupBy("block")).applyInArrow(run, _PIECE)


def sweeps(blocks: DataFrame, replies: DataFrame, workspace: Workspace, n_shards: int) -> DataFrame:
    """Replies after exchanging all training words, starting from ``replies``."""
    before, last = None, -np.inf
    for k in range(SWEEPS + 1):
        pieces = workspace.store(f"pieces{k}", neighbours(blocks, replies, n_shards))
        table = _bigrams(pieces.where("shard = -1").select("counts"))
        n = table.sum()
        value = _xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum()
        if before is not None and value < last:
            return before
        if not n or value - last < GAIN * n or k == SWEEPS:
            return replies
        if k > 1:
            workspace.drop(f"replies{k - 1}")
        before, last = replies, value
        every = Core(np.array([END]), np.array([END_CLASS]), evidence(table))
        replies = workspace.store(f"replies{k + 1}", decided(pieces.where("shard >= 0"), every))
        workspace.drop(f"pieces{k}")
    return replies


_SCORED = "doc_ids array<bigint>, train array<boolean>, offsets binary, known binary, base binary, emission binary, classes binary, pairs binary"


def emit(blocks: DataFrame, replies: DataFrame, totals: np.ndarray) -> DataFrame:
    """Per block its documents' base scores, emission scores and class sequences, and the counts of
    class pairs in training documents."""
    n, v = int(totals[:KINDS].sum()), int(totals[KINDS:].sum())
    types = totals[KINDS:] + (np.arange(KINDS) == OTHER)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table(_SCORED, [])
        b = Block.of(left.to_pylist()[0])
        answers = sorted(right.to_pylist(), key=lambda r: r["shard"])
        count = np.concatenate([_unpack(r["counts"], np.int64) for r in answers])
        kind = np.concatenate([_unpack(r["classes"], np.uint8) for r in answers]).astype(np.int64)
        base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
        emission = np.log10((count + 0.5) / (totals[:KINDS] + 0.5 * np.maximum(types, 1))[kind])
        sums = [np.add.reduceat(x[b.tokens], b.offsets[:-1]) for x in (base, emission, (count > 0).astype(np.int64))]
        kinds = kind[b.tokens]
        learned = b.learned()
        pairs = np.bincount((b.before(kinds, END_CLASS) * KINDS + kinds)[learned], minlength=KINDS * KINDS)
        row = (b.ids, b.train.tolist(), b.offsets.tobytes(), sums[2].tobytes(), sums[0].tobytes(), sums[1].tobytes(), _pack(kinds.astype(np.uint8)), pairs.astype(np.int64).tobytes())
        return _table(_SCORED, [row])

    return blocks.groupBy("block").cogroup(replies.where("block >= 0").drop("totals").groupBy("block")).applyInArrow(run, _SCORED)


def transitions(scored: DataFrame) -> np.ndarray:
    """log10 P(class | class before) from all training pairs."""
    table = _bigrams(scored.select("pairs"))
    share = (table.sum(0) + 0.5) / (table.sum() + 0.5 * KINDS)
    return np.log10((table + BLEND * share) / (table.sum(1, keepdims=True) + BLEND))


def _bigrams(counts: DataFrame) -> np.ndarray:
    """Class bigrams added up over the blocks; KINDS**2 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(KINDS * KINDS, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                held += np.frombuffer(x, np.int64)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["pair", "n"])

    sums = counts.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n")).collect()
    table = np.zeros(KINDS * KINDS)
    for pair, n in sums:
        table[pair] = n
    return table.reshape(KINDS, KINDS)


_RESULT = "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double"


def score(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, train): doc_id, train, n_tokens, n_known (tokens seen in
    training), base_score (unigrams), score (log10 probability under the class model), perplexity and
    train_tokens (N)."""
    blocks = workspace.store("blocks", encode(docs))
    entries = blocks.agg(F.sum("n_vocabulary")).first()[0] or 0
    n_shards = max(1, -(-entries // SHARD_ENTRIES))
    counted = workspace.store("counts", count(blocks, n_shards))
    n = counted.agg(F.sum("n")).first()[0] or 0
    top = counted.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select("w.words", "w.counts")
    top = top.orderBy(F.desc("counts"), "words").limit(CORE).collect()  # CORE rows at most
    words = np.array([w["words"] for w in top], np.int64).view(np.uint64)
    words = np.unique(np.append(words, END))
    core = cluster(core_bigrams(blocks, words), words)
    replies = workspace.store("replies", classify(blocks, core, n_shards))
    replies = sweeps(blocks, replies, workspace, 8 * n_shards)  # words have more neighbours there than in ``classify``
    sums = replies.where("block = -1").select(F.posexplode("totals").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    totals = np.zeros(2 * KINDS, np.int64)
    for row in sums.collect():  # two numbers per class
        totals[row["at"]] = row["n"]
    scored = workspace.store("scored", emit(blocks, replies, totals))
    log_pairs = transitions(scored)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                offsets = np.frombuffer(row["offsets"], np.int64)
                kinds = _unpack(row["classes"], np.uint8).astype(np.int64)
                steps = log_pairs[np.concatenate([[END_CLASS], kinds[:-1]]), kinds]
                total = np.frombuffer(row["emission"]) + np.add.reduceat(steps, offsets[:-1])
                sizes = np.diff(offsets)
                columns = [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["train"], pa.bool_()), pa.array(sizes),
                    pa.array(np.frombuffer(row["known"], np.int64)), pa.array(np.frombuffer(row["base"])), pa.array(total),
                    pa.array(10.0 ** (-total / sizes)),
                ]
                names = ["doc_id", "train", "n_tokens", "n_known", "base_score", "score", "perplexity"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    scores = scored.drop("pairs").mapInArrow(run, _RESULT)
    return scores.withColumn("train_tokens", F.lit(n).cast("bigint"))

