"""MinHash near-dedup with an LSH forest.

A text's set is its distinct word shingles. Texts with equal sets are one node, named by 64 bits of a digest
of the set. A node's signature has
``TREES * STEP`` MinHash values; tree t is the order of all signatures that starts at value t * STEP and
goes on for ``DEPTH`` values. Each tree is sorted as a whole, over many tasks, with the node as last
key, so an often repeated prefix is spread like any other. Candidates are neighbours in an order: a
node and the next ``NEAR`` ones, as long as they share a prefix of ``LEAST`` values. The depth adapts to
the region: where few signatures agree the neighbour is the one that shares three values, in a crowd it
is the one that shares most.

Where more than ``NEAR`` + 1 nodes share a prefix of ``LEAST`` values in some tree, or a task border cuts
their run, neighbours don't cover all pairs. Nodes of such runs that still hold several groups after the
rounds are joined exactly, see :func:`crowd_links`.

Trees are read in two rounds, two trees and the others. A round keeps only candidates whose nodes are in different
groups so far, so a large group of copies, joined in the first round, costs one row per node and tree
later on, never pairs; in the second round a node of a crowd meets the next one only, as the exact join comes after. Candidates whose full signatures agree in fewer than ``SURE`` values (over six
standard deviations below the threshold) are left out; all others are confirmed on the full sets. Links are united by
alternating stars on written tables.

A pair of similarity s shares LEAST values in one tree with probability s**LEAST; over all trees a pair
at 0.75 is missed by all with probability (1 - 0.75**3)**TREES, 2 in a million, in crowds as elsewhere.

Defined cases: null, empty and wordless texts have an empty set, size 0, and are linked with nothing.
Rows that repeat an id and text are one node and all ``kept``. An id with several texts links them: what one is
linked with, all of them are. Rows without id are linked by their texts like others, but give a group no
name and don't link each other; a group with ids is named by the smallest, and its rows without id
aren't ``kept``. A group of rows without id only has no name, and one text of it is ``kept``.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.frames import add_columns, maybe_among
from tillmart.llm.hashing import mix, pieces, slices, word_hashes
from tillmart.workspace import Workspace

WORDS = 5
TREES, STEP, DEPTH, LEAST, NEAR = 24, 5, 8, 3, 4
VALUES = TREES * STEP
ROUNDS = (0, 2, TREES)
#: Of VALUES; at similarity 0.75 a pair agrees in 90 +- 4.7.
SURE = 60
PERCENT = 75
FILTER_BITS = 1 << 24
#: Least set size of each size class: single sizes first, then 10 % apart.
SIZES = [1]
while SIZES[-1] < 1 << 40:
    SIZES.append(max(SIZES[-1] + 1, SIZES[-1] * 11 // 10))
#: Shingles, and sets, that are compared with as many others at a time, counted on both sides of pairs, and numbers
#: that one step of it holds.
CHUNK, CHUNK_SETS, SLAB = 1 << 18, 2048, 1 << 21
#: Of texts that are cut into shingles at a time; a larger text is cut alone.
PART_BYTES = 1 << 21

_RNG = np.random.default_rng(75)
_FLIP = _RNG.integers(0, 2**32, VALUES, dtype=np.uint32)
_ODD = _RNG.integers(0, 2**31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLACE = _RNG.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, k: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles; fewer words are one shingle."""
    words, offsets = word_hashes(texts)
    grams = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for i in range(k):
        grams += words[i : len(words) - k + 1 + i] * _PLACE[i]
    mix(grams)
    out = []
    for low, high in zip(offsets[:-1], offsets[1:], strict=True):
        if high - low >= k:
            out.append(np.unique(grams[low : high - k + 1]))
        else:
            short = (words[low:high] * _PLACE[: high - low]).sum(dtype=np.uint64) + np.uint64(high - low)
            out.append(mix(np.array([short] if high > low else [], np.uint64)))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (rows: sets, none of them empty)."""
    out = np.empty((len(sets), VALUES), np.uint32)
    done = 0
    while done < len(sets):
        more, total = done, 0
        while more < len(sets) and (more == done or total + len(sets[more]) <= 1 << 16):
            total += len(sets[more])
            more += 1
        own = sets[done:more]
        x = (np.concatenate(own) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *map(len, own[:-1])])
        for v in range(VALUES):
            out[done:more, v] = np.minimum.reduceat((x ^ _FLIP[v]) * _ODD[v], starts)
        done = more
    return out


def node_of(shingles: np.ndarray) -> int | None:
    """Name of a set; an empty one has none."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "big", signed=True) if len(shingles) else None


def with_sets(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its texts, with n_shingles, node (null if the set is empty) and signature (two bytes a value)."""

    def run(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for column in columns:
            sets = shingle_sets(column)
            full = [s for s in sets if len(s)]
            marks = iter(((signatures(full) * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(">u2")) if full else iter(())
            yield [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([node_of(s) for s in sets], pa.int64()),
                pa.array([next(marks).tobytes() if len(s) else None for s in sets], pa.binary()),
            ]

    kinds = {"n_shingles": T.LongType(), "node": T.LongType(), "signature": T.BinaryType()}
    return add_columns(df, text, [T.StructField(n, k) for n, k in kinds.items()], run, PART_BYTES, with_text=False)


def forest(nodes: DataFrame, first: int, last: int, in_runs: int = NEAR) -> DataFrame:
    """Neighbours (a, b) in the orders of trees ``first`` to ``last`` - 1; nodes: node, signature, label.
    Pairs of one label are left out. In runs too long for neighbours a node meets the next ``in_runs``. Rows with a ``run`` and no b tell that node a is in a run of nodes
    too long for neighbours to cover all its pairs, or at a task's border."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, 2 * VALUES)
            values = np.concatenate([values, values[:, : 2 * DEPTH]], 1)
            for tree in range(first, last):
                keys = np.ascontiguousarray(values[:, 2 * tree * STEP : 2 * (tree * STEP + DEPTH)])
                key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * DEPTH), n, [None, pa.py_buffer(keys)])
                columns = [pa.array(np.full(n, tree, np.int32)), key.cast(pa.binary()), batch.column(0), batch.column(2)]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "prefix", "node", "label"])

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.Table | None = None
        seen, wide = 0, NEAR + 1

        def found(a: np.ndarray, b: np.ndarray | None, run: np.ndarray | None) -> pa.RecordBatch:
            none = pa.nulls(len(a), pa.int64())
            columns = [pa.array(a), none if b is None else pa.array(b), none if run is None else pa.array(run)]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b", "run"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if tail is not None:
                table = pa.concat_tables([tail, table])
            n, old = table.num_rows, 0 if tail is None else tail.num_rows
            nodes_, labels = (table[c].to_numpy() for c in ("node", "label"))
            runs = _runs(table)
            crowded = np.zeros(n, bool)
            crowded[old : old + max(0, wide - seen)] = True
            if n > wide:
                at = np.flatnonzero(runs[:-wide] == runs[wide:])
                for more in range(wide + 1):
                    crowded[at + more] = True
            for gap in range(1, NEAR + 1):
                if n <= gap:
                    break
                low, high = slice(0, n - gap), slice(gap, n)
                meets = (runs[low] == runs[high]) & (labels[low] != labels[high]) & (np.arange(gap, n) >= old)
                at = np.flatnonzero(meets & ~(crowded[low] & crowded[high]) if gap > in_runs else meets)
                a, b = nodes_[at], nodes_[at + gap]
                yield found(np.minimum(a, b), np.maximum(a, b), None)
            yield found(nodes_[crowded], None, runs[crowded])
            seen += n - old
            tail = table.slice(max(0, n - wide))
        if tail is not None:
            yield found(tail["node"].to_numpy(), None, _runs(tail))

    placed = nodes.select("node", "signature", "label").mapInArrow(rows, "tree int, prefix binary, node bigint, label bigint")
    in_order = placed.repartitionByRange("tree", "prefix", "node").sortWithinPartitions("tree", "prefix", "node")
    return in_order.mapInArrow(neighbours, "a bigint, b bigint, run bigint").where("a < b OR b IS NULL").distinct()


def _runs(table: pa.Table) -> np.ndarray:
    """Per row its tree and the first LEAST values, as one number."""
    keys = np.frombuffer(b"".join(table["prefix"].to_pylist()), np.uint8).reshape(table.num_rows, 2 * DEPTH)
    out = table["tree"].to_numpy().astype(np.int64)
    for k in range(2 * LEAST):
        out = out << 8 | keys[:, k]
    return out


def crowded(runs: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes with labels (node, label) of those runs (node, run) that hold several labels."""
    marked = runs.join(labels, "node")
    mixed = marked.groupBy("run").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return marked.join(mixed.select("run"), "run", "left_semi").select("node", "label").distinct()


def _overlap(x: int, y: int) -> int:
    """Least common shingles of sets of these sizes at the threshold."""
    return -(-PERCENT * (x + y) // (100 + PERCENT))


def _class(size: int) -> int:
    return bisect_right(SIZES, size) - 1


def _meetings(size: int) -> Iterator[tuple[int, int, bool, int]]:
    """Under which classes (of the smaller and the larger set of a pair) a set of this size meets others,
    whether as the larger one, and how many of its shingles may be missing from the other."""
    own, least = _class(size), -(-PERCENT * size // 100)
    for large in range(own, _class(100 * size // PERCENT) + 1):
        yield own, large, False, size - _overlap(size, max(size, SIZES[large]))
    for small in range(_class(least), own + 1):
        yield small, own, True, size - _overlap(max(SIZES[small], least), size)


@lru_cache(4096)
def _most_missing(small: int, large: int) -> int:
    """Bound of what may be missing on either side, whatever the sizes in these classes."""
    x, y = SIZES[small + 1] - 1, SIZES[large + 1] - 1
    return 1 + max(x - _overlap(x, max(x, SIZES[large])), y - _overlap(max(SIZES[small], -(-PERCENT * y // 100)), y))


def _keys(size: int, weights: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """Keys of a set, given its shared blocks in order, and whether it has them as the larger one of a pair."""
    before = size - weights.sum() + np.cumsum(weights) - weights  # what is missing if a block is the first common one
    for small, large, larger, missing in _meetings(size):
        first = blocks[before <= missing]
        if len(first):
            heavy = blocks[weights > _most_missing(small, large)]
            mark = mix(np.array([heavy.sum(dtype=np.uint64) + np.uint64(small * 65536 + large)], np.uint64))
            yield mix((first ^ mark) * np.uint64(0x9E3779B97F4A7C15)), larger


def blocks_of(sets: DataFrame, workspace: Workspace) -> DataFrame:
    """Per node its shared blocks (n, block, weight), rare ones first; sets: node, shingles. Shingles that are in
    the same sets are one block, so a block is in a set as a whole or not at all; its weight is the
    number of its shingles. Shingles of one set only are in no block."""

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                own = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(1)]
                of = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), [len(x) for x in own])))
                yield pa.RecordBatch.from_arrays([of, pa.array(np.concatenate(own))], names=["node", "shingle"])

    flat_ = sets.select("node", "shingles").mapInArrow(flat, "node bigint, shingle bigint")
    # Which sets a shingle is in, as two hashes that don't depend on the order.
    where = [F.bit_xor(F.xxhash64(F.lit(i), "node")) for i in (1, 2)]
    shared = flat_.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.xxhash64(*where).alias("in_")).where("n > 1")
    shared = workspace.store("crowd_shingles", shared.select("shingle", "n", F.xxhash64("n", "in_").alias("block")))
    weighed = flat_.join(shared, "shingle").groupBy("node", "n", "block").agg(F.count(F.lit(1)).alias("weight"))
    return weighed.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "block", "weight"))).alias("blocks"))


def crowd_links(sets: DataFrame, workspace: Workspace) -> DataFrame:
    """Links (a, b) that join all groups of a crowd that are linked; sets: node, label, shingles.

    Two sets that reach the threshold have few shingles that the other lacks; how few follows from their sizes,
    told apart by classes. So a set with more shingles of its own than that meets nobody; all blocks
    heavier than that are common, or they can't link; and the rarest common block is among the first ones,
    rare ones first, that could be missing together. Keys are such a first block with all heavy blocks of the
    set: texts made from a template meet only where they agree in all its larger parts.

    Sets that meet are not paired: under a key they are cut into chunks, by group, and a chunk is compared with
    another as a whole, blocks by sets, which gives the sizes of all intersections. Chunks of one group are not
    compared with each other, so a large group meets the other sets only. Of all links between two
    chunks those stay that join their groups."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows, found, sides = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
                offsets, flat = part.column(3).offsets.to_numpy(), part.column(3).values
                block, weight = (flat.field(k).to_numpy() for k in (1, 2))
                for row, size in enumerate(part.column(2).to_pylist()):
                    own = slice(offsets[row], offsets[row + 1])
                    for key, larger in _keys(size, weight[own], block[own].view(np.uint64)):
                        rows.append(np.full(len(key), row))
                        found.append(key)
                        sides.append(np.full(len(key), larger))
                of = pa.array(np.concatenate(rows))
                columns = [pa.array(np.concatenate(found).view(np.int64)), *(part.column(k).take(of) for k in range(3)), pa.array(np.concatenate(sides))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "label", "size", "larger"])

    sized = sets.select("node", "label", F.expr("octet_length(shingles) div 8").alias("size"))
    listed = workspace.store("crowd_blocks", sized.join(blocks_of(sets, workspace), "node").select("node", "label", "size", "blocks"))
    placed = listed.mapInArrow(keys, "key bigint, node bigint, label bigint, size bigint, larger boolean")
    placed = workspace.store("crowd_keys", placed)
    several = placed.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("larger").alias("no"), F.max("larger").alias("yes"),
        F.sum("size").alias("shingles"), F.count(F.lit(1)).alias("rows"),
    ).where("low < high AND NOT no AND yes")
    several = several.select("key", F.expr(f"greatest(shingles div {CHUNK}, rows div {CHUNK_SETS}) + 1").alias("n"), "rows")
    several = workspace.store("crowd_meetings", several)
    met = maybe_among(placed, "key", several.select("key")).select("key", "node", "label").distinct().join(several, "key")
    met = workspace.store("crowd_met", met)
    # Groups share chunks, but one that would fill a chunk is dealt over chunks of its own.
    own = met.where("n > 1").groupBy("key", "label").agg(F.count(F.lit(1)).alias("own"))
    full = met.drop("label").join(listed, "node").join(own, ["key", "label"], "left")
    fills = F.ceil(F.col("own") * F.col("n") / F.col("rows"))
    shared = F.xxhash64(F.lit(0), F.pmod(F.xxhash64("label"), F.col("n")))
    chunk = F.when(fills > 1, F.xxhash64("label", F.pmod(F.xxhash64("node"), fills))).otherwise(shared).alias("chunk")
    weight = F.expr("transform(blocks, x -> cast(x.weight AS INT))").alias("weight")
    chunks = full.groupBy("key", "n", chunk).agg(
        F.collect_list(F.struct("node", "label", "size", F.expr("blocks.block").alias("block"), weight)).alias("members"),
        F.min("label").alias("low"), F.max("label").alias("high"),
    )
    chunks = workspace.store("crowd_chunks", chunks)
    # A chunk is compared with itself where it is, and sent once; only chunks of keys that have several are joined.
    inside = chunks.where("low < high").select("members", F.lit(None).cast(chunks.schema["members"].dataType).alias("others"))
    wide = chunks.where("n > 1")
    other = wide.select("key", F.col("chunk").alias("chunk_"), F.col("members").alias("others"), F.col("low").alias("low_"), F.col("high").alias("high_"))
    several_groups = F.least("low", "low_") < F.greatest("high", "high_")
    across = wide.join(other, "key").where((F.col("chunk") < F.col("chunk_")) & several_groups).select("members", "others")
    return inside.unionAll(across).mapInArrow(_compared, "a bigint, b bigint").distinct()


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between two chunks of sets, or within one if the other is null, as few as join their groups."""
    for batch in batches:
        for row, alone in enumerate(batch.column(1).is_null().to_pylist()):
            a, a_labels, a_sizes, x = own = _members(batch.column(0), row)
            b, b_labels, b_sizes, y = own if alone else _members(batch.column(1), row)
            known = np.intersect1d(x[0], y[0])
            common = np.zeros((len(a), len(b)))
            step = max(64, SLAB // max(len(a), len(b)))
            for low in range(0, len(known), step):
                some = known[low : low + step]
                left, right = (np.zeros((n, len(some)), np.float32) for n in (len(a), len(b)))
                for side, (block, of, weight) in ((left, x), (right, y)):
                    at = np.minimum(np.searchsorted(some, block), len(some) - 1)
                    there = some[at] == block
                    side[of[there], at[there]] = weight[there] if side is left else 1
                common += left @ right.T
            near = 100 * common >= PERCENT * (a_sizes[:, None] + b_sizes - common)
            i, j = np.nonzero(near & (a_labels[:, None] != b_labels) & (common > 0))
            keep = _spanning(a_labels[i], b_labels[j])
            i, j = a[i[keep]], b[j[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j))], names=["a", "b"])


def _members(column: pa.Array, row: int) -> tuple:
    """Nodes, labels and sizes of a chunk, and of all their blocks in a row: block, member, weight."""
    own = column.slice(row, 1).flatten()
    node, label, size, block, weight = own.flatten()
    of = np.repeat(np.arange(len(own)), pc.list_value_length(block).to_numpy())
    flat = block.flatten().to_numpy(), of, weight.flatten().to_numpy()
    return node.to_numpy(), label.to_numpy(), size.to_numpy(), flat


def _spanning(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Places of edges that are enough to join what all of them join."""
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while root.setdefault(v, v) != v:
            root[v] = v = root[root[v]]
        return v

    out = []
    for k, (u, v) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        u, v = find(u), find(v)
        if u != v:
            root[u] = v
            out.append(k)
    return out


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in at least SURE values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, VALUES) for k in (2, 3))
                keep = pa.array((left == right).sum(1) >= SURE)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    own = maybe_among(nodes.select("node", "signature"), "node", pairs.select(F.explode(F.array("a", "b"))))
    sides = pairs.join(own.select(F.col("node").alias("a"), F.col("signature").alias("left")), "a")
    sides = sides.join(own.select(F.col("node").alias("b"), F.col("signature").alias("right")), "b")
    return sides.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that reach the threshold on their full sets; sets: node, shingles (array of long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keep = []
                for x, y in zip(part.column(2), part.column(3), strict=True):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * same >= PERCENT * (len(x) + len(y) - same))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["a", "b"])

    sides = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
    sides = sides.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    return sides.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def unite(labels: DataFrame, links: DataFrame, workspace: Workspace, name: str) -> DataFrame:
    """Labels (node, label: the smallest node reachable) after adding links (a, b) between nodes.

    Works on the graph of labels that have links, by alternating large and small stars: every label
    hangs its larger neighbours, then its smaller ones, on the smallest. Minima are combined on the map
    side, so a label with very many neighbours is no hot group. Each step is written."""
    own = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
    other = labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
    edges = links.join(own, "a").join(other, "b").where("x != y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
    edges, step = workspace.store(f"{name}_0", edges.distinct()), 0
    if not workspace.rows[f"{name}_0"]:
        return labels
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("last"))
        # All edges are stars once every label has larger neighbours only, or a single smaller one.
        open_ = (F.col("m") < F.col("u")) & (F.col("m") != F.col("last"))
        seen = Observation(f"{name}-{step}-{uuid.uuid4().hex}")
        counted = ends.observe(seen, F.coalesce(F.sum(open_.cast("long")), F.lit(0)).alias("open"))
        least = workspace.store(f"{name}_ends{step}", counted).drop("last")
        if not seen.get["open"]:
            break
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step += 1
        edges = workspace.store(f"{name}_{step}", hung.unionAll(smallest.withColumnRenamed("m", "v")).distinct())
    hung = labels.join(edges, F.col("label") == F.col("u"), "left")
    return workspace.store(f"{name}_labels", hung.select("node", F.coalesce("v", "label").alias("label")))


def text_hash(text: str = "text") -> Column:
    """Tells the texts of rows apart that have one id or none."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def groups(docs: DataFrame, workspace: Workspace, text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept, and own (``text_hash``)."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"), text_hash(text).alias("own"))
    marked = workspace.store("signatures", with_sets(source))
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "own")  # ids before none, then the smallest
    nodes = marked.where("node IS NOT NULL").groupBy("node").agg(F.min(first).alias("first"), F.first("signature").alias("signature"))
    nodes = workspace.store("nodes", nodes)
    labels = nodes.select("node", F.col("node").alias("label"))

    def linked(k: str, pairs: DataFrame, sets: DataFrame | None = None, more: DataFrame | None = None) -> DataFrame:
        near = workspace.store(f"near{k}", likely(pairs, nodes))
        links = more
        if workspace.rows[f"near{k}"]:
            if sets is None:
                wanted = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                sets = workspace.store(f"sets{k}", _sets_of(source, nodes, wanted))
            links = workspace.store(f"links{k}", confirm(near, sets).distinct())
            links = links.unionAll(more) if more is not None else links
        return labels if links is None else unite(labels, links, workspace, f"unite{k}")

    ids = marked.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    several = workspace.store("several_texts", ids.where("a < b").select("doc_id", "a"))
    of_one_id = None
    if workspace.rows["several_texts"]:
        own = marked.join(several, "doc_id").where("node != a")
        of_one_id = workspace.store("id_links", own.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct())
    runs = []
    for k, (low, high) in enumerate(zip(ROUNDS[:-1], ROUNDS[1:], strict=True)):
        labelled = nodes.withColumn("label", F.col("node")) if k == 0 else nodes.join(labels, "node")
        pairs = workspace.store(f"pairs{k}", forest(labelled, low, high, NEAR if k == 0 else 1))
        runs.append(pairs.where("b IS NULL").select(F.col("a").alias("node"), "run"))
        labels = linked(str(k), pairs.where("b IS NOT NULL").select("a", "b"), more=of_one_id if k == 0 else None)
    crowd = workspace.store("crowd", crowded(runs[0].unionAll(runs[1]), labels))
    if workspace.rows["crowd"]:
        sets = _sets_of(source, nodes, crowd.select("node")).join(crowd, "node")
        sets = workspace.store("sets_crowd", sets.select("node", "label", "shingles"))
        pairs = workspace.store("pairs_crowd", crowd_links(sets, workspace))
        labels = linked("_crowd", pairs, sets)
    named = nodes.select("node", "first").join(labels, "node").select("node", "label", "first")
    least = named.groupBy("label").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    least = workspace.store("components", least.drop("n"))  # groups of several nodes only
    group = named.join(least, "label", "left").select("node", F.coalesce("least", "first").alias("least"))
    joined = marked.drop("signature").join(group, "node", "left")
    alone = F.col("node").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id"))
    kept = F.when(alone, True).when(component.isNull(), F.col("own") == F.col("least.own")).otherwise(F.col("doc_id").eqNullSafe(component))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "own")


def _sets_of(source: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingle sets (node, shingles) of at least the wanted nodes, one row per node.

    No text is shuffled: a bitmap of ``FILTER_BITS`` bits, one per hash value of a wanted node's text, goes
    to all tasks, and a text is cut into shingles where it stands if its bit is set. The bitmap's size is
    fixed; with more nodes it lets more other texts through, which meet no pair later on."""
    slot = F.pmod(F.xxhash64("own"), F.lit(FILTER_BITS))
    owns = nodes.join(wanted, "node", "left_semi").select(F.col("first.own").alias("own"))
    set_bits = owns.select(slot.alias("s")).groupBy(F.expr("s div 64").alias("at"))
    words = set_bits.agg(F.bit_or(F.expr("shiftleft(1L, CAST(s % 64 AS INT))")).alias("bits")).toArrow()
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    bitmap[words["at"].to_numpy()] = words["bits"].to_numpy()
    held = source.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value.view(np.uint64)
        for batch in batches:
            for part in pieces(batch, PART_BYTES):
                at = part.column(0).to_numpy()
                hit = np.flatnonzero(bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
                if not len(hit):
                    continue
                sets = [s for s in shingle_sets(part.column(1).take(pa.array(hit))) if len(s)]
                columns = [pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "shingles"])

    found = source.select(slot.alias("slot"), "text").mapInArrow(run, "node bigint, shingles binary")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))
