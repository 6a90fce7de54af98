"""Merkle dataset manifest that stores few levels and recomputes the others.

Every row is a leaf, the SHA-256 of its columns; the leaves of one tree key (a language, say), in order,
are the bottom of a tree in which each run of ``arity`` consecutive nodes becomes the digest of their
digests. The last run of a level may be shorter, even one node, which then becomes its own digest. What
remains is the tree's subroot; the subroots, in the order of their keys, are the leaves of a last tree, whose
top is the root.

Levels are cut into aligned subtrees of ``arity ** EVERY`` nodes. Only the top nodes of these subtrees are
stored, level by ``EVERY`` levels; a subtree's inner nodes exist only while its top is computed. Proof
extraction goes down the stored levels: each aligned subtree regenerates its inner nodes from the stored
nodes below, gives every one of those its siblings, joins the siblings of its own top, and drops the
inner nodes. So no group holds more than ``arity ** EVERY`` digests, however many rows a tree key has, and a
proof of some rows touches their subtrees only.

Texts are hashed where they stand; what is shuffled are ids and digests. Leaves are numbered by a range
shuffle over key, id and digest, so a key with a third of all rows is spread like others.

Defined cases: a null column counts as ``-``, so null and empty differ; null tree keys are one tree, the
first; null ids come first. Rows of one id are ordered by their digest; equal rows are leaves of their own
with equal digests. A tree of one leaf has that leaf as subroot, one tree alone has its subroot as root.
An empty table has no leaves and no proofs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.operators.numbering import number_rows
from tillmart.workspace import Workspace

ARITY = 2
#: Levels of a subtree of which only the top is stored.
EVERY = 8
NODE = ["tree", "size", "place"]


def encoded(*columns: str | Column) -> Column:
    """All columns in a row: ``-`` for a null, else the value's UTF-8 byte count, ``:`` and the value."""
    values = [(c if isinstance(c, Column) else F.col(f"`{c}`")).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def digest(value: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(value, 256)


@dataclass
class Manifest:
    """``leaves``: tree, size, place, node (digest) and the rows' own columns; ``trees``: key, tree (from 1), size.
    ``levels`` and ``top`` are the stored levels of all trees and of the tree of subroots, bottom first."""

    leaves: DataFrame
    trees: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    arity: int = ARITY
    every: int = EVERY

    @property
    def subroots(self) -> DataFrame:
        """tree and node of every tree's top."""
        return self.levels[-1].select("tree", "node")

    @property
    def root(self) -> str | None:
        """The digest of the whole table; None for an empty one."""
        row = self.top[-1].select("node").first()
        return row["node"] if row else None


def _subtrees(level: DataFrame, arity: int, every: int, own: list[str]) -> DataFrame:
    """One row per aligned subtree: tree, size, block, members (place, node and the columns ``own``, in order)
    and l0 to l``every``, the digests of its levels. Levels above a tree's top repeat the top."""
    members = F.sort_array(F.collect_list(F.struct("place", "node", *own)))
    block = F.expr(f"place div {arity**every}").alias("block")
    out = level.groupBy("tree", "size", block).agg(members.alias("members"))
    out = out.withColumn("l0", F.col("members.node"))
    for k in range(every):
        run = f"transform(sequence(0, cast((size(l{k}) - 1) div {arity} AS INT)), i -> sha2(array_join(slice(l{k}, i * {arity} + 1, {arity}), ''), 256))"
        out = out.withColumn(f"l{k + 1}", F.expr(f"IF({_nodes(arity, k)} > 1, {run}, l{k})"))
    return out


def _nodes(arity: int, level: int) -> str:
    """Number of a tree's nodes ``level`` levels above a level of ``size`` nodes."""
    return f"((size + {arity**level - 1}) div {arity**level})"


def _climb(bottom: DataFrame, workspace: Workspace, name: str, arity: int, every: int) -> list[DataFrame]:
    """Stored levels, ``bottom`` first, until every tree has one node left."""
    levels = [bottom]
    largest = bottom.agg(F.max("size")).first()[0] or 1
    while largest > 1:
        tops = _subtrees(levels[-1], arity, every, []).select(
            "tree", F.expr(_nodes(arity, every)).alias("size"), F.col("block").alias("place"), F.element_at(f"l{every}", 1).alias("node")
        )
        levels.append(workspace.store(f"{name}_{len(levels)}", tops))
        largest = -(-largest // arity**every)
    return levels


def build(rows: DataFrame, workspace: Workspace, key: str, order: list[str], leaf: str = "leaf", arity: int = ARITY, every: int = EVERY) -> Manifest:
    """The manifest of ``rows``, whose column ``leaf`` holds their digests. ``key`` names the tree, ``order``
    the columns that order a tree's leaves; ties go by digest."""
    own = rows.columns
    total = [key, *(c for c in order if c != key), *([leaf] if leaf not in order else [])]
    numbered = number_rows(rows.withColumnRenamed(leaf, "node"), ["node" if c == leaf else c for c in total], "number_", workspace, "leaves")
    sizes = numbered.groupBy(F.col(key).alias("key_")).agg(F.min("number_").alias("first_"), F.count(F.lit(1)).alias("size"))
    trees = workspace.store("trees_numbered", number_rows(sizes, ["key_"], "tree", workspace, "trees"))
    leaves = numbered.join(trees, numbered[key].eqNullSafe(trees["key_"]))
    leaves = leaves.select("tree", "size", (F.col("number_") - F.col("first_")).alias("place"), "node", *[c for c in own if c != leaf])
    levels = _climb(leaves, workspace, "level", arity, every)
    count = workspace.rows["trees_numbered"]
    bottom = levels[-1].select(F.lit(0).cast("bigint").alias("tree"), F.lit(count).cast("bigint").alias("size"), (F.col("tree") - 1).alias("place"), "node")
    top = _climb(workspace.store("subroots", bottom), workspace, "top", arity, every)
    return Manifest(leaves, trees.select(F.col("key_").alias("key"), "tree", "size"), levels, top, arity, every)


def _paths(levels: list[DataFrame], above: DataFrame, arity: int, every: int, own: list[str], wanted: DataFrame | None = None) -> DataFrame:
    """tree, place, node, ``own``, path and the other columns of ``above`` (tree, place, path ...: those of the
    last level's nodes) for the nodes of the first level; with ``wanted`` (tree, place) at least for those."""
    carried = [c for c in above.columns if c not in ("tree", "place", "path")]
    for k in range(len(levels) - 2, -1, -1):
        level, kept = levels[k], own if k == 0 else []
        if wanted is not None:
            size = arity ** (every * k)
            blocks = wanted.select("tree", F.expr(f"place div {size * arity**every}").alias("block")).distinct()
            level = level.withColumn("block", F.expr(f"place div {arity**every}")).join(blocks, ["tree", "block"], "left_semi").drop("block")
        found = _subtrees(level, arity, every, kept).join(above.withColumnRenamed("place", "block"), ["tree", "block"])
        steps = []
        for j in range(every):
            at = f"cast((m.place % {arity**every}) div {arity**j} AS INT)"
            before = f"array_join(slice(l{j}, {at} - {at} % {arity} + 1, {at} % {arity}), '')"
            after = f"array_join(slice(l{j}, {at} + 2, {arity - 1} - {at} % {arity}), '')"
            steps.append(f"IF({_nodes(arity, j)} > 1, named_struct('before', {before}, 'after', {after}), NULL)")
        inner = f"transform(members, m -> named_struct('m', m, 'path', concat(filter(array({', '.join(steps)}), s -> s IS NOT NULL), path)))"
        rows = found.select("tree", F.explode(F.expr(inner)).alias("x"), *carried)
        above = rows.select("tree", "x.m.place", "x.m.node", *[f"x.m.{c}" for c in kept], "x.path", *carried)
        if k:
            above = above.drop("node")
    if len(levels) == 1:  # every node is its tree's top
        above = levels[0].select("tree", "place", "node", *own).join(above, ["tree", "place"])
    return above


def proofs(manifest: Manifest, workspace: Workspace, wanted: DataFrame | None = None) -> DataFrame:
    """Per leaf its own columns, ``leaf``, ``subroot``, ``root`` and ``path``: the siblings before and after it
    and its ancestors, level by level up to the root; with ``wanted`` (tree, place) for those leaves' subtrees only."""
    a, e = manifest.arity, manifest.every
    none = F.expr("cast(array() AS array<struct<before: string, after: string>>)")
    root = manifest.top[-1].select("tree", "place", none.alias("path"), F.col("node").alias("root"))
    tops = _paths(manifest.top, root, a, e, [])
    tops = tops.select((F.col("place") + 1).alias("tree"), F.lit(0).cast("bigint").alias("place"), F.col("node").alias("subroot"), "path", "root")
    tops = workspace.store("subroot_paths", tops)
    own = [c for c in manifest.leaves.columns if c not in (*NODE, "node")]
    found = _paths(manifest.levels, tops, a, e, own, wanted)
    if wanted is not None:
        found = found.join(wanted, ["tree", "place"], "left_semi")
    return found.select(*own, "tree", "place", F.col("node").alias("leaf"), "subroot", "root", "path")


def siblings(path: str = "path") -> Column:
    """All siblings of a path in a row, left to right, level by level."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def fold(leaf: str | Column, path: str = "path") -> Column:
    """The root that a leaf's digest and the siblings on its path lead to."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(path, start, lambda node, s: digest(F.concat(s["before"], node, s["after"])))


def audit(docs: DataFrame, workspace: Workspace, columns: list[str], tampered: dict[str, Column], where: Column, key: str = "lang", identity: str = "doc_id") -> DataFrame:
    """Proofs of all rows of ``docs``, folded from leaves in which the columns named by ``tampered`` hold
    its values where ``where`` holds: ``identity``, leaf, subroot, root, proof_sha256, folded_root, verified."""
    changed = F.when(where, digest(encoded(*[tampered.get(c, F.col(f"`{c}`")) for c in columns])))
    own = digest(encoded(*columns))
    rows = docs.select(F.col(f"`{identity}`").alias("id"), F.col(f"`{key}`").alias("key"), own.alias("leaf"), changed.alias("changed"))
    manifest = build(rows, workspace, "key", ["id"])
    found = proofs(manifest, workspace)
    folded = found.withColumn("folded_root", fold(F.coalesce("changed", "leaf")))
    return folded.select(
        F.col("id").alias(identity), "leaf", "subroot", "root", digest(siblings()).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
