"""Conversation repair: the cheapest edits that make the roles alternate, by bidirectional Dijkstra.

A conversation is right if its roles are none at all, or system at most once, then user and assistant in
turn, ending with assistant. Rows may be kept (cost 0), get another role (1), be deleted (2), and empty
turns may be put in (5); a truncated row that stays costs 5 more, a blank or repeated one has to go. Nodes
of the edit lattice are (rows used, state of the role pattern), edges are edits. Two searches, from the
start and from the ends that are allowed, settle nodes in the order of cost, then rows used, and keep per node
the least audit (initials of the edits) among the cheapest. They stop once their heaps' least costs together
exceed the best crossing, so that all crossings of equal cost are finished; of these the least concatenated
audit is taken. Two cheapest audits of one node are never each other's beginning (an insertion costs
something), so least parts make the least whole.

A row enters the search as one letter, so a conversation is a short string, and equal strings are solved
once per task. Rows are numbered by a range shuffle over (conversation, turn, role, digest) and cut at every
``SEGMENT`` numbers. A conversation that no cut touches is solved as a whole. Of the others every segment
is solved between all pairs of states, and ``FAN`` neighbouring segments at a time are put together by
(cost, audit) until one is left: a conversation with a third of all rows is solved by as many tasks as it has
segments. The edits then go back to the rows in one stream per conversation, in order, as the digest of
a whole conversation needs them; no conversation is held in memory, its audit excepted.

Defined cases: null roles and texts count as one space; null turns come first, null conversations are one
conversation. Rows of one turn are ordered by role, then by the digest of role and text, so copies are
neighbours. A role other than system, user or assistant, told by its initial, can't be kept as it is. An
empty table has no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillmart.llm.hashing import slices
from tillmart.operators.numbering import number_rows
from tillmart.workspace import Workspace

SEGMENT = 1024
FAN = 64
KEEP, REROLE, DELETE, INSERT, SPOILT = 0, 1, 2, 5, 5
COSTS = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
#: White space.
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant. Where a role's initial leads from each.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {"s": {BEGIN: SYSTEM}, "u": {BEGIN: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = {BEGIN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
RIGHT = (BEGIN, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Results that a task keeps, by string.
KNOWN = 50_000
TABLE = "array<struct<start: int, end: int, cost: bigint, audit: string>>"


def row_edges(code: str) -> list[tuple[str, int, int, int]]:
    """(initial, cost, state before, state after) of the edits of a row. A row's code is its role's initial,
    a capital if the row is truncated, or d if it has to go."""
    edges = [("D", DELETE, s, s) for s in range(4)]
    if code != "d":
        more = SPOILT if code.isupper() else 0
        edges += [("K", KEEP + more, s, t) for s, t in KEPT.get(code.lower(), {}).items()]
        edges += [("R", REROLE + more, s, t) for s, t in NEXT.items()]
    return edges


def cheapest(codes: str, start: int = BEGIN, ends: tuple[int, ...] = RIGHT) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest edits from one state to one of others; None if there are none."""
    n, edges = len(codes), {c: row_edges(c) for c in set(codes)}

    def steps(side: int, place: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if side == 0:
            for letter, cost, s, t in edges[codes[place]] if place < n else ():
                if s == state:
                    yield letter, cost, place + 1, t
            yield "I", INSERT, place, NEXT[state]
        else:
            for letter, cost, s, t in edges[codes[place - 1]] if place else ():
                if t == state:
                    yield letter, cost, place - 1, s
            for s, t in NEXT.items():
                if t == state:
                    yield "I", INSERT, place, s

    labels = ({(0, start): (0, "")}, {(n, t): (0, "") for t in ends})
    heaps = ([(0, 0, start)], [(0, 0, t) for t in sorted(ends)])
    settled: tuple[set, set] = (set(), set())
    best = 0 if n == 0 and start in ends else float("inf")
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = int(heaps[1][0] < heaps[0][0])
        cost, used, state = heappop(heaps[side])
        node = (n - used if side else used, state)
        if node in settled[side]:
            continue
        settled[side].add(node)
        audit = labels[side][node][1]
        for letter, price, place, other in steps(side, *node):
            found = (cost + price, letter + audit if side else audit + letter)
            at = (place, other)
            if at not in labels[side] or found < labels[side][at]:
                labels[side][at] = found
                heappush(heaps[side], (found[0], n - place if side else place, other))
                if at in labels[1 - side]:
                    best = min(best, found[0] + labels[1 - side][at][0])
    crossings = [(f[0] + labels[1][v][0], f[1] + labels[1][v][1]) for v, f in labels[0].items() if v in labels[1]]
    return min(crossings, default=None)


def all_pairs(codes: str) -> list[dict]:
    """Cheapest edits between all pairs of states."""
    found = {(s, t): cheapest(codes, s, (t,)) for s in range(4) for t in range(4)}
    return [{"start": s, "end": t, "cost": x[0], "audit": x[1]} for (s, t), x in found.items() if x]


def joined(left: list[dict], right: list[dict]) -> list[dict]:
    """The same for two neighbouring segments."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for x in left:
        for y in right:
            if x["end"] == y["start"]:
                key, found = (x["start"], y["end"]), (x["cost"] + y["cost"], x["audit"] + y["audit"])
                best[key] = min(best.get(key, found), found)
    return [{"start": s, "end": t, "cost": c, "audit": a} for (s, t), (c, a) in best.items()]


def with_faults(turns: DataFrame, workspace: Workspace) -> DataFrame:
    """Numbered rows: conv_id, turn, role, text, place (dense over all conversations, in order) and fault."""
    plain = turns.select(
        F.col("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    marked = plain.withColumn("mark", F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    rows = number_rows(marked, ["conv_id", "turn", "role", "mark"], "place", workspace, "turns")
    often = rows.groupBy(F.col("conv_id").alias("conv_"), F.col("mark").alias("mark_")).agg(F.min("place").alias("first_"), F.count(F.lit(1)).alias("n_"))
    often = workspace.store("turns_often", often.where("n_ > 1").drop("n_"))
    rows = rows.join(often, rows["conv_id"].eqNullSafe(often["conv_"]) & (rows["mark"] == often["mark_"]), "left")
    cut = F.btrim("text", F.lit(SPACE))
    fault = (
        F.when(cut == "", BLANK).when(F.col("place") > F.col("first_"), DUPLICATE)
        .when(~F.substring(cut, -1, 1).isin(".", "!", "?"), TRUNCATED)
    )
    return rows.select("conv_id", "turn", "role", "text", "place", fault.alias("fault"))


def audits(rows: DataFrame, workspace: Workspace, segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """conv_id, first (place of the conversation's first row), cost and audit, from ``with_faults``'s rows."""
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(F.col("fault").isin(BLANK, DUPLICATE), "d").when(F.col("fault") == TRUNCATED, F.upper(known)).otherwise(known)
    cut = F.expr(f"place div {segment}").alias("segment")
    listed = rows.select("conv_id", "place", code.alias("code")).groupBy("conv_id", cut)
    listed = listed.agg(F.sort_array(F.collect_list(F.struct("place", "code"))).alias("x"))
    first, last = F.col("x")[0]["place"], F.element_at("x", -1)["place"]
    listed = listed.select(
        "conv_id", "segment", first.alias("first"), F.array_join("x.code", "").alias("codes"),
        ((first % segment != 0) & (last % segment != segment - 1)).alias("whole"),
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, bool], list[dict]] = {}
        for batch in batches:
            tables = []
            for codes, whole in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if (codes, whole) not in known:
                    if len(known) >= KNOWN:
                        known.clear()
                    cost, audit = cheapest(codes) if whole else (0, "")
                    known[codes, whole] = [{"start": BEGIN, "end": BEGIN, "cost": cost, "audit": audit}] if whole else all_pairs(codes)
                tables.append(known[codes, whole])
            columns = [*batch.columns[:3], batch.column(4), pa.array(tables, pa.list_(kind))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "segment", "first", "whole", "found"])

    def combine(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table["segment"].to_pylist(), table["found"].to_pylist(), strict=True), key=lambda p: p[0])
        out = parts[0][1]
        for _, found in parts[1:]:
            out = joined(out, found)
        conv, segments = table["conv_id"].slice(0, 1).combine_chunks(), pa.array([parts[0][0] // fan])
        starts = pa.array([min(table["first"].to_pylist())])
        return pa.table([conv, segments, starts, pa.array([out], pa.list_(kind))], names=["conv_id", "segment", "first", "found"])

    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    conv = rows.schema["conv_id"].dataType.simpleString()
    solved = workspace.store("segments", listed.mapInArrow(solve, f"conv_id {conv}, segment bigint, first bigint, whole boolean, found {TABLE}"))
    parts = solved.where("NOT whole").drop("whole")
    most = parts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    step = 0
    while most > 1:
        step += 1
        near = parts.groupBy("conv_id", F.expr(f"segment div {fan}").alias("near_"))
        parts = workspace.store(f"segments_{step}", near.applyInArrow(combine, f"conv_id {conv}, segment bigint, first bigint, found {TABLE}"))
        most = parts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    right = F.filter("found", lambda x: (x["start"] == BEGIN) & x["end"].isin(*RIGHT))
    best = F.array_min(F.transform(right, lambda x: F.struct(x["cost"], x["audit"])))
    whole = solved.where("whole").select("conv_id", "first", F.col("found")[0]["cost"].alias("cost"), F.col("found")[0]["audit"].alias("audit"))
    cut_ = parts.select("conv_id", "first", best.alias("b")).select("conv_id", "first", "b.cost", "b.audit")
    return whole.unionAll(cut_)


def _cut(found: DataFrame, segment: int) -> DataFrame:
    """The audits in pieces of ``segment`` edits, each at the place of the row with which it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, places, texts = [], [], []
            for k, (place, audit) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for low in range(0, len(audit), segment):
                    piece = audit[low : low + segment]
                    at.append(k)
                    places.append(place)
                    texts.append(piece)
                    place += len(piece) - piece.count("I")
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(places, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "place", "audit"])

    conv = found.schema["conv_id"].dataType.simpleString()
    return found.select("conv_id", "first", "audit").mapInArrow(run, f"conv_id {conv}, place bigint, audit string")


def repair(turns: DataFrame, workspace: Workspace, segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """All rows with their edits, and the rows put in: conv_id, turn, was (the role before), role, text, fault,
    edit (K, R, D or I). What is not deleted is the repaired conversation. Rows of a conversation are in one
    partition, in order and without others between them."""
    rows = workspace.store("turns_marked", with_faults(turns, workspace))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, letters, state = object(), "", BEGIN
        for batch in batches:
            for part in slices(batch):
                out = []
                for own, _, piece, turn, role, text, fault in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if own != conv:
                        conv, letters, state = own, "", BEGIN
                    if piece is not None:
                        letters += piece
                    else:
                        edit, letters, new = letters[0], letters[1:], role
                        if edit == "K":
                            state = KEPT[role[0]][state]
                        elif edit == "R":
                            state = NEXT[state]
                            new = ROLES[state]
                        out.append((own, turn, role, new, text, fault, edit))
                    while letters[:1] == "I":
                        state, letters = NEXT[state], letters[1:]
                        out.append((own, None, None, ROLES[state], "", None, "I"))
                columns = zip(*out, strict=True) if out else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    conv = rows.schema["conv_id"]
    kinds = [to_arrow_type(conv.dataType), pa.int64(), *[pa.string()] * 5]
    names = ["conv_id", "turn", "was", "role", "text", "fault", "edit"]
    schema = f"conv_id {conv.dataType.simpleString()}, turn bigint, was string, role string, text string, fault string, edit string"
    none = F.lit(None).cast("string")
    pieces = _cut(audits(rows, workspace, segment, fan), segment)
    pieces = pieces.select("conv_id", "place", "audit", F.lit(None).cast("bigint").alias("turn"), *[none.alias(c) for c in ("role", "text", "fault")])
    both = pieces.unionAll(rows.select("conv_id", "place", none.alias("audit"), "turn", "role", "text", "fault"))
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "place", F.col("audit").asc_nulls_last())
    return ordered.mapInArrow(run, schema)


def summary(edited: DataFrame) -> DataFrame:
    """Per conversation of ``repair``'s result: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seen = object(), None
        for batch in batches:
            out = []
            for part in slices(batch):
                for own, turn, was, role, text, fault, edit in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if own != conv:
                        if seen:
                            out.append(seen.row(conv))
                        conv, seen = own, _Summary()
                    seen.add(turn, was, role, text, fault, edit)
            yield shaped(out)
        yield shaped([seen.row(conv)] if seen else [])

    def shaped(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    conv = edited.schema["conv_id"]
    kinds = [to_arrow_type(conv.dataType), *[pa.int64()] * 6, pa.string(), pa.string()]
    names = ["conv_id", "gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost", "audit", "repaired_sha256"]
    counts = ", ".join(f"{n} bigint" for n in names[1:7])
    return edited.mapInArrow(run, f"conv_id {conv.dataType.simpleString()}, {counts}, audit string, repaired_sha256 string")


class _Summary:
    """What is counted of one conversation, row by row."""

    def __init__(self) -> None:
        self.low = self.high = self.role = None
        self.turns = self.illegal = self.cost = 0
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.audit: list[str] = []
        self.hash, self.empty = hashlib.sha256(), True

    def add(self, turn: int | None, was: str | None, role: str, text: str, fault: str | None, edit: str) -> None:
        if was is not None:
            if turn is not None and turn != self.high:  # in order, so equal turns are neighbours
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
            if fault:
                self.faults[fault] += 1
            if self.role is not None:
                self.illegal += self.role[:1] + was[:1] not in ("su", "ua", "au")
            self.role = was
        self.audit.append(edit)
        self.cost += COSTS[edit] + SPOILT * (fault == TRUNCATED and edit != "D")
        if edit != "D":
            self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False

    def row(self, conv: object) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()
