"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Two lines are near copies if their edit distance is at most ``tau``. A line of length n is cut into
tau + 1 segments, so some segment of a line occurs unchanged in every near copy, at a place that differs
by few characters. Distinct lines index their segments under (length, number, substring); longer or
equally long lines probe the index with the substrings that can match: per length and segment only the
places that leave enough edits for both sides. What meets is verified by a banded bit-parallel edit
distance: per number of edits one bit for each of 2 * tau + 1 diagonals, moved on by shifts and masks.

Where many lines share a segment (over ``CROWD`` pairs under one key) they aren't paired. With tau = 1
such lines are refined step by step instead: a step cuts the part of the line that may hold the edit into
``FINER`` parts, and lines go on only under the parts around which some other line agrees with them. What is
left are parts of ``SMALL`` characters; lines that agree around one, and in all but one character of
it, with its place, are near copies of each other, all of them, so each is linked with the smallest only.
A line that shares its beginning with thousands, and nothing else, ends in the first step. The work grows with
the crowd, not with its square, and no link between classes is lost. With a larger tau crowds are
paired like other lines.

Texts are cut once; what is written and shuffled are hashes. Equal keys are combined on the map side to
their number, least and greatest line, so keys of one line, nearly all of them, end there, also those of
a line that a third of all texts share. Only lines that meet others are read again as text. Links
of near copies are united to classes; of a class the first occurrence (smallest id, then place, then hash
of the text) stays.

Lines are text between line ends, without the white space around them. Lines of every length are compared,
from ``SHORTEST`` code points on, so two lines of one character are near copies; lines without any character
are neither counted nor dropped. Equality is that of 128 bits of hash, near copies go by 64 of them.

Defined cases: null and empty texts have no lines. A null id is smaller than any other. An id with several
texts, and rows without id, are told apart by a hash of the text: every text has its own places,
and its row in the report. Rows that repeat an id and a text have one row there, in which their lines count
as often as they are there; if one's line stays, all of theirs stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.llm.frames import maybe_among
from tillmart.llm.minhash import unite
from tillmart.workspace import Workspace

TAU = 1
SHORTEST = 1
CROWD, FINER, SMALL = 100, 4, 6


def segment(length: Column, tau: int, i: int | Column) -> tuple[Column, Column]:
    """Place (from 0) and length of segment i of a line; the last ones take the rest."""
    i = i if isinstance(i, Column) else F.lit(i)
    base, rest = F.floor(length / (tau + 1)), length % (tau + 1)
    place = base * i + F.greatest(F.lit(0), i - (tau + 1) + rest)
    return place.cast("int"), (base + (i >= F.lit(tau + 1) - rest).cast("int")).cast("int")


def _key(line: Column, length: Column, i: int, place: Column, size: Column) -> Column:
    return F.xxhash64(length, F.lit(i), F.substring(line, place + 1, size))


def index_keys(line: str, tau: int) -> Column:
    n = F.length(line)
    return F.array(*[_key(F.col(line), n, i, *segment(n, tau, i)) for i in range(tau + 1)])


def probe_keys(line: str, tau: int) -> Column:
    """Keys under which shorter or equally long near copies may be indexed."""
    n = F.length(line)
    keys = []
    for less in range(tau + 1):
        for i in range(tau + 1):
            place, size = segment(n - less, tau, i)
            for shift in range(max(-i, less - (tau - i)), min(i, less + tau - i) + 1):
                keys.append(_key(F.col(line), n - less, i, place + shift, size))
    return F.array(*keys)


def characters(line: str) -> Column:
    return F.regexp_extract_all(F.col(line), F.lit("(?s)."), F.lit(0))


def within(a: str, b: str, tau: int) -> Column:
    """Whether the edit distance of two arrays of characters is at most tau.

    Bit d of mask e says that i characters of ``a`` and i + d - tau of ``b`` are used with e edits at
    most. A character of ``a`` keeps the diagonal if it matches, or costs one edit: replaced (same
    diagonal) or left out (one lower); one of ``b`` left out moves one higher."""
    full = (1 << (2 * tau + 1)) - 1
    match = " | ".join(f"IF(get({a}, i) = get({b}, i + {d - tau}), {1 << d}, 0)" for d in range(2 * tau + 1))
    start = ", ".join(f"'r{e}', {sum(1 << (tau + k) for k in range(e + 1)) & full}" for e in range(tau + 1))
    level = "s.r0 & m"
    step = [f"'r0', {level}"]
    for e in range(1, tau + 1):
        level = f"((s.r{e} & m) | s.r{e - 1} | shiftright(s.r{e - 1}, 1) | shiftleft({level}, 1)) & {full}"
        step.append(f"'r{e}', {level}")
    moved = f"element_at(transform(array({match}), m -> named_struct({', '.join(step)})), 1)"
    places = f"filter(transform({a}, (c, i) -> i), i -> true)"
    reached = f"(shiftright(s.r{tau}, size({b}) - size({a}) + {tau}) & 1) = 1"
    return F.expr(f"abs(size({a}) - size({b})) <= {tau} AND aggregate({places}, named_struct({start}), (s, i) -> {moved}, s -> {reached})")


def occurrences(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, own (hash of the text), place, line and its two hashes, for every line and for texts without
    one. Lines without a character are empty; their hashes are those of their place, so that they never meet."""
    own = F.xxhash64(F.col(text)).alias("own")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), own, F.posexplode_outer(F.split(F.col(text), "\n")).alias("place", "line"))
    rows = rows.withColumn("line", F.coalesce(F.btrim("line", F.lit(" \t\n\x0b\x0c\r")), F.lit("")))
    empty = F.col("line") == ""
    h1 = F.when(empty, F.xxhash64(F.lit(1), "doc_id", "own", "place")).otherwise(F.xxhash64("line"))
    h2 = F.when(empty, F.xxhash64(F.lit(2), "doc_id", "own", "place")).otherwise(F.xxhash64(F.lit("line"), "line"))
    return rows.select("doc_id", "own", "place", "line", h1.alias("h1"), h2.alias("h2"))


def with_keys(lines: DataFrame, tau: int = TAU) -> DataFrame:
    """``lines`` with ``index`` and ``probe``, the keys of the column ``line``; null for empty lines."""
    long = F.length("line") >= SHORTEST
    return lines.withColumns(
        {"index": F.when(long, F.array_distinct(index_keys("line", tau))), "probe": F.when(long, F.array_distinct(probe_keys("line", tau)))}
    )


def near_links(keyed: DataFrame, texts: Callable[[DataFrame], DataFrame], workspace: Workspace, tau: int = TAU) -> DataFrame:
    """Links (a, b) of lines within tau edits; of a crowd those that join it. keyed: id, index, probe;
    ``texts`` gives id and line of at least the wanted ids."""
    marked = F.concat(
        F.transform("index", lambda k: F.struct(k.alias("key"), F.lit(1).alias("i"))),
        F.transform("probe", lambda k: F.struct(k.alias("key"), F.lit(0).alias("i"))),
    )
    keys = keyed.where("index IS NOT NULL").select("id", F.explode(marked).alias("k")).select("id", "k.*")
    sizes = keys.groupBy("key").agg(F.sum("i").alias("i"), F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    crowd = (F.col("i") * (F.col("n") - F.col("i")) > CROWD) & F.lit(tau == 1)
    meetings = sizes.where("low != high AND i BETWEEN 1 AND n - 1").select("key", crowd.alias("crowd"))
    meetings = workspace.store("line_meetings", meetings)
    met = maybe_among(keys, "key", meetings.select("key")).join(meetings, "key").distinct()
    met = workspace.store("line_met", met)
    side = [met.where(f"NOT crowd AND i = {i}").select("key", F.col("id").alias(c)) for i, c in ((1, "a"), (0, "b"))]
    pairs = _ordered(side[0].join(side[1], "key"))
    members = met.where("crowd").select("id").distinct()
    pairs = workspace.store("line_pairs", pairs)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).unionAll(members).distinct()
    lines = workspace.store("line_texts", texts(wanted).dropDuplicates(["id", "line"]))
    crowds = crowd_links(lines.join(members, "id", "left_semi"), workspace)
    return verify(pairs.unionAll(crowds).distinct(), lines, tau)


def _ordered(met: DataFrame) -> DataFrame:
    pairs = met.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.distinct()


def crowd_links(lines: DataFrame, workspace: Workspace) -> DataFrame:
    """Pairs (a, b) that join all lines (id, line) within one edit of each other, without pairing them all.

    A row is a line with a range of places, from ``low`` to before ``high``, that may hold the edit. Rows of
    a line are under its own length, and under the next smaller length those in which the range has one
    character more. Rows go on if a line of the length itself and some other line agree around the range."""
    texts = lines.withColumn("n", F.length("line"))

    def around(more: Column, low: Column, high: Column) -> Column:
        line, n = F.col("line"), F.col("n")
        return F.xxhash64(n - more, low, high, F.substring(line, F.lit(1), low), F.substring(line, high + more + 1, n))

    ranges = [F.struct(F.lit(more).alias("more"), F.lit(0).alias("low"), (F.col("n") - more).alias("high")) for more in (0, 1)]
    rows = texts.select("id", F.inline(F.array(*ranges)))
    small, step = [], 0
    while True:
        step += 1
        parts = []
        for j in range(FINER):
            place, size = segment(F.col("high") - F.col("low"), FINER - 1, j)
            low = (F.col("low") + place).cast("int")
            high = (low + size).cast("int")
            parts.append(F.struct("more", low.alias("low"), high.alias("high"), around(F.col("more"), low, high).alias("key")))
        finer = workspace.store(f"line_parts{step}", rows.join(texts, "id").select("id", F.inline(F.array(*parts))))
        shared = finer.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.min("more").alias("least"))
        shared = shared.where("first < last AND least = 0").select("key")
        left = workspace.store(f"line_left{step}", finer.join(shared, "key", "left_semi").drop("key"))
        small.append(left.where(F.col("high") - F.col("low") <= SMALL))
        rows = left.where(F.col("high") - F.col("low") > SMALL)
        if not workspace.rows[f"line_left{step}"] or rows.isEmpty():
            break
    settled = reduce(DataFrame.unionAll, small).join(texts, "id")
    part = F.substring("line", F.col("low") + 1, F.col("high") - F.col("low") + F.col("more"))
    settled = settled.select("id", "more", around(F.col("more"), F.col("low"), F.col("high")).alias("item"), part.alias("part"))
    # A part without its character i stands for a replaced character, a gap at place i for one put in.
    keys = F.expr("""
        filter(concat(
            transform(sequence(1, length(part) + 1), i ->
                IF(more = 0, xxhash64(item, 'gap', i, substring(part, 1, i - 1), substring(part, i)), NULL)),
            transform(sequence(1, length(part) + 1), i ->
                IF(i <= length(part), xxhash64(item, IF(more = 0, 'one', 'gap'), i, substring(part, 1, i - 1), substring(part, i + 1)), NULL))
        ), k -> k IS NOT NULL)""")
    met = workspace.store("line_ends", settled.select("id", F.explode(keys).alias("key")))
    least = met.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("last")).where("a < last")
    return _ordered(met.join(least.select("key", "a"), "key").withColumnRenamed("id", "b"))


def verify(pairs: DataFrame, lines: DataFrame, tau: int = TAU) -> DataFrame:
    """Pairs within tau edits."""
    own = lines.select("id", characters("line").alias("c"))
    sides = pairs.join(own.select(F.col("id").alias("a"), F.col("c").alias("x")), "a")
    sides = sides.join(own.select(F.col("id").alias("b"), F.col("c").alias("y")), "b")
    return sides.where(within("x", "y", tau)).select("a", "b")


def classes(docs: DataFrame, workspace: Workspace, text: str = "text", tau: int = TAU) -> tuple[DataFrame, DataFrame]:
    """All occurrences (doc_id, own, place, full, h1, h2), and the lines that aren't alone: h1, h2, n_texts
    (distinct lines of the class), and doc_id, place and own of the class's first occurrence."""
    cut = with_keys(occurrences(docs, text), tau).withColumn("full", F.col("line") != "")
    rows = workspace.store("lines", cut.drop("line"))

    def texts(wanted: DataFrame) -> DataFrame:
        return maybe_among(occurrences(docs, text).select(F.col("h1").alias("id"), "line"), "id", wanted).join(wanted, "id", "left_semi")

    links = near_links(rows.select(F.col("h1").alias("id"), "index", "probe"), texts, workspace, tau)
    links = workspace.store("line_links", links)
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = workspace.store("line_nodes", nodes.select("node", F.col("node").alias("label")))
    labels = unite(labels, links, workspace, "line_unite")
    distinct = rows.where("full").groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "place", "own")).alias("first"), F.count(F.lit(1)).alias("n"))
    marked = distinct.join(labels, distinct["h1"] == labels["node"], "left").where("n > 1 OR label IS NOT NULL")
    # A class of near copies goes by its label, a line of its own by both hashes.
    marked = marked.select("h1", "h2", "first", F.coalesce("label", "h1").alias("label"), F.when(F.col("label").isNull(), F.col("h2")).alias("own"))
    marked = workspace.store("line_classes", marked)
    kept = marked.groupBy("label", "own").agg(F.min("first").alias("keep"), F.count(F.lit(1)).alias("n_texts"))
    kept = kept.withColumnsRenamed({"label": "label_", "own": "own_"})
    same = (F.col("label") == F.col("label_")) & F.col("own").eqNullSafe(F.col("own_"))
    found = marked.drop("first").join(kept, same).select("h1", "h2", "n_texts", "keep")
    return rows.select("doc_id", "own", "place", "full", "h1", "h2"), found


def _dropped() -> Column:
    return F.coalesce(F.struct("doc_id", "place", "own") != F.col("keep"), F.lit(False))


def _reported(rows: DataFrame, found: DataFrame, *more: Column) -> DataFrame:
    """The columns of :func:`report` for every id and text, after ``document``, both as one struct."""
    rows = rows.join(found, ["h1", "h2"], "left")
    near = F.coalesce(F.col("n_texts") > 1, F.lit(False))
    line = F.struct("place", "h1", "h2", "full", near.alias("near"), _dropped().alias("dropped"))
    # Rows that repeat are collected once, however many there are, and counted by the number of their lines.
    texts = rows.groupBy(F.struct("doc_id", "own").alias("document"))
    texts = texts.agg(F.array_sort(F.collect_set(line)).alias("lines"), F.count(F.lit(1)).alias("n"))
    kept = F.filter("lines", lambda x: x["full"] & ~x["dropped"])
    digest = F.sha2(F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["h1"], x["h2"])), ","), 256)
    flags = (("n_lines", "full"), ("n_near", "near"), ("n_dropped", "dropped"))
    counts = [F.expr(f"size(filter(lines, x -> x.{flag})) * (n div size(lines))").alias(name) for name, flag in flags]
    return texts.select("document", "document.doc_id", *counts, digest.alias("kept_sha256"), *more)


def report(docs: DataFrame, workspace: Workspace, text: str = "text", tau: int = TAU) -> DataFrame:
    """Per id and text: doc_id, n_lines, n_near (lines with near copies that aren't equal), n_dropped, and the
    SHA-256 of the kept lines' hashes in order."""
    return _reported(*classes(docs, workspace, text, tau)).drop("document")


def dedup(docs: DataFrame, workspace: Workspace, text: str = "text", tau: int = TAU) -> DataFrame:
    """:func:`report` with the text that :func:`clean` leaves, as ``text``, both from one search for near copies."""
    gone = F.expr("transform(filter(lines, x -> x.dropped), x -> x.place)").alias("gone")
    told = _reported(*classes(docs, workspace, text, tau), gone).withColumnRenamed("document", "document_")
    document = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("own"))
    texts = docs.select(document.alias("document"), F.col(text).alias("whole"))
    joined = texts.join(told, F.col("document") == F.col("document_"))
    # Rows that repeat an id and a text lie together after the join.
    nth = F.row_number().over(W.partitionBy("document").orderBy("document"))
    once = joined.withColumn("nth", nth).where("nth = 1")
    left = F.when(F.size("gone") == 0, F.col("whole")).otherwise(_without("whole", "gone"))
    return once.select("doc_id", "n_lines", "n_near", "n_dropped", "kept_sha256", left.alias("text"))


def _without(text: str, gone: str) -> Column:
    """A text without the lines at the places ``gone``."""
    return F.expr(f"array_join(filter(split(`{text}`, '\\n'), (l, i) -> NOT array_contains({gone}, i)), '\\n')")


def clean(docs: DataFrame, workspace: Workspace, text: str = "text", tau: int = TAU) -> DataFrame:
    """``docs`` with dropped lines taken out of the texts."""
    rows, found = classes(docs, workspace, text, tau)
    gone = rows.join(found, ["h1", "h2"]).where(_dropped()).groupBy("doc_id", "own").agg(F.collect_set("place").alias("gone_"))
    gone = gone.withColumnsRenamed({"doc_id": "gone_id_", "own": "own_"})
    same = docs["doc_id"].cast("bigint").eqNullSafe(gone["gone_id_"]) & (F.xxhash64(docs[text]) == gone["own_"])
    joined = docs.join(gone, same, "left")
    joined = joined.withColumn(text, F.when(F.col("gone_").isNull(), F.col(text)).otherwise(_without(text, "gone_")))
    return joined.drop("gone_", "gone_id_", "own_")
