"""SpotSigs document fingerprints, in DataFrame functions only.

A text's spots are chains that start at a common word (anchor): the anchor and the next ``CHAIN``
content words, further anchors skipped. The beginning of a text is an anchor, and a run of ``RUN`` words
without an anchor anchors itself, so short texts, tables and lists have spots too. The set of spots, 32 bits of
hash each, is the fingerprint; its text form is the set's size and all of its spots, from which likeness
can be computed again (``parsed``). Two sets are compared by Jaccard similarity. Sets are partitioned by
their length: with a least likeness ``tau`` only sets of one or neighbouring partitions can reach it, the others
aren't compared and count as 0. The query asks for every likeness (tau 0), so nothing is pruned there.

``fingerprints`` gives every document the one before it in id order (the next one descending). Ids fall into
buckets of 2**BUCKET consecutive ids, so one shuffle brings all but a bucket's last document beside its next;
there every text's set is made once and handed to its neighbour. Sets are stored as numbers, the fingerprints'
text is made from them by whoever reads the result. Buckets are
numbered by a range shuffle of one row each, and a bucket's end is linked with the next one's head. A bucket
of more than ``HOT`` rows, which takes ids that repeat or rows without id, is divided by id and leading bits of
the texts' hashes, and its equal rows become one row with their number, so no window holds an unbounded bucket.

Defined cases: null is an empty text; a text without words is one spot, an empty one has none. Two
empty sets have likeness 1, an empty and another 0. Rows that repeat an id follow each other in descending
order of their texts' hashes; null ids come last. A single row is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.operators.numbering import number_rows
from tillmart.workspace import Workspace

CHAIN, RUN = 2, 6
BUCKET, HOT = 6, 256
STORED = ["doc_id", "n_chars", "edited_sha256", "spots", "edited_spots", "near_edited", "near_next"]
RESULTS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
#: Common words of English, French, German and Spanish.
ANCHORS = (
    "the of and to in a is that it was for on are as with his they be at this have from or had by but not what all were we "
    "le la les de des du un une et est en que qui dans pour pas au par sur ce il elle ne se plus "
    "der die das und ist zu den mit von ein eine auf dem nicht sich des im auch es an "
    "el los las y del al lo su como más pero sus ya o este sí porque esta entre cuando muy sin sobre"
).split()


def spots(text: str) -> Column:
    """Sorted distinct spot hashes of a text column without nulls."""
    anchors = ", ".join(f"'{w}'" for w in dict.fromkeys(ANCHORS))
    chain = ", ".join(f"get(p.content, at - k + {c})" for c in range(CHAIN))
    return F.expr(f"""
        element_at(transform(array(filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w != '')), ws ->
        element_at(transform(array(transform(ws, (w, i) -> IF(w IN ({anchors}), i, -1 - i))), marks ->
        element_at(transform(array(named_struct(
            'anchors', filter(marks, m -> m >= 0),
            'places', transform(filter(marks, m -> m < 0), m -> -1 - m),
            'content', filter(ws, (w, i) -> get(marks, i) < 0))), p ->
        element_at(transform(array(filter(concat(
            array(IF(size(p.content) > 1, hash('^', get(p.content, 0), get(p.content, 1)), NULL)),
            transform(p.anchors, (at, k) -> IF(at - k < size(p.content), hash(get(ws, at), {chain}), NULL)),
            transform(p.places, (at, k) -> IF(k >= {RUN} AND at - get(p.places, k - {RUN}) = {RUN},
                hash('', get(p.content, k - 1), get(p.content, k)), NULL))), x -> x IS NOT NULL)), found ->
            CASE WHEN size(found) > 0 THEN array_sort(array_distinct(found))
                WHEN {text} = '' THEN found ELSE array(hash(IF(size(ws) > 0, array_join(ws, ' '), {text}))) END
        ), 1)), 1)), 1)), 1)""")


def fingerprint(found: str) -> Column:
    """The set's size and its spots, eight hexadecimal digits each."""
    return F.expr(f"concat(size({found}), ':', array_join(transform({found}, x -> lower(right(concat('0000000', hex(x)), 8))), ''))")


def parsed(fingerprint: str) -> Column:
    """The set of a fingerprint, as sorted texts of eight digits."""
    return F.regexp_extract_all(F.substring_index(F.col(fingerprint), ":", -1), F.lit("[0-9a-f]{8}"), F.lit(0))


def partition(found: str, tau: float) -> Column:
    """Partition of a set by its length: sets of likeness tau are in one or in neighbouring partitions."""
    return F.floor(F.log(F.greatest(F.size(found), F.lit(1)).cast("double")) / F.log(F.lit(1 / tau)))


def likeness(a: str, b: str, tau: float = 0) -> Column:
    """Jaccard similarity of two sets; with ``tau`` 0 where their lengths or the similarity stay below it."""
    same = F.size(F.array_intersect(a, b))
    exact = same / (F.size(a) + F.size(b) - same)
    if tau:
        exact = F.when(F.abs(partition(a, tau) - partition(b, tau)) > 1, 0.0).otherwise(F.when(exact >= tau, exact).otherwise(0.0))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(exact)


def edits(docs: DataFrame, text: str = "text", following: str = "next") -> DataFrame:
    """``docs`` with n_chars and edited: the text whose last half is replaced by the beginning of ``following``."""
    half = F.expr(f"CAST(length({text}) DIV 2 AS INT)")
    edited = F.concat(F.substring(F.col(text), F.lit(1), F.length(text) - half), F.substring(F.col(following), F.lit(1), half))
    return docs.withColumns({"n_chars": F.length(text).cast("bigint"), "edited": edited})


def compare(docs: DataFrame) -> DataFrame:
    """``docs`` (text, spots, next, next_spots) with all of ``STORED``."""
    sets = edits(docs).withColumn("edited_spots", spots("edited"))
    return sets.withColumns(
        {
            "edited_sha256": F.sha2("edited", 256),
            "near_edited": likeness("spots", "edited_spots"),
            "near_next": likeness("spots", "next_spots"),
        }
    ).drop("edited")


_BUCKET = ["bucket", "id_part", "text_part"]


def bucketed(docs: DataFrame, workspace: Workspace, text: str = "text") -> DataFrame:
    """Rows doc_id, text, place, own (hash of the text), copies (of equal rows) and their bucket."""
    place = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), place.alias("place"))
    rows = rows.withColumns({"own": F.xxhash64("text"), "bucket": F.shiftright("place", BUCKET)})
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT)
    hot = workspace.store("hot_buckets", counts.select("bucket", F.expr(f"cast(least(40, ceil(log2(n / {HOT})) + 1) AS INT)").alias("bits")))
    none = {"id_part": F.lit(0).cast("bigint"), "text_part": F.lit(0).cast("bigint"), "copies": F.lit(1).cast("bigint")}
    if not workspace.rows["hot_buckets"]:
        return rows.withColumns(none)
    rows = rows.join(hot, "bucket", "left")
    usual = rows.where("bits IS NULL").withColumns(none)
    parts = {"id_part": F.col("place"), "text_part": F.expr("shiftright(own, 64 - bits)")}
    split = rows.where("bits IS NOT NULL").withColumns(parts)
    split = split.groupBy("bucket", "id_part", "text_part", "doc_id", "place", "own").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    return usual.drop("bits").unionByName(split)


def fingerprints(docs: DataFrame, workspace: Workspace, text: str = "text") -> DataFrame:
    """Per row of ``docs`` the columns ``RESULTS``; next is the document of the next lower id, after the
    last the first. Texts are shuffled once; only bucket ends (one in 2**BUCKET) move again."""
    rows = bucketed(docs, workspace, text)
    keys = _BUCKET if workspace.rows["hot_buckets"] else _BUCKET[:1]  # constants would hide that rows are where windows need them
    turn = Window.partitionBy(*keys).orderBy(F.desc("place"), F.desc("own"))
    # Sets are made after the shuffle, which the windows need not repeat.
    placed = rows.repartition(*keys).withColumn("spots", spots("text"))
    placed = placed.withColumns({"next": F.lead("text").over(turn), "next_spots": F.lead("spots").over(turn), "number": F.row_number().over(turn)})
    # Bucket ends have no next yet; their text and that of bucket heads are kept for the second step.
    placed = placed.withColumn("is_end", F.col("next").isNull())
    kept = F.when(F.col("is_end") | (F.col("number") == 1), F.col("text")).alias("kept")
    first = workspace.store("inside", compare(placed).select(*STORED, *keys, "copies", "number", "is_end", kept))
    buckets = number_rows(first.where("number = 1").select(*keys, "kept", "spots"), keys, "at", workspace, "buckets")
    last = F.lit(workspace.rows["buckets"])
    heads = buckets.select((F.col("at") % last + 1).alias("above"), F.col("kept").alias("next"), F.col("spots").alias("next_spots"))
    ends = first.where("is_end").select("doc_id", *keys, "copies", F.col("kept").alias("text"), "spots").join(buckets.select(*keys, "at"), keys)
    across = compare(ends.join(heads, F.col("at") == F.col("above")))
    inside = first.where("NOT is_end")
    if not workspace.rows["hot_buckets"]:
        return _told(inside.select(*STORED).unionAll(across.select(*STORED)))
    # Of equal rows the last one has the next document beside it, the others each other.
    single = inside.select(*STORED, F.lit(1).alias("times")).unionAll(across.select(*STORED, F.lit(1).alias("times")))
    equal = rows.where("copies > 1").withColumn("spots", spots("text")).withColumns({"next": F.col("text"), "next_spots": F.col("spots")})
    equal = compare(equal).select(*STORED, (F.col("copies") - 1).cast("int").alias("times"))
    return _told(single.unionAll(equal).withColumn("time", F.explode(F.sequence(F.lit(1), "times"))))


def _told(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"fingerprint": fingerprint("spots"), "edited_fingerprint": fingerprint("edited_spots")}).select(*RESULTS)
