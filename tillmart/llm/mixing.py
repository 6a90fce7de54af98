"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document draws an exponential key, -ln(u) / weight: u comes from a digest of its id, or of its text if it
has none; the weight is a column that the caller names (a classifier's score, say), or the share of letters
in the text. A source whose target is e times its size gives floor(e) complete epochs and
then the documents of smallest keys whose sizes, summed in key order, reach the rest of the target;
the document that crosses it is taken if that brings the sum nearer.

No source is ever sorted as a whole: keys fall into ``BINS`` bins that keep their order, bin
totals are summed on the map side, and a running sum over a source's bins finds the one bin where the
rest is reached; that bin is divided again in the same way, and only the documents of the last small
bin are ordered row by row.

Targets: sources in code point order, null last, weigh 1, 2, 3, repeating, and share the size of the
whole; a target stops at ``CAP`` times its source's size and the excess is shared again by weight. That
is the level L at which min(cap, L * weight) adds up to the whole, found by running sums over sources
ordered by cap / weight (one row per source).

Defined cases: null and empty texts have size 0 and are taken 0 words; a source without words has
target 0; repeated rows are documents of their own; a null or negative weight counts as 0, and 0 as the
least weight, a hundredth. Rows without id draw by their texts, so equal ones draw alike. Ties of keys go by
id, size and digest of the text, then row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.workspace import Workspace

CAP = 3
CYCLE = 3
BINS = 2048
#: Words of this pattern are the unit of size.
WORD = r"[^\x20\x09-\x0D]+"
_SEED = "mix-1"
_ORDER = ["key", "doc_id", "size", "tie", "row"]


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def quality_of(text: str = "text") -> Column:
    """Weight in hundredths, 20 to 100: the share of letters among the text's characters."""
    letters = F.length(F.regexp_replace(F.col(text), r"[^\p{L}]+", "")) * 100
    share = F.floor(letters / F.greatest(F.length(text), F.lit(1)))
    return F.greatest(F.lit(20), F.coalesce(share, F.lit(20))).cast("bigint")


def tie_of(text: str = "text") -> Column:
    """Part of the text's digest; tells apart rows of one id."""
    return F.substring(F.md5(F.coalesce(F.col(text), F.lit(""))), 1, 16)


def weight_of(column: str) -> Column:
    """Weight in hundredths, at least 1, from a column of shares from 0 to 1."""
    return F.greatest(F.lit(1.0), F.coalesce(F.col(f"`{column}`").cast("double"), F.lit(0.0)) * 100)


def sampling_key(weight: Column, row: str = "doc_id", text: str = "text") -> Column:
    """-ln(u) / weight with u in (0, 1) from 48 bits of a digest of the id; without id, of the text's digest."""
    drawn = F.coalesce(F.col(row).cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce(text, F.lit("")))))
    digest = F.md5(F.concat(F.lit(_SEED + ":"), drawn))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def targets(sizes: DataFrame) -> DataFrame:
    """Per source its target. ``sizes`` has one row per source: source, source_size."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % CYCLE + 1).cast("bigint"))
    ranked = ranked.withColumn("cap", F.col("source_size") * CAP)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = rest / F.sum("weight").over(after)  # if all sources before this one are at their caps
    found = ranked.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    shared = found.withColumn("shared", F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("shared.level"))
    return shared.select("source", "source_size", target.alias("target"))


def _reached(sums: DataFrame, keys: list[str], bin_name: str) -> DataFrame:
    """Per ``keys`` the first bin at which the running sum exceeds ``rest``, and the sum before it."""
    running = Window.partitionBy(*keys).orderBy(bin_name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = sums.withColumn("upto", F.sum("words").over(running)).where(F.col("upto") > F.col("rest"))
    first = F.min(F.struct(F.col(bin_name).alias("at"), (F.col("upto") - F.col("words")).alias("before")))
    return passed.groupBy(*keys).agg(first.alias("found"))


def mix(docs: DataFrame, workspace: Workspace, text: str = "text", weight: str | None = None) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies (epochs it is in), taken (words,
    repeats counted). ``weight`` names a column of shares from 0 to 1."""
    weights = weight_of(weight) if weight else quality_of(text)
    measured = docs.select(
        "doc_id", "source", size_of(text).alias("size"), sampling_key(weights, text=text).alias("key"),
        tie_of(text).alias("tie"), F.monotonically_increasing_id().alias("row"),
    )
    # Keys are exponential: 1 - exp(-key * mean weight) spreads them over the unit interval, in order.
    spread = 1 - F.exp(-60 * F.col("key"))
    measured = measured.withColumn("bin", F.least(F.floor(spread * BINS), F.lit(BINS - 1)).cast("int"))
    finer = F.floor((spread * BINS - F.col("bin")) * BINS)
    measured = measured.withColumn("fine", F.greatest(F.lit(0), F.least(finer, F.lit(BINS - 1))).cast("int"))
    measured = workspace.store("measured", measured)

    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    quota = targets(sizes)
    quota = quota.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    quota = quota.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    quota = workspace.store("quota", quota.withColumn("sid", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))))

    rows = measured.withColumn("sid", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))).drop("source")
    bins = rows.groupBy("sid", "bin").agg(F.sum("size").alias("words"))
    coarse = _reached(bins.join(quota.select("sid", "rest"), "sid"), ["sid"], "bin")
    coarse = workspace.store("coarse", coarse.select("sid", F.col("found.at").alias("cut"), F.col("found.before").alias("before")))
    inside = rows.join(coarse, "sid").where(F.col("bin") == F.col("cut"))
    fine = inside.groupBy("sid", "before", "fine").agg(F.sum("size").alias("words"))
    fine = fine.join(quota.select("sid", (F.col("rest")).alias("whole")), "sid").withColumn("rest", F.col("whole") - F.col("before"))
    fine = _reached(fine, ["sid", "before"], "fine")
    fine = fine.select("sid", F.col("found.at").alias("cut_fine"), (F.col("before") + F.col("found.before")).alias("sure"))
    fine = workspace.store("fine", fine)

    last = inside.drop("before", "cut").join(fine, "sid").where(F.col("fine") == F.col("cut_fine"))
    order = Window.partitionBy("sid").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("sure")
    last = last.withColumn("ahead", ahead).join(quota.select("sid", "rest"), "sid")
    over = F.col("ahead") + F.col("size") - F.col("rest")
    taken = last.where((F.col("ahead") < F.col("rest")) & (over <= F.col("rest") - F.col("ahead")))
    ends = taken.groupBy("sid").agg(F.max(F.struct(*_ORDER)).alias("end"))

    cuts = quota.join(coarse.select("sid", "cut"), "sid", "left").join(fine.select("sid", "cut_fine"), "sid", "left")
    cuts = workspace.store("cuts", cuts.join(ends, "sid", "left").drop("source"))  # one row per source
    joined = rows.join(cuts, "sid")
    at_cut = F.col("bin") == F.col("cut")
    below = (F.col("bin") < F.col("cut")) | (at_cut & (F.col("fine") < F.col("cut_fine")))
    edge = at_cut & (F.col("fine") == F.col("cut_fine")) & (F.struct(*_ORDER) <= F.col("end"))
    part = (F.col("rest") > 0) & (F.coalesce(below, F.lit(False)) | F.coalesce(edge, F.lit(False)))
    return joined.select(
        "doc_id",
        F.expr("CASE WHEN sid = 'null' THEN NULL ELSE substring(sid, 2) END").alias("source"),
        "size",
        "source_size",
        "target",
        (F.col("epochs") + part.cast("int")).cast("bigint").alias("copies"),
        ((F.col("epochs") + part.cast("int")) * F.col("size")).cast("bigint").alias("taken"),
        "tie",
    )
