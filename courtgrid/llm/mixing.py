"""Mixing sources to target weights: hash-threshold histograms.

Every document has a fixed uniform hash.  A source takes whole documents: as
many full passes as its target allows, and in the last, partial pass those
documents whose hash lies below the source's threshold.  The threshold comes
from sums of sizes by source and hash bucket: the first bucket in which the
running sum passes the budget is the boundary, and only that bucket is split
into finer buckets for the next round.  Documents are filtered against the
threshold; nothing is sorted.  Budgets nest: a smaller budget of the same
source takes a subset of what a larger one takes.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise

WEIGHTS = (3, 1, 2)     # of the sources in code-point order, repeating
SHARE = 1.5             # of all sizes that the mix takes
MOST_PASSES = 2.0       # a source gives at most this many times its size
HASH_HEX = 15           # 60 bits of the document's hash
LEVEL_HEX = (3, 3, 3, 3, 3)  # hash digits that each round of histograms resolves


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: Column) -> Column:
    """60 uniform bits of the document's id as hex digits (null id: of the empty text)."""
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, HASH_HEX)


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                   most: float = MOST_PASSES) -> DataFrame:
    """Target of each source: (source, source_size, target).

    The level L solves sum(min(weight * L, most * size)) = share * total, which
    is where resharing the excess of full sources by weight ends.  Sources are
    ordered by code point with null last.  One row per source reaches the
    window, after the sizes have been summed.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int") + 1)
    ranked = (by_source.withColumn("weight", weight)
              .withColumn("cap", F.lit(most) * F.col("source_size"))
              .withColumn("full_at", F.col("cap") / F.col("weight")))
    filled = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, everything = filled.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    level = ((F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    solved = ranked.withColumn("level", level).withColumn(
        "reached", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "source", "level"))).over(everything)["level"])
    return solved.select("source", "source_size",
                         F.when(F.col("reached").isNull(), F.col("cap"))
                         .otherwise(F.least(F.col("cap"), F.col("weight") * F.col("reached"))).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame, levels: tuple = LEVEL_HEX) -> DataFrame:
    """Per source: full passes and the hash threshold (hex digits) of the partial pass.

    Returns (source_key, source_size, target, passes, threshold): documents with
    a hash below ``threshold`` are taken once more.
    """
    state = (targets.withColumn("source_key", _key(F.col("source")))
             .withColumn("passes", F.when(F.col("source_size") > 0,
                                          F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
             .withColumn("left", F.col("target") - F.col("passes") * F.col("source_size"))
             .withColumn("prefix", F.lit("")))
    state = materialise(state.select("source_key", "source_size", "target", "passes", "left", "prefix"), "mix-level")
    keyed = sized.select(_key(F.col("source")).alias("source_key"), "hash", "size")
    done = 0
    for digits in levels:
        # only rows in the boundary bucket so far: one bucket per source
        inside = (keyed if not done else
                  keyed.join(state.select("source_key", "prefix"), "source_key")
                  .where(F.substring("hash", 1, done) == F.col("prefix")).drop("prefix"))
        sums = (inside.groupBy("source_key", F.substring("hash", done + 1, digits).alias("bucket"))
                .agg(F.sum("size").alias("mass")))
        running = Window.partitionBy("source_key").orderBy("bucket")
        first = (sums.withColumn("before", F.coalesce(F.sum("mass").over(
                     running.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                 .join(state.select("source_key", "left"), "source_key")
                 .where(F.col("before") + F.col("mass") > F.col("left"))
                 .groupBy("source_key")
                 .agg(F.min(F.struct("bucket", "before", "mass")).alias("at")))
        step = state.join(first, "source_key", "left").select(
            "source_key", "source_size", "target", "passes",
            (F.col("left") - F.coalesce(F.col("at.before"), F.lit(0))).alias("left"),
            F.when(F.col("at").isNotNull() & F.col("prefix").isNotNull(),
                   F.concat("prefix", "at.bucket")).alias("prefix"),
            F.coalesce(F.col("at.mass"), F.lit(0)).alias("mass"))
        done += digits
        state = materialise(step, "mix-level").select("source_key", "source_size", "target", "passes", "left", "prefix", "mass")
    # the last bucket holds documents of one hash: taken if that comes nearer to the target
    nearer = F.col("mass") - F.col("left") < F.col("left")
    threshold = (F.when(F.col("prefix").isNull(), F.lit(None).cast("string"))
                 .when(nearer, F.concat("prefix", F.lit("~"))).otherwise(F.col("prefix")))
    return state.select("source_key", "source_size", "target", "passes", threshold.alias("threshold"))


def _key(source: Column) -> Column:
    """A join key that keeps null apart from every text."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> DataFrame:
    """Decide how many words of each document the mix takes.

    Returns one row per input row: doc_id, source, size, source_size, target,
    times (whole copies of the document) and taken = times * size.  Null texts
    have size 0 and are taken 0 words; a null source is a source of its own, the
    last; repeated ids share a hash and so a decision; an empty table gives an
    empty result.  Other columns of ``docs`` play no part.
    """
    sized = materialise(docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"),
                                    word_count(F.col("text")).alias("size"),
                                    document_hash(F.col("doc_id")).alias("hash")), "mix-sizes")
    targets = source_targets(sized, weights, share, most)
    limits = thresholds(sized, targets)
    joined = sized.withColumn("source_key", _key(F.col("source"))).join(limits, "source_key")
    # no boundary bucket: the whole source fits the budget once more, unless nothing is left
    extra = F.when(F.col("threshold").isNull(),
                   (F.col("passes") < F.floor(F.col("target") / F.greatest("source_size", F.lit(1))))
                   ).otherwise(F.col("hash") < F.col("threshold"))
    times = F.col("passes") + F.when(extra, 1).otherwise(0)
    return joined.select("doc_id", "source", "size", "source_size", "target", times.cast("long").alias("times"),
                         (times * F.col("size")).cast("long").alias("taken"))
