"""Cross-site boilerplate lines by distinct-site spread.

A line is a text between line feeds without the spaces around it.  Lines of at
least ``min_words`` words (one, unless stated otherwise: all lines that are not
blank) are hashed, and the sites (sources) of each hash are counted with
HyperLogLog sketches, built per task and merged by the aggregation.  Estimates
near the threshold are replaced by exact distinct counts.  A line on ``MIN_SITES`` or more sites is boilerplate: it is removed
from every document but the first that holds it (least id), and there from all
places but the first.

A third of all rows may hold one line: sketches and counts are summed before
the shuffle, and joins have one row per line or document on one side, so a hot
line is split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialise

MIN_SITES = 4
MIN_WORDS = 1
SKETCH_BITS = 12     # 2^12 registers: a standard error of 1.6 %
NEAR = 0.15          # estimates within this part of the threshold (9 errors) are counted exactly


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _line_key(line: Column, min_words: int) -> Column:
    """Hash of a line that counts, else null."""
    bare = F.trim(line, F.lit(" \t\r\x0b\x0c"))
    return F.when(F.regexp_count(bare, F.lit(WORD)) >= min_words, F.xxhash64(bare))


def _document_key(docs: DataFrame) -> Column:
    """Orders documents by id (null ids first) and tells repeated ids with other texts apart."""
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"))


def line_places(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per place of a counted line: doc, site (a hash), place, line (a hash)."""
    site = F.xxhash64(F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit("-")))
    return (docs.select(_document_key(docs).alias("doc"), site.alias("site"),
                        F.posexplode(F.transform(_lines(F.col("text")), lambda x: _line_key(x, min_words))).alias("place", "line"))
            .where(F.col("line").isNotNull()))


def line_spread(places: DataFrame, min_sites: int = MIN_SITES, near: float = NEAR) -> DataFrame:
    """Lines on at least ``min_sites`` sites: line, n_sites and the document that keeps it.

    Lines seen on one site only are let go before any sketch is built: the least
    and greatest site agree.
    """
    several = materialise(places.groupBy("line").agg(F.min("site").alias("low"), F.max("site").alias("high"),
                                                     F.min(F.struct("doc", "place")).alias("keeper"))
                          .where(F.col("low") != F.col("high")).select("line", "keeper"), "lines-several")
    shared = materialise(places.select("line", "site").join(several.select("line"), "line"), "lines-shared")
    sketched = (shared.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("estimate")))
    sketched = materialise(sketched.where(F.col("estimate") >= min_sites * (1 - near)), "lines-sketched")
    unsure = sketched.where(F.col("estimate") <= min_sites * (1 + near)).select("line")
    # (line, site) pairs are made distinct before the count, so a hot line sends one row per site and task
    exact = (shared.join(unsure, "line").select("line", "site").distinct()
             .groupBy("line").agg(F.count("*").alias("exact")))
    return (sketched.join(exact, "line", "left")
            .withColumn("n_sites", F.coalesce("exact", "estimate"))
            .where(F.col("n_sites") >= min_sites)
            .join(several, "line").select("line", "n_sites", "keeper"))


def removals(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """Places to take out: one row per affected document: doc, drop_places (bounded by its own lines).
    """
    places = materialise(line_places(docs, min_words), "line-places")
    spread = materialise(line_spread(places, min_sites), "line-spread")
    hit = places.select("line", "doc", "place").join(spread.select("line", "keeper"), "line")
    # ids may be null: compared null-safely
    kept = F.col("doc.id").eqNullSafe(F.col("keeper.doc.id")) & (F.col("doc.text_key") == F.col("keeper.doc.text_key")) \
        & (F.col("place") == F.col("keeper.place"))
    return hit.where(~kept).groupBy("doc").agg(F.collect_set("place").alias("drop_places"))


def clean_lines(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS,
                counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with cross-site boilerplate lines taken out of ``text``.

    Adds two columns, named by ``counts``: lines of the input text, and lines taken
    out; columns of ``docs`` of these names are replaced, all others stay as they are.
    Null and empty texts are left alone; a null source is one site; repeated rows (same
    id and text) are one document: all of them lose or keep a line together; blank
    lines and lines of fewer than ``min_words`` words never count.  A document may be
    left empty if all its lines stay in others.  Work is linear in a document's lines.
    """
    mine = docs.drop(*counts)
    drop = removals(mine.select("doc_id", "text", "source"), min_sites, min_words)
    drop = materialise(drop.select(F.col("doc.id").alias("__id"), F.col("doc.text_key").alias("__text_key"),
                                   F.col("drop_places").alias("__drop")), "line-drops")
    keyed = mine.withColumn("__text_key", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    joined = keyed.join(drop, keyed["doc_id"].eqNullSafe(drop["__id"]) & (keyed["__text_key"] == drop["__text_key"]), "left")
    # a generator's column: the text is split once, however often its lines are read
    split = joined.select(*[mine[c] for c in mine.columns], "__drop", F.explode(F.array(_lines(F.col("text")))).alias("__lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))  # in order, by a hash set
    kept = F.array_join(F.transform(places, lambda i: F.col("__lines")[i]), "\n")
    return split.select(*[F.when(F.col("__drop").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text"
                          else F.col(f"`{c}`") for c in mine.columns],
                        F.when(F.coalesce(F.col("text"), F.lit("")) == "", 0).otherwise(F.size("__lines")).alias(counts[0]),
                        F.coalesce(F.size("__drop"), F.lit(0)).alias(counts[1]))
