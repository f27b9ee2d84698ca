"""The corpus pipeline: toxicity, line dedup, n-gram Jaccard join, mixing, packing.

Each stage is ``fn(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read back as the next stage's ``docs``.  All but the last return the
columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtgrid.llm import line_dedup, mixing, ngram_join, packing, toxicity
from courtgrid.llm.common import materialise, read_table
from courtgrid.llm.queries import tokenizer_file


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects (score >= 0.7) go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go; a document of which no line is left goes too.

    Lines of any length count, short ones too, by their spread over sites alone.
    Every line stays in the first document that has it.  ``n_chars`` of a changed
    text is counted anew; other documents keep all their values.
    """
    cleaned = line_dedup.clean_lines(docs, counts=("__n_lines", "__n_removed"))
    changed = F.col("__n_removed") > 0
    cols = [F.when(changed, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
            if c == "n_chars" else F.col(c) for c in docs.columns]
    return cleaned.where(~changed | (F.trim("text") != "")).select(*cols)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return ngram_join.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document is there as often as the mix takes it.

    Ids are unique after the stage before; rows equal in id and source are taken alike.
    """
    taken = mixing.mix(docs).select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("times").alias("__times")) \
        .where("__times > 0").distinct()
    joined = docs.join(materialise(taken, "mix-taken"), docs["doc_id"].eqNullSafe(F.col("__id"))
                       & docs["source"].eqNullSafe(F.col("__source")))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))) \
        .select(*[docs[c] for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("ngram_join", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The trained classifier and the tokenizer have no SQL form; tests/llm checks the
# stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
