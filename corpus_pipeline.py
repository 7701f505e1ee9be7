"""A corpus pipeline: toxicity, exact copies, near copies, repeated passages, packing. Counted as part of waymark.llm.

Each stage takes (spark, docs, sf_dir) and reads the rows that the stage before it kept. All stages but the last return the
columns of documents; columns that docs has besides them stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import exact_dedup, jaccard_join, packing, suffix_dedup, toxicity
from waymark.llm.common import free_name, numbered, pick, row_column, written
from waymark.llm.queries import WORDS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; it learns from the rows outside fold 0 of docs and of labels.

    Each row is judged by its own text alone: null and empty texts stay, as do repeated and null ids. An empty table gives none.
    """
    return toxicity.drop_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id.

    Null and empty texts are equal; of rows that repeat the largest id the last one stays, and null ids come last. An empty
    table gives none.
    """
    docs = numbered(docs)
    return pick(docs, exact_dedup.exact_dedup(docs).filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets the row with the least doc_id; texts without words (null, empty) all stay.

    Groups are told apart by their root, so that ids that repeat join no groups; null ids come last, and of rows that repeat
    the least id the first one stays. An empty table gives none.
    """
    docs = numbered(docs)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("m")
    return pick(docs, jaccard_join.similar_groups(docs).groupBy("root").agg(best).select("m.row"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without bytes that strings of 200 bytes repeat elsewhere; parts of a character that a cut leaves go too.

    Every row stays, also one that loses all its text; texts that lose nothing stay as they are, null ones too. n_chars is
    set anew where docs has it. An empty table gives none.
    """
    docs = numbered(docs)
    row, kept = row_column(docs), free_name(docs, "kept_text")
    cut = suffix_dedup.suffix_dedup(docs, with_text=True).filter("n_removed > 0").select(F.col("row").alias(row), F.col("kept_text").alias(kept))
    # An empty rest is no null: only rows that lost nothing have none.
    new = {"text": F.coalesce(F.col(kept), F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length(kept).cast("long"), F.col("n_chars"))
    return docs.join(cut.hint("shuffle_hash"), row, "left").withColumns(new).drop(row, kept)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all that is left, in sequences of at most 4,096 tokens; a null or empty text is one piece, its end id.

    Rows that repeat, or have null ids, are packed each on its own. An empty table gives no piece.
    """
    return packing.pack(docs, WORDS)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("jaccard_join", drop_near_copies), ("suffix_dedup", cut_repeats), ("packing", pack)]

#: SQL can express neither the learned classifier nor the tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
