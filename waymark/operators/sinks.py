"""Stores of events, documents and geometries as partitioned Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.operators import convert
from waymark.sources import files

PARTITIONS = ["feed", "event_date"]
DOCUMENT = ["feed", "doc_id"]


def _dated(df: DataFrame, time: str) -> DataFrame:
    return df if "event_date" in df.columns else df.withColumn("event_date", F.to_date(time))


def _write(df: DataFrame, root: str, order: list[str], mode: str) -> None:
    """Few files for each date, sorted within; a large date is split by AQE, as this is a rebalance."""
    df.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, *order).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(root)


def write_events(events: DataFrame, root: str, mode: str = "append") -> None:
    _write(_dated(events, "publication_time"), root, ["source_id", "row_key"], mode)


def write_documents(docs: DataFrame, root: str, mode: str = "append") -> None:
    _write(_dated(docs, "event_time"), root, ["source_id", "doc_id"], mode)


def write_geometries(geometries: DataFrame, root: str, mode: str = "append") -> None:
    """Keyed by document id, so that the records of one situation stay apart."""
    _write(_dated(geometries, "event_time"), root, ["source_id", "doc_id"], mode)


def get_documents(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """Documents of one feed; other partitions aren't read."""
    return spark.read.parquet(root).filter(F.col("feed") == feed.lower())


def keep_last(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per feed and document id: the newest by row key, which sorts newest first."""
    w = Window.partitionBy(*DOCUMENT).orderBy(*(order or ["row_key", F.desc("json")]))
    return docs.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def upsert_documents(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """existing with incoming documents in place of those of the same id."""
    new = keep_last(incoming)
    return existing.join(new.select(*DOCUMENT), DOCUMENT, "left_anti").select(*existing.columns).unionByName(new.select(*existing.columns))


def upsert_into(spark: SparkSession, root: str, staging: str, incoming: DataFrame) -> None:
    """Upsert into a partitioned store, which need not exist: only dates that incoming touches are read, staged and replaced."""
    new = _dated(keep_last(incoming), "event_time")
    if not any(n.startswith("feed=") for n in files.names(root)):
        _write(new, root, ["source_id", "doc_id"], "append")
        return
    touched = new.select(*PARTITIONS).distinct()
    old = spark.read.parquet(root).join(touched, PARTITIONS, "left_semi")
    upsert_documents(old, new).write.mode("overwrite").parquet(staging)
    _write(spark.read.parquet(staging), root, ["source_id", "doc_id"], "overwrite")


def insert_new_documents(existing: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(inserted, conflicts): an id that exists, or is a later row of the same batch, is a conflict."""
    w = Window.partitionBy(*DOCUMENT).orderBy("row_key", F.desc("json"))
    ranked = incoming.withColumn("_n", F.row_number().over(w)).join(existing.select(*DOCUMENT, F.lit(True).alias("_had")).distinct(), DOCUMENT, "left")
    fresh = (F.col("_n") == 1) & F.col("_had").isNull()
    return ranked.filter(fresh).select(*incoming.columns), ranked.filter(~fresh).select(*incoming.columns)


def index_documents(events: DataFrame, selector: Callable[[DataFrame], DataFrame], writer: Callable[[DataFrame], None], tz: str = "UTC") -> None:
    """Events through a user's selection, conversion, and a user's writer."""
    writer(convert.converted(selector(events), tz))


def export_source(events: DataFrame, feed: str, source_id: str, path: str) -> None:
    """Each event of one source as text in a folder of its number, oldest first."""
    own = events.filter((F.col("feed") == feed.lower()) & (F.col("source_id") == source_id))
    w = Window.partitionBy("feed", "source_id").orderBy(F.desc("row_key"))
    own.select(F.row_number().over(w).alias("n"), F.col("xml").alias("value")).write.mode("errorifexists").partitionBy("n").text(path)
