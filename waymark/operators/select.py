"""Selecting events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.sources.shared import scratch


def events_for_feed(rows: DataFrame, feed: str) -> DataFrame:
    return rows.filter(F.col("feed") == feed.lower())


def events_in_range(events: DataFrame, from_date: str, to_date: str, time: str = "publication_time") -> DataFrame:
    """Times in (from_date, to_date + 1 day]: open at the start and closed at the end, as keys run backwards."""
    return events.filter((F.col(time) > F.lit(from_date).cast("timestamp")) & (F.col(time) <= F.date_add(F.lit(to_date).cast("date"), 1).cast("timestamp")))


def scan_sources(ids: DataFrame, events: DataFrame, feed: str, from_date: str, to_date: str, time: str = "publication_time") -> DataFrame:
    """Events in range of a feed's known sources: one join instead of a query for each."""
    return events_in_range(events_for_feed(events, feed), from_date, to_date, time).join(events_for_feed(ids, feed).select("feed", "source_id").distinct(), ["feed", "source_id"], "left_semi")


def every_nth(events: DataFrame, n: int) -> DataFrame:
    """Of each source, newest first, the events at 0, n, 2n and so on."""
    w = Window.partitionBy("feed", "source_id").orderBy("row_key")
    return events.withColumn("_n", F.row_number().over(w)).filter((F.col("_n") - 1) % n == 0).drop("_n")


def first_n(events: DataFrame, n: int) -> DataFrame:
    """The first n in order of (source_id, row_key)."""
    return events.orderBy("source_id", "row_key").limit(n)


def latest_per_source(events: DataFrame, k: int = 1) -> DataFrame:
    """The newest k events of each source; for k = 1 an aggregate, without a sort."""
    if k == 1:
        rest = [c for c in events.columns if c not in ("feed", "source_id")]
        return events.groupBy("feed", "source_id").agg(F.min_by(F.struct(*rest), "row_key").alias("e")).select("feed", "source_id", "e.*").select(*events.columns)
    w = Window.partitionBy("feed", "source_id").orderBy("row_key")
    return events.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n")


def all_events(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root)


def distinct_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order given."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Global 0-based position: a range sort, then the counts of earlier partitions. No window over all rows.

    A column of that name is replaced. Rows that are equal in the order take positions in any order among them.
    """
    local = "_" + name
    while local in df.columns:
        local = "_" + local
    # Partition number and place within it, checkpointed: another range sort might cut elsewhere.
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch(df.sparkSession))
    placed = df.drop(name).orderBy(*order).withColumn(local, F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright(local, 33)
    counts = placed.groupBy(part.alias("p")).agg(F.count("*").alias("n"))  # a row for each partition
    before = counts.select(F.col("p").alias("_p"), (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("_before"))
    joined = placed.join(F.broadcast(before), part == F.col("_p"))
    return joined.select(*[c for c in df.columns if c != name], (F.col("_before") + F.col(local).bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def zip_by_position(a: DataFrame, order_a: list[str], b: DataFrame, order_b: list[str]) -> DataFrame:
    """Rows of a and b at equal positions; as many as the shorter has."""
    return with_position(a, order_a).join(with_position(b, order_b), "position")


def _first_failure(df: DataFrame, order: str, predicate: Column) -> DataFrame:
    return df.agg(F.min(F.when(~F.coalesce(predicate, F.lit(False)), F.col(order))).alias("_stop"))


def take_while(df: DataFrame, order: str, predicate: Column) -> DataFrame:
    """The longest prefix in a unique order for whose rows the predicate holds; null counts as false."""
    stop = _first_failure(df, order, predicate)  # one row
    return df.join(F.broadcast(stop), F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")


def skip_while(df: DataFrame, order: str, predicate: Column) -> DataFrame:
    """What take_while leaves."""
    stop = _first_failure(df, order, predicate)  # one row
    return df.join(F.broadcast(stop), F.col(order) >= F.col("_stop")).drop("_stop")


def summarize_by(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias("sum"), F.avg(value).alias("average"), F.min(value).alias("min"), F.max(value).alias("max"))
