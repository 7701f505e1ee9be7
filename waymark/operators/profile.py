"""Volumes of snapshots and events. Sizes in whole KB and MB, rounded down."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def snapshot_volume(snapshots: DataFrame, by: str = "day") -> DataFrame:
    """Per feed and period: snapshots, bytes, kb, mb, last_modified. The column of the period's start is named by it.

    A second holds one snapshot of a feed at most, so by "second" gives the size of each payload.
    """
    if by not in ("second", "minute", "hour", "day", "week", "month", "quarter", "year"):
        raise ValueError(f"no period: {by}")
    start = F.date_trunc(by, "snapshot_ts")
    start = start if by in ("second", "minute", "hour") else start.cast("date")
    total = snapshots.groupBy("feed", start.alias(by)).agg(F.count("*").alias("snapshots"), F.sum("length").alias("bytes"), F.max("snapshot_ts").alias("last_modified"))
    return total.withColumns({"kb": F.expr("bytes div 1024"), "mb": F.expr("bytes div 1048576")})


def event_volume(events: DataFrame) -> DataFrame:
    """Events and bytes per source, and per feed (source_id null) with its number of sources."""
    per = events.groupBy("feed", "source_id").agg(F.count("*").alias("events"), F.sum("length").alias("bytes"))
    feed = per.groupBy("feed").agg(F.sum("events").alias("events"), F.sum("bytes").alias("bytes"), F.count("*").alias("sources"))
    return per.withColumn("sources", F.lit(1).cast("bigint")).unionByName(feed.withColumn("source_id", F.lit(None).cast("string")))


def _per_source(events: DataFrame) -> DataFrame:
    return events.groupBy("feed", "source_id").agg(F.count("*").alias("n"), F.min_by("length", "row_key").alias("first_length"))


def estimate_volume(events: DataFrame, skip: int = 50, sample: int = 50) -> DataFrame:
    """Per feed: sources, est_events, est_bytes, mean_bytes from the sources skip + 1 .. skip + sample in order of name.

    Scaled in whole numbers by the sample's nominal size; the mean divides the scaled figures and is null where no event is estimated.
    """
    per = _per_source(events)
    ranked = per.withColumn("r", F.row_number().over(Window.partitionBy("feed").orderBy("source_id")))
    chosen = (F.col("r") > skip) & (F.col("r") <= skip + sample)
    total = ranked.groupBy("feed").agg(F.count("*").alias("sources"), F.sum(F.when(chosen, F.col("n"))).alias("n"), F.sum(F.when(chosen, F.col("n") * F.col("first_length"))).alias("size"))
    scaled = total.select("feed", "sources", F.expr(f"(coalesce(n, 0) div {int(sample)}) * sources").alias("est_events"), F.expr(f"coalesce(size, 0) * (sources div {int(sample)})").alias("est_bytes"))
    return scaled.withColumn("mean_bytes", F.expr("case when est_events > 0 then est_bytes div est_events end"))


def day_volume(events: DataFrame, date: str, feeds: DataFrame | None = None) -> DataFrame:
    """Per feed: sources, events and bytes (count times a source's newest size) of a day, and mean_kb.

    Only the day is read, so a feed without an event on it has a row, of zeros and a null mean, only where feeds lists it.
    """
    day = events.filter(F.col("event_date") == F.lit(date).cast("date"))
    total = _per_source(day).groupBy("feed").agg(F.count("*").alias("sources"), F.sum("n").alias("events"), F.sum(F.col("n") * F.col("first_length")).alias("bytes"))
    if feeds is not None:
        total = feeds.select("feed").distinct().join(total, "feed", "full").na.fill(0, ["sources", "events", "bytes"])
    return total.withColumn("mean_kb", F.expr("case when events > 0 then bytes div events div 1024 end"))


def group_sources(events: DataFrame) -> DataFrame:
    return events.groupBy("source_id").agg(F.count("*").alias("events"), F.countDistinct("feed").alias("feeds"))
