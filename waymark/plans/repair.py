"""Mending a change log after snapshots that landed behind the marker, or that were bad and have been replaced.

A snapshot's events depend on it and on the one just before, so a late one touches its own and those of the one just after.
These few are computed anew; what the log had and they haven't is withdrawn, what is new or different is added, in one
commit. The log then reads as if all snapshots had been there from the start.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.operators import changes
from waymark.operators.store import Store
from waymark.plans.jobs import feed_store, taken
from waymark.sources.records import explode_records, fetched, located, split_valid
from waymark.sources.registry import known_feed, with_elements
from waymark.sources.snapshots import next_names, read_chosen

_NAMED = "feed string, snapshot_name string"


@dataclass(frozen=True)
class Repaired:
    """Snapshots that were late or mended, and how many events were added (or replaced) and withdrawn."""

    snapshots: int
    added: int
    withdrawn: int


def late_names(spark: SparkSession, landing: str, store: Store, feed: str, layout: str = "blob", since: str | None = None) -> list[tuple[str, str]]:
    """(name, path) of snapshots that lie behind the marker but were never taken; since is a name to begin the listing after."""
    marker = store.state()["values"].get("last_extracted")
    if marker is None:
        return []
    listed = [x for x in next_names(landing, feed, since, 1 << 40, layout) if x[0] <= marker]
    known = store.read("snapshots").select("snapshot_name")
    found = spark.createDataFrame(listed, "snapshot_name string, path string").join(known, "snapshot_name", "left_anti") if listed else None
    return sorted((r.snapshot_name, r.path) for r in found.collect()) if found else []


def _neighbours(names: DataFrame, touched: DataFrame) -> DataFrame:
    """feed, snapshot_name, previous of touched snapshots and of those just after one."""
    w = Window.partitionBy("feed").orderBy("snapshot_name")
    flagged = names.join(touched.withColumn("_touched", F.lit(True)), ["feed", "snapshot_name"], "left")
    paired = flagged.withColumns({"previous": F.lag("snapshot_name").over(w), "_after": F.lag("_touched").over(w)})
    return paired.filter("_touched or _after").select("feed", "snapshot_name", "previous")


def repair_feed(spark: SparkSession, landing: str, root: str, feed: str, layout: str = "blob", mended: tuple[str, ...] = (), since: str | None = None) -> Repaired:
    """Bring a feed's log to what a run over all snapshots from the start would give.

    mended names snapshots whose files have been replaced since they were taken. Only these, the late ones, their neighbours,
    and snapshots of the same publication times are read again. Nothing late: nothing is done. A stop before the commit
    leaves the log as it was.
    """
    known = known_feed(feed)
    store = feed_store(spark, root, feed)
    late = late_names(spark, landing, store, feed, layout, since)
    touched = [(known, n) for n, _ in late] + [(known, n) for n in mended]
    if not touched:
        return Repaired(0, 0, 0)
    change = store.change()
    before = store.read("snapshots", state=change.state)
    names = before.select("feed", "snapshot_name").unionByName(spark.createDataFrame(touched, _NAMED)).distinct()
    pairs = change.stored(_neighbours(names, spark.createDataFrame(touched, _NAMED).distinct()))
    events, bad, good = _again(spark, landing, feed, layout, pairs, change)
    # Events of one source and time replace each other, so other snapshots of these times have their say again.
    times = good.join(pairs.select("snapshot_name"), "snapshot_name", "left_semi").select("publication_time").distinct()
    same = before.join(times, "publication_time", "left_semi").join(pairs.select("snapshot_name"), "snapshot_name", "left_anti").select("feed", "snapshot_name")
    same = change.stored(same)
    if not same.isEmpty():
        touched_all = spark.createDataFrame(touched, _NAMED).unionByName(same).distinct()
        w = Window.partitionBy("feed").orderBy("snapshot_name")
        every = names.withColumn("previous", F.lag("snapshot_name").over(w))
        pairs = change.stored(pairs.unionByName(every.join(touched_all, ["feed", "snapshot_name"], "left_semi")).distinct())
        events, bad, good = _again(spark, landing, feed, layout, pairs, change)

    events = change.stored(fetched(changes.upsert_events(changes.as_events(events)))).withColumn("withdrawn", F.lit(False))
    days = good.join(pairs.select("snapshot_name"), "snapshot_name", "left_semi").select(F.to_date("publication_time").cast("string").alias("d")).agg(F.min("d").alias("a"), F.max("d").alias("b")).first()
    held = store.read("events", days.a, days.b, change.state).filter("not withdrawn") if days.a else store.read("events", "~", "~", change.state)
    held = held.join(pairs.select("feed", "snapshot_name"), ["feed", "snapshot_name"], "left_semi")
    key = ["feed", "source_id", "row_key"]
    hashed = lambda df: df.withColumn("_hash", changes.content_hash())
    added = change.stored(hashed(events).join(hashed(held).select(*key, "snapshot_name", "_hash"), [*key, "snapshot_name", "_hash"], "left_anti").drop("_hash"))
    gone = change.stored(held.join(events.select(*key), key, "left_anti").withColumns({"withdrawn": F.lit(True), "xml": F.lit(None).cast("string")}))
    change.append("events", added.unionByName(gone))
    change.append("source_ids", changes.source_ids(added))
    own = spark.createDataFrame(touched, _NAMED).distinct()
    change.append("snapshots", taken(own, good))
    change.append("rejected", own.join(bad, ["feed", "snapshot_name"], "left").select("feed", "snapshot_name", "error"))
    marker = change.values["last_extracted"]
    if (known, marker) in touched:
        broken = not bad.filter(F.col("snapshot_name") == marker).isEmpty()
        last = spark.createDataFrame([(known, marker, broken)], f"{_NAMED}, broken boolean")
        change.replace("carry", last.join(good.select("feed", "snapshot_name", "source_id", "content_hash"), ["feed", "snapshot_name"], "left"))
    change.commit()
    return Repaired(len(set(touched)), added.count(), gone.count())


def _again(spark: SparkSession, landing: str, feed: str, layout: str, pairs: DataFrame, change) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(changed records of the pairs' snapshots, bad snapshots, good records) from the files of those and the ones before."""
    wanted = sorted({n for r in pairs.collect() for n in (r.snapshot_name, r.previous) if n})
    paths = [_path(landing, feed, name, layout) for name in wanted]
    good, bad = split_valid(located(explode_records(with_elements(read_chosen(spark, paths, layout)), first_only=True), change.scratch()))
    bad = change.stored(bad)
    # A snapshot with a bad one before it has no events, as in the first run.
    sound = pairs.join(bad.select(F.col("snapshot_name").alias("previous")), "previous", "left_anti")
    old = good.join(sound.select("feed", F.col("snapshot_name").alias("_next"), F.col("previous").alias("snapshot_name")), ["feed", "snapshot_name"]).select("feed", F.col("_next").alias("snapshot_name"), "source_id", "content_hash")
    new = good.join(sound.select("feed", "snapshot_name"), ["feed", "snapshot_name"], "left_semi")
    return new.join(old, ["feed", "snapshot_name", "source_id", "content_hash"], "left_anti"), bad, good


def _path(landing: str, feed: str, name: str, layout: str) -> str:
    """The file of a name, found as the job finds it."""
    day = name[:-1] + chr(ord(name[-1]) - 1)  # just before it in order
    return next(path for n, path in next_names(landing, feed, day, 2, layout) if n == name)
