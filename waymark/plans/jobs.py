"""The workloads as single calls."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators import changes, convert, sinks
from waymark.operators.store import Keyed, Store
from waymark.sources import files
from waymark.sources.ranges import RANGE, explode_ranges
from waymark.sources.records import dedupe_records, explode_records, fetched, located, split_valid
from waymark.sources.registry import DEFAULT_FEEDS, known_feed, with_elements
from waymark.sources.shared import scratch
from waymark.sources.snapshots import list_snapshots, next_names, read_chosen, read_snapshots

_CARRY = "feed string, snapshot_name string, source_id string, content_hash binary, broken boolean"
#: Tables of a feed's change log. An event's day is that of its row key; of one key the row of the latest commit counts, which
#: is that of the latest snapshot, or a repair's. Withdrawn events, and errors that are null since a snapshot was mended, don't.
TABLES = {
    "events": Keyed("feed string, source_id string, snapshot_name string, publication_time timestamp, ordinal int, xml string, row_key string, event_date date, length bigint, withdrawn boolean", ("feed", "source_id", "row_key"), (), "event_date"),
    "source_ids": Keyed("feed string, source_id string", ("feed", "source_id")),
    "snapshots": Keyed("feed string, snapshot_name string, publication_time timestamp", ("feed", "snapshot_name")),
    "rejected": Keyed("feed string, snapshot_name string, error string", ("feed", "snapshot_name")),
    "carry": Keyed(_CARRY, ("feed", "snapshot_name", "source_id")),
}
_LIVE = {"events": "not withdrawn", "rejected": "error is not null"}


def snapshots_to_events(snapshots: DataFrame, on_bad_predecessor: str = "skip", method: str = "window") -> tuple[DataFrame, DataFrame]:
    """(events, rejected snapshots) of a history of snapshots with their elements.

    Each snapshot is parsed once. Change detection moves hashes and places; the xml of changed records alone is read again.
    """
    return records_to_events(explode_records(snapshots, first_only=True), snapshots, on_bad_predecessor, method)


def records_to_events(records: DataFrame, snapshots: DataFrame, on_bad_predecessor: str = "skip", method: str = "window") -> tuple[DataFrame, DataFrame]:
    """The same of records, and rejects, of snapshots that are listed."""
    good, bad = split_valid(located(records, scratch(records.sparkSession)))
    found = changes.change_events(good, snapshots, bad, on_bad_predecessor, method)
    return fetched(changes.upsert_events(changes.as_events(found))), bad


def landed_records(spark: SparkSession, landing: str, layout: str = "blob", whole: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """(first records of each id, listed snapshots) of known feeds. Files of more bytes than whole are cut into ranges."""
    listed = with_elements(list_snapshots(spark, landing, layout)).filter("record_element is not null")
    small = with_elements(read_snapshots(spark, landing, layout).filter(F.col("length") <= whole)).filter("record_element is not null")
    found = explode_records(small, first_only=True)
    large = listed.filter(F.col("length") > whole)
    if not large.isEmpty():
        found = found.unionByName(dedupe_records(explode_ranges(large, range_bytes=whole)))
    return found, listed


def build_history(spark: SparkSession, landing: str, root: str, layout: str = "blob", tz: str = "UTC", whole: int = RANGE) -> None:
    """Landing folder to stores of events, documents, geometries and source ids."""
    events, bad = records_to_events(*landed_records(spark, landing, layout, whole))
    sinks.write_events(events, f"{root}/events", "overwrite")
    bad.write.mode("overwrite").parquet(f"{root}/rejected")
    stored = spark.read.parquet(f"{root}/events")
    changes.source_ids(stored).write.mode("overwrite").parquet(f"{root}/source_ids")
    convert.converted(stored, tz).write.mode("overwrite").parquet(f"{root}/converted")
    docs, shapes, rejects = convert.parts(spark.read.parquet(f"{root}/converted"))
    sinks.write_documents(sinks.keep_last(docs), f"{root}/documents", "overwrite")
    sinks.write_geometries(shapes, f"{root}/geometries", "overwrite")
    rejects.write.mode("overwrite").parquet(f"{root}/unconverted")


def feed_store(spark: SparkSession, root: str, feed: str) -> Store:
    """The change log of one feed: events, source ids, rejected snapshots, the last snapshot, and the marker."""
    return Store(spark, f"{root.rstrip('/')}/{known_feed(feed)}", TABLES)


@dataclass(frozen=True)
class Extracted:
    """What a run did for one feed: how many snapshots, up to which name, or the error that stopped it."""

    feed: str
    snapshots: int
    last: str | None
    error: Exception | None = None


def extract_feed(spark: SparkSession, landing: str, root: str, feed: str, n: int = 10, layout: str = "blob", compact_after: int = 20) -> Extracted:
    """The next n snapshots of a feed, in order of name, into its change log, by one commit.

    The snapshot before the first of them was carried over by the last run. A snapshot that can't be read is noted and
    passed, as is the pair after it. Where a run stops before its commit the marker stays, and the next run does the same
    work; after it, nothing is done twice. Of one source and time the event of the later snapshot stays. Snapshots that land
    behind the marker are left to ``repair.repair_feed``.
    """
    store = feed_store(spark, root, feed)
    change = store.change()
    chosen = next_names(landing, feed, change.values.get("last_extracted"), n, layout)
    if not chosen:
        return Extracted(known_feed(feed), 0, change.values.get("last_extracted"))
    snaps = with_elements(read_chosen(spark, [path for _, path in chosen], layout))
    folder = change.scratch()
    found = located(explode_records(snaps, first_only=True), folder)
    # A row for each snapshot, so that what is asked of snapshots doesn't read all their records again.
    seen = change.stored(found.groupBy("feed", "snapshot_name", "error").agg(F.min("publication_time").alias("publication_time")))
    times, bad = split_valid(seen)
    names = spark.createDataFrame(pa.table({"feed": [known_feed(feed)] * len(chosen), "snapshot_name": [name for name, _ in chosen]}))  # no Python task
    events, carry, _ = changes.extract_increment(split_valid(found)[0], store.read("carry", state=change.state), names, bad)
    events = change.stored(fetched(changes.upsert_events(changes.as_events(events)), sum(n.endswith(".parquet") for n in files.names(folder))))
    change.append("events", events.withColumn("withdrawn", F.lit(False)))
    change.append("source_ids", changes.source_ids(events))
    change.append("snapshots", taken(names, times))
    change.append("rejected", bad)
    change.replace("carry", carry)
    for table in ("events", "source_ids", "snapshots", "rejected"):
        if len(change.state["tables"].get(table, {"deltas": []})["deltas"]) >= compact_after:
            change.compact(table)
    change.values["last_extracted"] = chosen[-1][0]
    change.commit()
    store.clean()
    return Extracted(known_feed(feed), len(chosen), chosen[-1][0])


def taken(names: DataFrame, good: DataFrame) -> DataFrame:
    """feed, snapshot_name and publication_time of snapshots; null of those that are empty or can't be read."""
    times = good.groupBy("feed", "snapshot_name").agg(F.min("publication_time").alias("publication_time"))
    return names.join(times, ["feed", "snapshot_name"], "left")


def extract_next(spark: SparkSession, landing: str, root: str, n: int = 10, feeds: tuple[str, ...] = DEFAULT_FEEDS, layout: str = "blob", compact_after: int = 20) -> list[Extracted]:
    """One run of the incremental extract job: ``extract_feed`` of all feeds, side by side. One that fails leaves the others alone."""

    def one(feed: str) -> Extracted:
        try:
            return extract_feed(spark, landing, root, feed, n, layout, compact_after)
        except Exception as e:  # the error is the caller's to judge; the feed's marker hasn't moved
            return Extracted(feed, 0, None, e)

    with ThreadPoolExecutor(len(feeds)) as pool:  # a run of a feed is many small jobs, and feeds share nothing
        return list(pool.map(inheritable_thread_target(spark)(one), feeds))


def clear_marker(spark: SparkSession, root: str, feed: str) -> None:
    """Let the next run start at the floor again. Events and ids stay; those that come again replace themselves."""
    change = feed_store(spark, root, feed).change()
    change.values.pop("last_extracted", None)
    change.state["tables"].pop("carry", None)
    change.commit()


def read_log(spark: SparkSession, root: str, table: str = "events", feeds: tuple[str, ...] = DEFAULT_FEEDS, since: str | None = None, until: str | None = None) -> DataFrame:
    """A table of the change logs of some feeds, each as its newest commit has it; since and until are days."""
    logs = [feed_store(spark, root, f).read(table, since, until) for f in feeds]
    rows = logs[0]
    for more in logs[1:]:
        rows = rows.unionByName(more)
    return rows.filter(_LIVE.get(table, "true")).drop("withdrawn")


def markers(spark: SparkSession, root: str, feeds: tuple[str, ...] = DEFAULT_FEEDS) -> DataFrame:
    """feed, last_extracted of the feeds that have a marker."""
    found = [(f, feed_store(spark, root, f).state()["values"].get("last_extracted")) for f in map(known_feed, feeds)]
    return spark.createDataFrame([x for x in found if x[1]], "feed string, last_extracted string")
