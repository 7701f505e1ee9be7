"""Landed snapshots: reading, choosing, landing, looking up."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.functions.keys import snapshot_path
from waymark.sources import files
from waymark.sources.registry import known_feed

#: Up to these names, by layout, nothing is extracted.
FLOORS = {"blob": "2014/12/01/000000", "file": "20141201-000000"}
_PATHS = {"blob": r"/([^/]+)/(\d{4}/\d{2}/\d{2}/\d{6})$", "file": r"/([^/]+)/(\d{8}-\d{6})\.xml$"}
_TIMES = {"blob": "yyyy/MM/dd/HHmmss", "file": "yyyyMMdd-HHmmss"}


def shape(files: DataFrame, layout: str = "blob") -> DataFrame:
    """Snapshot rows of binary files; a file whose path is no snapshot's is left out."""
    name = F.regexp_extract("path", _PATHS[layout], 2)
    rows = files.select(F.lower(F.regexp_extract("path", _PATHS[layout], 1)).alias("feed"), name.alias("snapshot_name"), F.try_to_timestamp(name, F.lit(_TIMES[layout])).alias("snapshot_ts"), "content", "length", "modificationTime")
    return rows.filter(F.col("snapshot_ts").isNotNull())


def list_snapshots(spark: SparkSession, root: str, layout: str = "blob") -> DataFrame:
    """feed, snapshot_name, snapshot_ts, length, path of a landing folder; no content is read."""
    files_ = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return shape(files_.withColumn("content", F.col("path")), layout).select("feed", "snapshot_name", "snapshot_ts", "length", F.col("content").alias("path"))


def read_snapshots(spark: SparkSession, root: str, layout: str = "blob") -> DataFrame:
    """feed, snapshot_name, snapshot_ts, content (bytes), length, modificationTime of a landing folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if layout == "file":
        files = files.option("pathGlobFilter", "????????-??????.xml")
    return shape(files.load(root), layout)


def pending_snapshots(snapshots: DataFrame, markers: DataFrame, max_per_feed: int = 10, floor: str | None = None) -> DataFrame:
    """The next snapshots of each feed, strictly after its marker (feed, last_extracted), in order of name.

    A feed without a marker starts after the floor, by default that of the layout each name is in.
    """
    own = F.when(F.col("snapshot_name").contains("/"), FLOORS["blob"]).otherwise(FLOORS["file"])
    after = F.coalesce("last_extracted", F.lit(floor) if floor else own)
    rows = snapshots.join(markers.select("feed", "last_extracted"), "feed", "left").filter(F.col("snapshot_name") > after)
    # Names alone are ranked; a payload goes through no window.
    names = rows.select("feed", "snapshot_name").distinct()
    rank = F.row_number().over(Window.partitionBy("feed").orderBy("snapshot_name"))
    chosen = names.withColumn("_rank", rank).filter(F.col("_rank") <= max_per_feed).drop("_rank")
    return snapshots.join(chosen, ["feed", "snapshot_name"], "left_semi")


def next_names(landing: str, feed: str, after: str | None, n: int, layout: str = "blob") -> list[tuple[str, str]]:
    """(name, path) of the first n snapshots of a feed strictly after a name, or after the floor, in order of name.

    Of the blob layout only the folders of days from that name on are listed, up to the one that has the n-th.
    """
    after = after or FLOORS[layout]
    known = known_feed(feed)
    found: list[tuple[str, str]] = []
    for folder in (f"{landing.rstrip('/')}/{d}" for d in files.names(landing) if d.lower() == known):
        own: list[tuple[str, str]] = []
        if layout == "file":
            own = [(x[:-4], f"{folder}/{x}") for x in files.names(folder) if re.fullmatch(r"\d{8}-\d{6}\.xml", x) and x[:-4] > after]
        else:
            for day in _days(folder, after):
                own += [(f"{day}/{x}", f"{folder}/{day}/{x}") for x in files.names(f"{folder}/{day}") if re.fullmatch(r"\d{6}", x) and f"{day}/{x}" > after]
                if len(own) >= n:
                    break
        found += own
    return sorted(found)[:n]


def _days(folder: str, after: str) -> Iterator[str]:
    """yyyy/MM/dd of the folders of days that can hold names after one, in order."""
    level = lambda at, width: [x for x in files.names(f"{folder}/{at}") if re.fullmatch(r"\d{%d}" % width, x)]
    for y in level("", 4):
        if y >= after[:4]:
            for m in level(y, 2):
                if f"{y}/{m}" >= after[:7]:
                    yield from (f"{y}/{m}/{d}" for d in level(f"{y}/{m}", 2) if f"{y}/{m}/{d}" >= after[:10])


def read_chosen(spark: SparkSession, paths: list[str], layout: str = "blob") -> DataFrame:
    """``read_snapshots`` of these files alone."""
    return shape(spark.read.format("binaryFile").load(paths), layout)


def land_snapshots(existing: DataFrame, incoming: DataFrame, markers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new snapshots, new markers). The first payload of a feed and second wins, in the batch and against existing ones.

    incoming: feed, last_modified, content, and arrival to tell what came first where seconds are equal. Feeds without a
    marker take all. A marker never goes back.
    """
    fresh = incoming.join(markers.select("feed", F.col("last_modified").alias("_marker")), "feed", "left").filter(F.col("_marker").isNull() | (F.col("last_modified") > F.col("_marker"))).drop("_marker")
    named = fresh.withColumn("snapshot_ts", F.date_trunc("second", "last_modified")).withColumn("snapshot_name", snapshot_path(F.col("snapshot_ts")))
    first = Window.partitionBy("feed", "snapshot_name").orderBy("arrival", "last_modified")
    kept = named.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    landed = kept.join(existing.select("feed", "snapshot_name"), ["feed", "snapshot_name"], "left_anti").select("feed", "snapshot_name", "snapshot_ts", "content", F.length("content").cast("bigint").alias("length"))
    moved = fresh.select("feed", "last_modified").unionByName(markers.select("feed", "last_modified")).groupBy("feed").agg(F.max("last_modified").alias("last_modified"))
    return landed, moved


def lookup_snapshot(snapshots: DataFrame, feed: str, name: str) -> DataFrame:
    return snapshots.filter((F.col("feed") == known_feed(feed)) & (F.col("snapshot_name") == name))


def feed_catalog(snapshots: DataFrame, registry: DataFrame) -> DataFrame:
    """feed, last_modified, entries of each registered feed, also of those without snapshots."""
    found = snapshots.groupBy("feed").agg(F.max("snapshot_ts").alias("last_modified"), F.sort_array(F.collect_list("snapshot_name")).alias("entries"))
    return registry.select("feed").join(found, "feed", "left").select("feed", "last_modified", F.coalesce("entries", F.array().cast("array<string>")).alias("entries"))
