"""A stream source of snapshots that goes by name.

Its offset is, for each feed, the last name taken, its number in the feed, and the files of the batch that ended with it. A
batch has the next names of each feed, in order, at most so many; when files arrive doesn't matter, only what they are
called. A file whose name is at or below its feed's offset is late and never comes out. A replayed batch has the same files
and numbers, whatever arrived meanwhile, as its offset lists them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from waymark.sources import files
from waymark.sources.registry import DEFAULT_FEEDS, known_feed
from waymark.sources.snapshots import FLOORS, next_names

SCHEMA = "feed string, snapshot_name string, snapshot_ts timestamp, seq bigint, content binary, length bigint"
_TIMES = {"blob": "%Y/%m/%d/%H%M%S", "file": "%Y%m%d-%H%M%S"}


@dataclass
class OneFile(InputPartition):
    feed: str
    name: str
    seq: int
    path: str


def newest_offset(checkpoint: str) -> dict | None:
    """The end of the last batch that a query planned, from its checkpoint; None before its first.

    Spark does an unfinished batch again before it asks for the next one, so this is where the next one starts in any case.
    """
    batches = [int(n) for n in files.names(f"{checkpoint.rstrip('/')}/offsets") if n.isdigit()]
    if not batches:
        return None
    return json.loads(files.read(f"{checkpoint.rstrip('/')}/offsets/{max(batches)}").decode().splitlines()[2])


class SnapshotReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.landing, self.layout, self.n = options["path"].rstrip("/"), options.get("layout", "blob"), int(options.get("perFeed", "10"))
        self.feeds = [known_feed(f) for f in options.get("feeds", ",".join(DEFAULT_FEEDS)).split(",")]
        self.planned = newest_offset(options["checkpoint"]) if options.get("checkpoint") else None

    def initialOffset(self) -> dict:
        return {f: {"name": FLOORS[self.layout], "seq": 0, "files": ""} for f in self.feeds}

    def latestOffset(self) -> dict:
        """The next names after the batch that was planned last; the same until that one is."""
        at = {**self.initialOffset(), **(self.planned or {})}
        for feed in self.feeds:
            if found := next_names(self.landing, feed, at[feed]["name"], self.n, self.layout):
                at[feed] = {"name": found[-1][0], "seq": at[feed]["seq"] + len(found), "files": ",".join(path.removeprefix(f"{self.landing}/") for _, path in found)}
        return at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """A task for each snapshot."""
        self.planned = end
        out: list[InputPartition] = []
        for feed, last in end.items():
            if last["seq"] > start.get(feed, {"seq": 0})["seq"]:
                paths = last["files"].split(",")
                out += [OneFile(feed, p.partition("/")[2].removesuffix(".xml"), last["seq"] - len(paths) + k + 1, f"{self.landing}/{p}") for k, p in enumerate(paths)]
        return out

    def read(self, partition: OneFile) -> Iterator[tuple]:
        try:
            time = datetime.strptime(partition.name, _TIMES[self.layout]).replace(tzinfo=UTC)
        except ValueError:
            time = None
        content = files.read(partition.path)
        yield partition.feed, partition.name, time, partition.seq, content, len(content)


class SnapshotSource(DataSource):
    """Options: path (the landing folder), layout, feeds (by comma), perFeed, checkpoint (that of the query)."""

    @classmethod
    def name(cls) -> str:
        return "feed_snapshots"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return SnapshotReader(self.options)


def stream_by_name(spark: SparkSession, landing: str, checkpoint: str, per_feed: int = 10, layout: str = "blob", feeds: tuple[str, ...] = DEFAULT_FEEDS) -> DataFrame:
    """Snapshots of a landing folder in order of name, at most per_feed of each feed in a batch.

    checkpoint is the folder of the query that reads it; one query to one stream. A run with availableNow takes one batch.
    """
    spark.dataSource.register(SnapshotSource)
    stream = spark.readStream.format("feed_snapshots").options(path=landing, layout=layout, perFeed=per_feed, feeds=",".join(feeds), checkpoint=checkpoint).load()
    return stream.filter("snapshot_ts is not null")
