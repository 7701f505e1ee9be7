"""Event stores laid out by source, for scans of some sources and joins on the source.

Rows are hashed into buckets by ``source_key``, sorted in each by source and time, one file a bucket, with Parquet bloom
filters on the key. A scan of some sources opens their buckets only and skips row groups by filter and order; two stores
with as many buckets join without a shuffle. Stores by day (``operators.sinks``, ``operators.store``) serve scans by time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.operators.select import events_in_range
from waymark.sources.registry import known_feed

KEY = "source_key"
#: Keys given as a list go into the scan's filter; Spark prunes buckets by it.
_LISTED = 1000


def source_key(feed: Column | str = "feed", source_id: Column | str = "source_id") -> Column:
    """One column for a feed's source; the feed comes first and has no slash."""
    return F.concat_ws("/", F.lower(feed), source_id)


def write_by_source(events: DataFrame, table: str, path: str, buckets: int, distinct: int = 1_000_000) -> DataFrame:
    """A table of events by source at a path, with source_key; distinct is how many sources the bloom filters expect.

    Give it so many buckets that one is a few hundred MB; each is one file, whatever wrote the events.
    """
    order = [c for c in ("row_key", "doc_id") if c in events.columns]
    rows = events.withColumn(KEY, source_key()).repartition(buckets, KEY).sortWithinPartitions(KEY, *order)
    writer = rows.write.format("parquet").option("path", path).option(f"parquet.bloom.filter.enabled#{KEY}", "true").option(f"parquet.bloom.filter.expected.ndv#{KEY}", str(distinct))
    writer.bucketBy(buckets, KEY).sortBy(KEY, *order).mode("errorifexists").saveAsTable(table)
    return events.sparkSession.table(table)


def compact_by_source(store: DataFrame, more: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """A new table of a store and of later events in the same form: one file a bucket again. The store stays for its readers."""
    return write_by_source(store.drop(KEY).unionByName(more.select(*store.drop(KEY).columns)), table, path, buckets)


def scan_by_source(store: DataFrame, ids: DataFrame, feed: str, from_date: str | None = None, to_date: str | None = None) -> DataFrame:
    """Events of a feed's sources in ids(feed, source_id), and in a range of days as in ``events_in_range``.

    Up to 1,000 sources are named in the filter, and only their buckets are opened; beyond that ids are joined on the key.
    """
    keys = ids.filter(F.lower("feed") == known_feed(feed)).select(source_key().alias(KEY)).distinct()
    some = [r[KEY] for r in keys.limit(_LISTED + 1).collect()]
    found = store.filter(F.col(KEY).isin(some)) if len(some) <= _LISTED else store.join(keys, KEY, "left_semi")
    return found if from_date is None else events_in_range(found, from_date, to_date or from_date)


def join_by_source(left: DataFrame, right: DataFrame, on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of rows of two stores with the same source, and equal in some more columns; nulls are equal there.

    Nothing is shuffled or sorted if both have as many buckets. Buckets are by the key alone, so the other columns are
    conditions within them. Of columns with the same name left's stay.
    """
    own = right.select(F.col(KEY).alias("_key"), *[F.col(c).alias(f"_{c}") for c in on], *[c for c in right.columns if c not in left.columns])
    condition = F.col(KEY) == F.col("_key")
    for c in on:
        a, b = F.col(c), F.col(f"_{c}")
        # Not written as an equality: Spark would then want both sides dealt by this column as well.
        condition &= F.coalesce((a >= b) & (a <= b), a.isNull() & b.isNull())
    return left.hint("shuffle_hash").join(own, condition).drop("_key", *[f"_{c}" for c in on])


def fresh_name(prefix: str = "by_source") -> str:
    """A name for a table that no other has."""
    return f"{prefix}_{uuid.uuid4().hex}"
