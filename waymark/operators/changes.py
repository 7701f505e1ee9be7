"""Change detection: what is new or different against the snapshot just before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.keys import row_key


def pair_snapshots(snapshots: DataFrame, markers: DataFrame | None = None) -> DataFrame:
    """feed, snapshot_name, seq, previous of each snapshot; the first one's previous is the feed's marker, or ''."""
    names = snapshots.select("feed", "snapshot_name").distinct()
    w = Window.partitionBy("feed").orderBy("snapshot_name")
    paired = names.select("feed", "snapshot_name", F.row_number().over(w).alias("seq"), F.lag("snapshot_name").over(w).alias("previous"))
    if markers is None:
        return paired.withColumn("previous", F.coalesce("previous", F.lit("")))
    return paired.join(markers.select("feed", "last_extracted"), "feed", "left").select("feed", "snapshot_name", "seq", F.coalesce("previous", "last_extracted", F.lit("")).alias("previous"))


def diff_pair(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of new whose (feed, source_id) is missing from old or whose text differs there. Rows gone from new say nothing."""
    o = old.select(F.col("feed").alias("_f"), F.col("source_id").alias("_s"), F.col("xml").alias("_x"))
    return new.join(o, (F.col("feed") == F.col("_f")) & (F.col("source_id") == F.col("_s")) & F.col("xml").eqNullSafe(F.col("_x")), "left_anti")


def content_hash(xml: Column | str = "xml") -> Column:
    """What tells texts apart in change detection; null of null."""
    return F.unhex(F.sha2(xml, 256))


def _hashed(records: DataFrame) -> DataFrame:
    return records if "content_hash" in records.columns else records.withColumn("content_hash", content_hash())


def _numbered(snapshots: DataFrame, bad: DataFrame | None, on_bad: str) -> DataFrame:
    """feed, snapshot_name, seq, after_bad of the snapshots that can be read."""
    names = snapshots.select("feed", "snapshot_name").distinct()
    if bad is None:
        names = names.withColumn("_bad", F.lit(False))
    else:
        marked = bad.select("feed", "snapshot_name", F.lit(True).alias("_bad"))
        names = names.withColumn("_bad", F.lit(False)).unionByName(marked).groupBy("feed", "snapshot_name").agg(F.max("_bad").alias("_bad"))
        if on_bad == "last_good":
            names = names.filter("not _bad")
    w = Window.partitionBy("feed").orderBy("snapshot_name")
    numbered = names.select("feed", "snapshot_name", "_bad", F.row_number().over(w).alias("seq"), F.coalesce(F.lag("_bad").over(w), F.lit(False)).alias("after_bad"))
    return numbered.filter("not _bad").drop("_bad")


def change_events(records: DataFrame, snapshots: DataFrame | None = None, bad: DataFrame | None = None, on_bad_predecessor: str = "skip", method: str = "window") -> DataFrame:
    """Records that are new or changed against the snapshot just before, with seq.

    snapshots lists all snapshots, also empty ones, so that their numbers have no gaps; bad names those that can't be read.
    A snapshot after a bad one emits nothing ("skip") or is held against the last good one ("last_good"). An id that is
    away for a snapshot is emitted again when it returns.

    Records that have a content_hash are told apart by it and need no xml; see ``sources.records.fetched`` for getting the
    xml of changed ones alone. method "window" sorts each source's history: one shuffle, right for many sources. "join" pairs neighbours on
    (feed, source_id, seq), so that a few sources with a very long history spread over all tasks.
    """
    if on_bad_predecessor not in ("skip", "last_good") or method not in ("window", "join"):
        raise ValueError("on_bad_predecessor is skip or last_good; method is window or join")
    extra = [] if "content_hash" in records.columns else ["content_hash"]
    rows = _hashed(records).join(_numbered(records if snapshots is None else snapshots, bad, on_bad_predecessor), ["feed", "snapshot_name"])
    if method == "window":
        # Partitions of a given number: what follows, conversion above all, costs by the row and not by the byte.
        rows = rows.repartition(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), "feed", "source_id")
    return _changed(rows, method).drop(*extra)


def _changed(rows: DataFrame, method: str = "window") -> DataFrame:
    """Those of numbered records that are new or changed, with seq and their content_hash."""
    if method == "window":
        w = Window.partitionBy("source_id", "feed").orderBy("seq")  # of few feeds, sorting by source first compares least
        found = rows.withColumns({"_prev_seq": F.lag("seq").over(w), "_prev_hash": F.lag("content_hash").over(w)})
        changed = F.col("_prev_seq").isNull() | (F.col("_prev_seq") != F.col("seq") - 1) | ~F.col("_prev_hash").eqNullSafe(F.col("content_hash"))
        return found.filter(changed & ~F.col("after_bad")).drop("_prev_seq", "_prev_hash", "after_bad")
    before = rows.select("feed", "source_id", (F.col("seq") + 1).alias("seq"), F.col("content_hash").alias("_prev_hash"), F.lit(True).alias("_had"))
    found = rows.join(before, ["feed", "source_id", "seq"], "left")
    return found.filter((F.col("_had").isNull() | ~F.col("_prev_hash").eqNullSafe(F.col("content_hash"))) & ~F.col("after_bad")).drop("_had", "_prev_hash", "after_bad")


def as_events(changes: DataFrame, time: Column | None = None) -> DataFrame:
    """Events with row_key, event_date and length; a length that is there stays."""
    t = F.col("publication_time") if time is None else time
    length = F.col("length") if "length" in changes.columns else F.octet_length("xml").cast("bigint")
    return changes.withColumns({"row_key": row_key(t), "event_date": F.to_date(t), "length": length})


def extract_increment(records: DataFrame, carry: DataFrame, snapshots: DataFrame, bad: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events, new carry, new markers) of the next snapshots.

    carry: feed, snapshot_name, source_id, content_hash, broken: the last snapshot of each feed so far, without its texts; a
    broken or empty one is a row with null source_id. One with xml instead of hashes is taken too. snapshots names the new ones.
    Names are few for an increment and go to the records, which are shuffled once, by source, into as many partitions as
    their bytes need: dealt by snapshot, all records of one would meet in one task.
    """
    marks = carry.select("feed", "snapshot_name").distinct()
    all_names = marks.unionByName(snapshots.select("feed", "snapshot_name")).distinct()
    columns = ["feed", "snapshot_name", "source_id", "content_hash"]
    extra = [] if "content_hash" in records.columns else ["content_hash"]
    held = _hashed(carry).filter("source_id is not null").select(*columns, F.lit(True).alias("_held"))
    rows = held.unionByName(_hashed(records).withColumn("_held", F.lit(False)), allowMissingColumns=True)
    broken = carry.filter("broken").select("feed", "snapshot_name").distinct()
    every_bad = broken if bad is None else broken.unionByName(bad.select("feed", "snapshot_name")).distinct()
    events = _changed(rows.join(F.broadcast(_numbered(all_names, every_bad, "skip")), ["feed", "snapshot_name"])).filter(~F.col("_held")).drop("_held", "seq", *extra)
    last = all_names.groupBy("feed").agg(F.max("snapshot_name").alias("snapshot_name"))
    state = last.join(every_bad.withColumn("broken", F.lit(True)), ["feed", "snapshot_name"], "left").withColumn("broken", F.coalesce("broken", F.lit(False)))
    kept = rows.select(*columns).join(F.broadcast(state), ["feed", "snapshot_name"]).select(*columns, "broken")
    without = state.join(kept.select("feed", "snapshot_name").distinct(), ["feed", "snapshot_name"], "left_anti")
    new_carry = kept.unionByName(without, allowMissingColumns=True)
    return events, new_carry, last.select("feed", F.col("snapshot_name").alias("last_extracted"))


def upsert_events(events: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per (feed, source_id, row_key): of new ones the highest snapshot name, in place of an existing one."""
    key = ["feed", "source_id", "row_key"]
    w = Window.partitionBy("source_id", "feed", "row_key").orderBy(F.desc("snapshot_name"))
    new = events.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return new if existing is None else existing.join(new.select(*key), key, "left_anti").unionByName(new)


def source_ids(events: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    ids = events.select("feed", "source_id")
    return (ids if existing is None else ids.unionByName(existing.select("feed", "source_id"))).distinct()
