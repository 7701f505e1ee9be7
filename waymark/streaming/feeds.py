"""The same work on streams: landing, change detection, documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymark.operators import changes, convert, sinks
from waymark.operators.store import Keyed, Store
from waymark.sources import files
from waymark.sources.records import explode_records, fetched, located, split_valid
from waymark.sources.snapshots import land_snapshots, shape

BINARY_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def stream_snapshots(spark: SparkSession, root: str, layout: str = "blob", max_files: int = 50) -> DataFrame:
    """Snapshots of a landing folder as files arrive; markers and other files are left out."""
    files = spark.readStream.format("binaryFile").schema(BINARY_FILES).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files)
    return shape(files.load(root), layout)


def _store(spark: SparkSession, root: str, batch: int, tables: dict[str, DataFrame]) -> None:
    """Tables of a batch under its number: a repeated batch writes the same folder again."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")


def _last_state(spark: SparkSession, root: str, batch: int) -> DataFrame | None:
    """Carry table of the newest batch before this one."""
    folders = [n for n in files.names(f"{root}/carry") if n.startswith("batch=") and files.exists(f"{root}/carry/{n}/_SUCCESS")]
    before = [int(n[6:]) for n in folders if int(n[6:]) < batch]
    return spark.read.parquet(f"{root}/carry/batch={max(before)}") if before else None


def change_batch(root: str, to_records: Callable[[DataFrame], DataFrame] = lambda b: explode_records(b, first_only=True)) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: the change detection of a batch against the last snapshot of each feed.

    to_records gives the records of a batch of snapshots as ``explode_records`` does; they are written once and read from
    there. Under root go events (with row_key and event_date), late (snapshots at or before the feed's last one, which are
    never extracted) and carry, each by number of batch, so that a replay changes nothing. Of carry the last two batches stay.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            records, bad = split_valid(located(to_records(batch), f"{root}/parsed/batch={number}"))
            names = batch.select("feed", "snapshot_name").distinct()
            state = _last_state(spark, root, number)
            if state is None:
                state = spark.createDataFrame([], "feed string, snapshot_name string, source_id string, content_hash binary, broken boolean")
            last = state.groupBy("feed").agg(F.max("snapshot_name").alias("last"))
            fresh = lambda df: df.join(last, "feed", "left").filter("last is null or snapshot_name > last").drop("last")
            events, carry, _ = changes.extract_increment(fresh(records), state, fresh(names), fresh(bad))
            late = names.join(last, "feed").filter("snapshot_name <= last").select("feed", "snapshot_name")
            _store(spark, root, number, {"events": fetched(changes.as_events(events)), "late": late, "carry": carry})
            files.remove(f"{root}/parsed/batch={number}")
            if number > 1:
                files.remove(f"{root}/carry/batch={number - 2}")
        finally:
            batch.unpersist()

    return run


def stream_changes(source: DataFrame, root: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Change detection on a stream of snapshots with their elements; once drains what is there, else it polls each minute."""
    writer = source.writeStream.foreachBatch(change_batch(root)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="60 seconds")).start()


def stream_land(incoming: DataFrame, root: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Landing of a stream of (feed, last_modified, content, arrival): of each feed and second the first payload, as in batch.

    Under root go snapshots, partitioned by number of batch; a replayed batch is held against the other ones and writes the
    same folder again. Only names of earlier batches are read, not their payloads.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        schema = "feed string, snapshot_name string, snapshot_ts timestamp, content binary, length bigint, batch int"
        before = spark.read.schema(schema).parquet(f"{root}/snapshots").filter(F.col("batch") < number) if files.exists(f"{root}/snapshots") else spark.createDataFrame([], schema)
        landed, _ = land_snapshots(before, batch, spark.createDataFrame([], "feed string, last_modified timestamp"))
        _store(spark, root, number, {"snapshots": landed})

    writer = incoming.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="60 seconds")).start()


#: Tables of a document store. An id holds the second of its event, so versions of a document share its day.
DOCUMENTS = {
    "documents": Keyed("feed string, doc_id string, source_id string, record_index int, event_time timestamp, publication_time timestamp, row_key string, json string", ("feed", "doc_id"), ("row_key",), "left(substring_index(doc_id, '_', -1), 10)"),
    "geometries": Keyed("feed string, doc_id string, source_id string, event_time timestamp, row_key string, geometry string", ("feed", "doc_id"), ("row_key",), "left(substring_index(doc_id, '_', -1), 10)"),
    "rejects": Keyed("feed string, source_id string, event_time timestamp, row_key string, error string", ("feed", "source_id", "event_time", "row_key"), (), "to_date(event_time)"),
}


def document_store(spark: SparkSession, root: str) -> Store:
    return Store(spark, root, DOCUMENTS)


def index_batch(root: str, stream: str, tz: str = "UTC", compact_after: int = 10) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: events of a batch, converted once, upserted into a document store by one commit.

    The commit notes the stream's batch, so that a replayed batch does nothing. Batches are deltas; of a document the version
    with the newest row key wins whenever it comes, and of equal keys that of the latest batch. After so many deltas the days
    that they touched are compacted. Several streams may take turns on one store.
    """

    def run(batch: DataFrame, number: int) -> None:
        store = document_store(batch.sparkSession, root)
        change = store.change()
        done = change.values.setdefault("streams", {})
        if done.get(stream, -1) >= number:
            return
        rows = change.stored(convert.converted(batch, tz))
        # One version of each document, so that its geometry is of the same one.
        best = change.stored(sinks.keep_last(rows.filter("error is null")))
        change.append("documents", convert.parts(best)[0])
        # A version without geometry must win over an older one that has one, so it is kept as null.
        change.append("geometries", best.filter(F.col("feed").isin(list(convert.GEOMETRY_FEEDS))))
        change.append("rejects", rows.filter("error is not null"))
        for name in DOCUMENTS:
            if len(change.state["tables"].get(name, {"deltas": []})["deltas"]) >= compact_after:
                change.compact(name)
        done[stream] = number
        change.commit()
        store.clean()

    return run


def stream_documents(events: DataFrame, root: str, checkpoint: str, once: bool = True, tz: str = "UTC", compact_after: int = 10) -> StreamingQuery:
    """Documents, geometries and rejects of a stream of events, in a document store; see ``index_batch``."""
    writer = events.writeStream.foreachBatch(index_batch(root, checkpoint, tz, compact_after)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="60 seconds")).start()


def read_documents(spark: SparkSession, root: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """The newest version of each document of the days since .. until; folders of other days aren't read."""
    return document_store(spark, root).read("documents", since, until)


def read_geometries(spark: SparkSession, root: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Geometries of the newest versions of documents."""
    return document_store(spark, root).read("geometries", since, until).filter("geometry is not null")


def read_rejects(spark: SparkSession, root: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Events that can't be converted, once each."""
    return document_store(spark, root).read("rejects", since, until)
