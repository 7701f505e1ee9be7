"""Inputs of the queries, derived in Spark from the given tables: records, snapshots, situations, places."""

from __future__ import annotations

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.changes import as_events, change_events, upsert_events
from waymark.sources.records import dedupe_records
from waymark.sources.registry import DEFAULT_FEEDS, FEEDS
from waymark.sources.shared import scratch

WEATHER = ("siteMeasurements", "measurementSiteReference")
#: Types of the events table, and the feeds that stand for them.
TYPES = dict(zip(("click", "error", "purchase", "signup", "view"), sorted(DEFAULT_FEEDS), strict=True))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by keys in as many partitions as are set: what is made from the groups costs more than their bytes tell."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per event: feed = type, snapshot = day, source = user, content = value in twenties."""
    e = table(spark, sf_dir, "events").withColumn("t", F.date_trunc("day", F.col("ts").cast("timestamp")))
    return e.select(F.col("event_type").alias("feed"), F.date_format("t", "yyyy/MM/dd/HHmmss").alias("snapshot_name"), F.col("t").alias("publication_time"), F.col("event_id").alias("ordinal"), F.col("user_id").cast("string").alias("source_id"), F.floor(F.col("value") / 20).cast("bigint").cast("string").alias("xml"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_records(raw_records(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log of the records."""
    return upsert_events(as_events(change_events(records(spark, sf_dir)))).drop("seq")


def bad_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh day of the month."""
    return raw_records(spark, sf_dir).filter(F.dayofmonth("publication_time") % 7 == 0).select("feed", "snapshot_name").distinct()


def snapshots(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """XML snapshots of the records in the weather feed's form; every seventh day is cut short if asked for."""
    r = raw_records(spark, sf_dir)
    xml = F.concat(F.lit('<siteMeasurements><measurementSiteReference id="'), "source_id", F.lit('" version="1"/><v>'), "xml", F.lit("</v></siteMeasurements>"))
    body = dealt(r, "feed", "snapshot_name").groupBy("feed", "snapshot_name", "publication_time").agg(F.concat_ws("", F.sort_array(F.collect_list(F.struct("ordinal", xml.alias("x")))).getField("x")).alias("body"))
    whole = F.concat(F.lit("<d2LogicalModel><payloadPublication><publicationTime>"), F.date_format("publication_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</publicationTime>"), "body", F.lit("</payloadPublication></d2LogicalModel>"))
    if broken:
        whole = F.when(F.dayofmonth("publication_time") % 7 == 0, F.concat(whole, F.lit("<"))).otherwise(whole)
    return body.select("feed", "snapshot_name", F.col("publication_time").alias("snapshot_ts"), whole.cast("binary").alias("content"), F.octet_length(whole).cast("bigint").alias("length"), F.lit(WEATHER[0]).alias("record_element"), F.lit(WEATHER[1]).alias("id_element"))


def landed(spark: SparkSession, sf_dir: str, layout: str) -> str:
    """The snapshots as files of a landing folder."""
    return land(snapshots(spark, sf_dir).select("feed", "snapshot_name", "content"), layout)


def land(snaps: DataFrame, layout: str, root: str | None = None) -> str:
    """Snapshots (feed, snapshot_name, content) as files of a landing folder, with a marker file beside them."""
    root = root or scratch(snaps.sparkSession)
    plain = root.removeprefix("file://").removeprefix("file:")

    def write(frames):
        fs = pafs.LocalFileSystem() if plain.startswith("/") else pafs.FileSystem.from_uri(root)[0]
        for f in frames:
            for feed, name, content in f.itertuples(index=False):
                path = f"{plain}/{feed}/{name}" if layout == "blob" else f"{plain}/{feed}/{name.replace('/', '', 2).replace('/', '-')}.xml"
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                for p, data in ((path, content), (f"{plain}/{feed}/LastModified", b"2024-01-31T00:00:00")):
                    with fs.open_output_stream(p) as out:
                        out.write(data)
            yield pd.DataFrame({"n": [len(f)]})

    snaps.mapInPandas(write, "n long").agg(F.sum("n")).collect()
    return root


def feed_of(event_type):
    """The feed that stands for a type of events: both in order of name."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair]), event_type)


def feed_files(spark: SparkSession, sf_dir: str, days: str = "true", root: str | None = None, layout: str = "blob") -> str:
    """A landing folder of five feeds, each in its own elements; of the feed of clicks every seventh day is cut short.

    days chooses some, by a condition on publication_time; root is a folder that has others already.
    """
    r = dealt(raw_records(spark, sf_dir).filter(days).withColumn("feed", feed_of(F.col("feed"))), "feed", "snapshot_name")
    body = r.withColumn("xml", feed_record()).groupBy("feed", "snapshot_name", "publication_time").agg(F.concat_ws("", F.sort_array(F.collect_list(F.struct("ordinal", F.col("xml").alias("x")))).getField("x")).alias("body"))
    whole = F.concat(F.lit("<m><publicationTime>"), F.date_format("publication_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</publicationTime>"), "body", F.lit("</m>"))
    broken = (F.col("feed") == TYPES["click"]) & (F.dayofmonth("publication_time") % 7 == 0)
    return land(body.select("feed", "snapshot_name", F.when(broken, F.concat(whole, F.lit("<"))).otherwise(whole).cast("binary").alias("content")), layout, root)


def feed_record():
    """A record of a feed in its own elements, from source_id and xml."""
    made = F.lit(None).cast("string")
    for feed, (record, ident) in FEEDS.items():
        inner = F.concat(F.lit("<v>"), "xml", F.lit(f"</v></{record}>"))
        own = F.concat(F.lit(f'<{record} id="'), "source_id", F.lit('">'), inner) if record == ident else F.concat(F.lit(f'<{record}><{ident} id="'), "source_id", F.lit('"/>'), inner)
        made = F.when(F.col("feed") == feed, own).otherwise(made)
    return made


def situations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A situation event per order, with a record per line."""
    li = table(spark, sf_dir, "lineitem")
    record = F.concat(F.lit('<situationRecord id="r'), F.col("l_linenumber").cast("string"), F.lit('"><quantity>'), F.col("l_quantity").cast("bigint").cast("string"), F.lit("</quantity></situationRecord>"))
    body = dealt(li, "l_orderkey").groupBy("l_orderkey").agg(F.concat_ws("", F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity", record.alias("x")))).getField("x")).alias("body"))
    xml = F.concat(F.lit('<n:situation xmlns:n="urn:x" id="S'), F.col("l_orderkey").cast("string"), F.lit('" version="1"><overallSeverity>low</overallSeverity>'), "body", F.lit("</n:situation>"))
    return body.select(F.lit("getsituation").alias("feed"), F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("source_id"), F.timestamp_seconds(F.lit(1420073999) + F.col("l_orderkey") % 1000).alias("publication_time"), xml.alias("xml"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A travel location event per customer; every tenth has coordinates that are no numbers."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    lat, lon = (k % 180 - 90).cast("string"), (k % 360 - 180).cast("string")
    text = F.when(k % 10 == 9, F.lit("1 x")).otherwise(F.concat(lon, F.lit(" "), lat, F.lit(","), lat, F.lit(";"), lon, F.lit(" 7")))
    xml = F.concat(F.lit('<predefinedLocationContainer id="L'), k.cast("string"), F.lit('"><location><linearExtension><coordinates>'), text, F.lit("</coordinates></linearExtension></location></predefinedLocationContainer>"))
    return c.select(F.lit("getpredefinedtraveltimelocations").alias("feed"), F.concat(F.lit("L"), k.cast("string")).alias("source_id"), F.timestamp_seconds(F.lit(1420073999) + k).alias("publication_time"), xml.alias("xml"))


def site_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with points: sites, and situations with one or two groups of locations."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    pt = lambda a, b: F.concat(F.lit('{"lat":'), (k % a - a // 2).cast("string"), F.lit('.5,"lon":'), (k % b - b // 2).cast("string"), F.lit(".25}"))
    site = F.concat(F.lit('{"measurementSiteLocation":{"pointByCoordinates":{"pointCoordinates":'), pt(170, 350), F.lit("}}}"))
    one = F.concat(F.lit('{"locationForDisplay":'), pt(160, 340), F.lit("}"))
    group = F.when(k % 3 == 1, one).otherwise(F.concat(F.lit("["), one, F.lit(","), one, F.lit("]")))
    return c.select(F.when(k % 3 == 0, "getmeasurementweathersitetable").otherwise("getsituation").alias("feed"), F.concat(F.lit("D"), k.cast("string")).alias("doc_id"), F.when(k % 3 == 0, site).otherwise(F.concat(F.lit('{"groupOfLocations":'), group, F.lit("}"))).alias("json"))


def trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents with every kind of scalar, renamed and dropped keys, arrays and coordinates."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    text = F.concat(F.lit('{"@xmlns":"u","latitude":"'), k, F.lit('.5","n":{"longitude":"00'), k, F.lit('","@xmlns":"v","ok":" True "},"a":["7",{"latitude":"x'), k, F.lit('"}],"coordinates":"'), k, F.lit(" 2,3;4 5\"}"))
    return c.select(k.alias("doc_id"), text.alias("json"))
