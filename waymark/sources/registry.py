"""The feeds: names, record and id elements, and typed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Feed -> (record element, id element).
FEEDS = {
    "getmeasurementweathersitetable": ("measurementSiteRecord", "measurementSiteRecord"),
    "getmeasuredweatherdata": ("siteMeasurements", "measurementSiteReference"),
    "getcctvsitetable": ("cctvCameraMetadataRecord", "cctvCameraMetadataRecord"),
    "getpredefinedtraveltimelocations": ("predefinedLocationContainer", "predefinedLocationContainer"),
    "gettraveltimedata": ("elaboratedData", "predefinedLocationReference"),
    "getsituation": ("situation", "situation"),
}
DEFAULT_FEEDS = tuple(f for f in FEEDS if f != "getcctvsitetable")
_POINT = "STRUCT<lat: DOUBLE, lon: DOUBLE>"
#: Typed targets of the feeds; a feed without an entry has the common columns only.
SCHEMAS = {
    "getmeasurementweathersitetable": f"measurementSiteLocation STRUCT<pointByCoordinates: STRUCT<pointCoordinates: {_POINT}>>",
    "getsituation": f"groupOfLocations ARRAY<STRUCT<locationForDisplay: {_POINT}>>",
}
_COMMON = "feed STRING, doc_id STRING, source_id STRING, record_index INT, event_time TIMESTAMP, publication_time TIMESTAMP"


def known_feed(feed: str) -> str:
    """The feed's name in lower case; an unknown one is an error."""
    if feed.lower() not in FEEDS:
        raise ValueError(f"unknown feed: {feed}")
    return feed.lower()


def feed_registry(spark: SparkSession, feeds: tuple[str, ...] = DEFAULT_FEEDS) -> DataFrame:
    rows = [(known_feed(f), *FEEDS[known_feed(f)]) for f in feeds]
    return spark.createDataFrame(rows, "feed STRING, record_element STRING, id_element STRING")


def with_elements(snapshots: DataFrame) -> DataFrame:
    """snapshots with record_element and id_element added; feeds match in any case, unknown ones get null."""
    names = F.create_map(*[F.lit(x) for f, e in FEEDS.items() for x in (f, "|".join(e))])
    both = F.split(F.try_element_at(names, F.lower("feed")), r"\|")
    return snapshots.withColumns({"record_element": F.get(both, 0), "id_element": F.get(both, 1)})


def feed_schema(feed: str) -> StructType:
    """Schema of a feed's typed documents."""
    own = SCHEMAS.get(known_feed(feed))
    return StructType.fromDDL(_COMMON + (f", {own}" if own else ""))


def create_index_table(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """An empty Parquet table with the feed's schema."""
    spark.createDataFrame([], feed_schema(feed)).write.mode("errorifexists").parquet(path)
    return spark.read.schema(feed_schema(feed)).parquet(path)
