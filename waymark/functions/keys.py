"""Row keys, time ids, document ids and paths, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: one more than the number of 100 ns ticks from 1970-01-01 to the end of the year 9999.
_LAST = 2534023008000000000
_SITUATIONS = "getsituation"
#: Suffixes of the data sets of a feed.
KINDS = {"events": "-events", "documents": "-events-json", "geometries": "-events-json-coordinates"}


def row_key(ts: Column) -> Column:
    """19 digits that sort newest first."""
    return F.lpad((F.lit(_LAST) - F.unix_micros(ts) * 10).cast("string"), 19, "0")


def row_key_to_time(key: Column) -> Column:
    return F.timestamp_micros(F.floor((F.lit(_LAST) - key.cast("bigint")).cast("decimal(20,0)") / 10).cast("bigint"))


def time_id(ts: Column, tz: str = "UTC") -> Column:
    """Sortable time to the second in the zone tz."""
    return F.date_format(F.from_utc_timestamp(ts, tz), "yyyy-MM-dd'T'HH:mm:ss")


def document_id(feed: Column, source_id: Column, index: Column, ts: Column, tz: str = "UTC") -> Column:
    """Situations carry the record's number, counted from 1; other feeds don't."""
    plain = F.concat_ws("_", source_id, time_id(ts, tz))
    return F.when(F.lower(feed) == _SITUATIONS, F.concat_ws("_", source_id, (index + 1).cast("string"), time_id(ts, tz))).otherwise(plain)


def parse_document_id(doc_id: Column) -> Column:
    """struct(source_id, time_id), split at the last underscore."""
    return F.struct(F.regexp_extract(doc_id, "^(.*)_([^_]*)$", 1).alias("source_id"), F.regexp_extract(doc_id, "^(.*)_([^_]*)$", 2).alias("time_id"))


def dataset_name(feed: Column, kind: str) -> Column:
    return F.concat(F.lower(feed), F.lit(KINDS[kind]))


def event_path(source_id: Column, key: Column) -> Column:
    return F.concat_ws("/", source_id, key)


def document_path(source_id: Column, ts: Column, tz: str = "UTC") -> Column:
    return F.concat_ws("/", source_id, time_id(ts, tz))


def snapshot_path(ts: Column, layout: str = "blob") -> Column:
    return F.date_format(ts, "yyyy/MM/dd/HHmmss" if layout == "blob" else "yyyyMMdd-HHmmss")


def is_of_date(key: Column, date: str) -> Column:
    """Whether a key's time lies in [date, date + 1 day)."""
    t = row_key_to_time(key)
    return (t >= F.lit(date).cast("timestamp")) & (t < F.date_add(F.lit(date).cast("date"), 1).cast("timestamp"))
