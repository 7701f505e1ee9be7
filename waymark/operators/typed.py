"""Typed views of schemaless documents.

Scalars are typed value by value, so one field may be a number here and a text there. Each document has a type; types of
two documents widen to one that holds both, in any order of merging: whole and other numbers to numbers, structs field by
field, arrays by their elements, and whatever else differs to text. A feed's type is the fold of those of its documents:
tasks fold their own, and only types, which are as large as the feed has fields, are shuffled.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, NullType, StringType, StructField, StructType

from waymark.operators.store import Keyed, Store
from waymark.sources.registry import known_feed

_PARTS = 64
_COMMON = ("feed", "doc_id", "source_id", "record_index", "event_time", "publication_time")
TYPES = {"types": Keyed("feed string, version bigint, type string", ("feed", "version"))}


def type_of(value) -> DataType:
    """Type of a value of a JSON document; whole numbers beyond 64 bits count as other numbers."""
    if value is None:
        return NullType()
    if isinstance(value, bool):
        return BooleanType()
    if isinstance(value, int):
        return LongType() if -(1 << 63) <= value < 1 << 63 else DoubleType()
    if isinstance(value, float):
        return DoubleType()
    if isinstance(value, list):
        return ArrayType(functools.reduce(widened, map(type_of, value), NullType()))
    if isinstance(value, dict):
        return StructType([StructField(k, type_of(value[k])) for k in sorted(value)])
    return StringType()


def widened(a: DataType, b: DataType) -> DataType:
    """The least type that holds values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if {type(a), type(b)} == {LongType, DoubleType}:
        return DoubleType()
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, StructType) and isinstance(b, StructType):
        own, other = ({f.name: f.dataType for f in t} for t in (a, b))
        return StructType([StructField(k, widened(own.get(k, NullType()), other.get(k, NullType()))) for k in sorted({*own, *other})])
    return StringType()


def _read(text: str) -> DataType:
    return StructType.fromJson(json.loads(text))


def _folded(texts: Iterator[str]) -> str:
    return functools.reduce(widened, map(_read, set(texts)), StructType([])).json()


def document_types(docs: DataFrame, by: str = "feed", text: str = "json") -> DataFrame:
    """feed, type: the type of each feed's documents, as JSON. Texts that are no JSON object have none, nor have null ones."""

    def own(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, DataType] = {}
        for f in frames:
            for feed, t in zip(f["by"], f["text"], strict=True):
                try:
                    value = json.loads(t) if t is not None else None
                    if isinstance(value, dict):
                        found[feed] = widened(found.get(feed, NullType()), type_of(value))
                except (ValueError, RecursionError):
                    continue
        yield pd.DataFrame([(k, t.json()) for k, t in found.items()], columns=["feed", "type"])

    def fold(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(f["feed"].iloc[0], _folded(f["type"]))], columns=["feed", "type"])

    kind = "feed string, type string"
    tasks = docs.select(F.col(by).alias("by"), F.col(text).alias("text")).mapInPandas(own, kind)
    # Two rounds, so that no group has the types of all tasks.
    some = tasks.groupBy("feed", F.pmod(F.xxhash64("type"), F.lit(_PARTS))).applyInPandas(fold, kind)
    return some.groupBy("feed").applyInPandas(fold, kind)


def usable(kind: DataType) -> DataType:
    """The type for reading: what was never but null is text, and so is a struct without fields."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, usable(f.dataType)) for f in kind]) if kind.fields else StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(usable(kind.elementType))
    return StringType() if isinstance(kind, NullType) else kind


def typed_view(docs: DataFrame, feed: str, kind: DataType | None = None, text: str = "json") -> DataFrame:
    """Documents of a feed with a column ``doc`` of the feed's type; values in fields that are text keep their JSON form.

    kind is found by a pass over the feed's documents if it isn't given, as by ``known_types``. Documents that lack a field,
    such as older ones, have null there; of fields that kind doesn't know nothing is read.
    """
    own = docs.filter(F.col("feed") == known_feed(feed))
    if kind is None:
        found = document_types(own, text=text).first()
        kind = _read(found.type) if found else StructType([])
    common = [c for c in _COMMON if c in docs.columns]
    doc = F.from_json(text, usable(kind)) if getattr(kind, "fields", None) else F.col(text)
    return own.select(*common, doc.alias("doc"))


def record_types(spark: SparkSession, root: str, docs: DataFrame) -> None:
    """Widen the known types by those of new documents. A feed gets a new version where that changes its type."""
    store = Store(spark, root, TYPES)
    change = store.change()
    known = _known(store, change.state)
    new = []
    for r in document_types(docs).collect():  # a row for each feed
        version, kind = known.get(r.feed, (0, NullType()))
        wider = widened(kind, _read(r.type))
        if wider != kind:
            new.append((r.feed, version + 1, wider.json()))
    if new:
        change.append("types", spark.createDataFrame(new, TYPES["types"].schema))
        change.commit()


def _known(store: Store, state: dict, version: int | None = None) -> dict[str, tuple[int, DataType]]:
    rows = store.read("types", state=state).collect()
    rows = [r for r in rows if version is None or r.version <= version]
    return {r.feed: (r.version, _read(r.type)) for r in sorted(rows, key=lambda r: r.version)}


def known_types(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataType]:
    """The type of each feed as recorded last, or at a version."""
    store = Store(spark, root, TYPES)
    return {feed: kind for feed, (_, kind) in _known(store, store.state(), version).items()}
