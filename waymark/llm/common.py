"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a local one only where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="waymark-"))
    return spark.sparkContext.getCheckpointDir()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB in this session, unless it asks for less: two tasks of an executor hold several copies of a batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each job made inside go when it ends, for operators of many jobs whose results are all in the shared folder.

    Else they stay until the driver happens to collect its garbage. Within a job they stay, for executors that get lost.
    Don't run a DataFrame made inside twice; make the one that is returned outside.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lean(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """f, after whose last batch the worker gives memory back: workers are kept, and hold on to the most they ever used."""

    def run(batches: Iterator) -> Iterator:
        yield from f(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no trim
            ctypes.CDLL(None).malloc_trim(0)

    return run


def pinned(df: DataFrame) -> DataFrame:
    """A checkpoint of df in the shared folder: cuts lineage, survives lost executors, goes when it is no longer referenced."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder for files in the shared folder, as a URI."""
    base = shared_dir(spark)
    base = base if "://" in base or base.startswith("file:") else f"file://{base}"
    uri = f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    fs, path = file_system(uri)
    fs.create_dir(path, recursive=True)
    return uri


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def text_bytes(text: str) -> Column:
    """The text as UTF-8 bytes, null as empty; bytes spare a decoding and survive ill-formed text."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


_NUMBER = "waymark_row"  # in the metadata of the column of row numbers


def row_column(docs: DataFrame) -> str | None:
    """The column with the numbers that ``numbered`` gave; no column is taken for it by its name."""
    return next((f.name for f in docs.schema if f.metadata.get(_NUMBER)), None)


def free_name(docs: DataFrame, name: str) -> str:
    """A name that no column of docs has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, id, body): row numbers the input's rows, so that repeated or null ids stay apart.

    The number is that of ``numbered`` docs; others are numbered anew by each scan, as the scan is split: join no two of them.
    """
    small_batches(docs.sparkSession)
    name = row_column(docs)
    row = F.col(name) if name else F.monotonically_increasing_id()
    return docs.select(row.alias("row", metadata={}), F.col(doc_id).cast("long").alias("id"), text_bytes(text).alias("body"))


def keyed_once(docs: DataFrame, doc_id: str, text: str, tables: Tables | None = None) -> DataFrame:
    """``keyed``, in the shared folder unless docs are numbered, so that all scans of it agree on the numbers."""
    rows = keyed(docs, doc_id, text)
    return rows if row_column(docs) else (tables.written if tables else written)(rows)


def numbered(docs: DataFrame) -> DataFrame:
    """docs and their numbers, in the shared folder: how a scan is split, by the cores there are, changes no number."""
    return written(docs.withColumn(free_name(docs, "row_number"), F.monotonically_increasing_id().alias("n", metadata={_NUMBER: 1})))


def pick(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of numbered docs whose number is in rows(row), without the number. Only numbers are hashed; texts aren't sorted."""
    name = row_column(docs)
    return docs.join(rows.select(F.col("row").alias(name)).hint("shuffle_hash"), name, "left_semi").drop(name)


class Tables:
    """Parquet tables in the shared folder that nothing needs once an operator's own result is pinned."""

    def __init__(self) -> None:
        self.folders: list[tuple[SparkSession, str]] = []

    def written(self, df: DataFrame) -> DataFrame:
        folder = new_folder(df.sparkSession, "table")
        self.folders.append((df.sparkSession, folder))
        return written(df, folder)

    def drop(self, *only: DataFrame) -> None:
        """Delete these tables, or all."""
        gone = {f.rpartition("/")[2] for df in only for f in {x.rpartition("/")[0] for x in df.inputFiles()}}
        for spark, folder in [f for f in self.folders if not only or f[1].rpartition("/")[2] in gone]:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            self.folders.remove((spark, folder))


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: for tables of many narrow rows, which a checkpoint would hold at full width."""
    folder = folder or new_folder(df.sparkSession, "table")
    df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def zipped(rows: DataFrame, level: int = 4) -> DataFrame:
    """(row, id, body) with the body deflated, for a shuffle of whole texts."""

    def run(batches):
        for b in batches:
            bodies = pa.array([zlib.compress(x.as_py(), level) for x in b.column("body")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), bodies], names=["row", "id", "body"])

    return rows.mapInArrow(lean(run), "row long, id long, body binary")
