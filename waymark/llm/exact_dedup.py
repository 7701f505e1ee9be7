"""Exact dedup by deterministic block naming.

Texts are cut into fixed-size blocks. Equal blocks meet in one partition, are sorted there and get one integer name;
adjacent names are then named pair by pair, level by level, until each text has a single name. Two texts have the same
(level, name) if and only if they are equal: no hash decides, hashes only choose partitions.

Within an Arrow batch equal texts are collapsed first and carry a list of their rows, so a group of copies that holds a
third of the table sends one text per batch through the shuffle, not one per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import keyed, lean, pinned

BLOCK = 2048
_CUT = "ldoc long, pos int, block binary, ids array<long>, rows array<long>, sha string"
_NAMED = "ldoc long, pos int, name long, ids array<long>, rows array<long>, sha string"


def _cutter(block: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ldoc = (TaskContext.get().partitionId() << 33) + 1
        schema = pa.schema([("ldoc", pa.int64()), ("pos", pa.int32()), ("block", pa.binary()), ("ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64())), ("sha", pa.string())])
        for b in batches:
            seen: dict[bytes, list[tuple]] = {}
            for row, i, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                seen.setdefault(body.lower(), []).append((i is not None, i, row))  # bytes.lower() touches A-Z only
            out: list[list] = [[], [], [], [], [], []]
            held = 0
            for body, members in seen.items():
                members.sort(key=lambda m: (m[0], m[1] or 0, m[2]))
                rows = [(ldoc, None, None, [m[1] for m in members], [m[2] for m in members], hashlib.sha256(body).hexdigest())]
                rows += [(ldoc, k, body[at : at + block], None, None, None) for k, at in enumerate(range(0, max(1, len(body)), block))]
                for r in rows:
                    for c, v in zip(out, r, strict=True):
                        c.append(v)
                ldoc += 1
                held += len(body)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
                    out, held = [[], [], [], [], [], []], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return cut


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the distinct blocks of a sorted partition."""
    name, last = TaskContext.get().partitionId() << 33, None
    for b in batches:
        names = []
        for block in b.column("block").to_pylist():
            if block is not None and block != last:
                name, last = name + 1, block
            names.append(None if block is None else name)
        cols = [pa.array(names, pa.int64()) if n == "block" else b.column(n) for n in b.schema.names]
        yield pa.RecordBatch.from_arrays(cols, names=["name" if n == "block" else n for n in b.schema.names])


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of docs: row, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the largest doc_id stays
    (null ids come last; of rows that repeat that id, the last row stays). Empty tables give no rows; other columns of
    docs are not read.
    """
    cut = keyed(docs, doc_id, text).mapInArrow(lean(_cutter(block)), _CUT)
    place = F.when(F.col("block").isNull(), F.xxhash64("ldoc")).otherwise(F.xxhash64("block"))
    level0 = pinned(cut.repartition(place).sortWithinPartitions("block").mapInArrow(lean(_name), _NAMED))
    members = level0.filter(F.col("ids").isNotNull()).select("ldoc", "ids", "rows", "sha")
    runs = level0.filter(F.col("name").isNotNull())

    def gather(named: DataFrame) -> DataFrame:
        return named.groupBy("ldoc").agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).getField("name").alias("names"))

    now, level, done = pinned(gather(runs)), 0, []
    while True:
        done.append(now.filter(F.size("names") == 1).select("ldoc", F.lit(level).alias("level"), F.col("names")[0].alias("name")))
        longer = now.filter(F.size("names") > 1)
        if longer.isEmpty():
            break
        pairs = longer.select("ldoc", F.posexplode(F.expr("transform(sequence(0, (size(names) - 1) div 2), i -> struct(names[2*i] as l, coalesce(get(names, 2*i + 1), 0L) as r))")).alias("pos", "p")).select("ldoc", "pos", "p.l", "p.r")
        names = pinned(pairs.select("l", "r").distinct().sortWithinPartitions("l", "r").select("l", "r", (F.monotonically_increasing_id() + 1).alias("name")))
        now, level = pinned(gather(pairs.join(names, ["l", "r"]).select("ldoc", "pos", "name"))), level + 1

    ident = done[0]
    for d in done[1:]:
        ident = ident.unionByName(d)
    local = pinned(members.join(ident, "ldoc"))
    groups = pinned(local.groupBy("level", "name").agg(F.sum(F.size("ids")).cast("long").alias("group_size"), F.max(F.struct(F.element_at("ids", -1).alias("id"), F.element_at("rows", -1).alias("row"))).alias("keep")))
    return (
        local.join(groups, ["level", "name"])
        .select(F.explode(F.arrays_zip("ids", "rows")).alias("m"), "keep", "group_size", "sha")
        .select(
            F.col("m.rows").alias("row"),
            F.col("m.ids").alias("doc_id"),
            F.col("keep.id").alias("keep_id"),
            "group_size",
            (F.col("m.rows") == F.col("keep.row")).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )
