"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Lengths fall into reciprocal classes: class j holds pieces of capacity / 2**j tokens, and each of its bins takes exactly
2**j of them. A document is cut into full pieces and the binary parts of what is left, so a full bin has no padding. Bins
of a class are filled by position alone (a worker's pieces come after those of the workers before it), so workers need
only the class counts of the others. What is left of a class is laid out in groups of a power of two, whose length is
again a power of two.
"""

from __future__ import annotations

import json
import os
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import keyed, lean, pinned

END = 2
# The normaliser and pre-tokeniser for which words can be encoded one by one.
_SIMPLE_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SIMPLE_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

_HELD = 16 << 20


class _Letters(dict):
    """The letters of a character's UTF-8 bytes."""

    def __init__(self):
        super().__init__()
        self.of_byte = _byte_letters()

    def __missing__(self, char: str) -> str:
        self[char] = "".join([self.of_byte[b] for b in char.encode()])
        return self[char]


def _byte_letters() -> list[str]:
    """The letter that byte-level pre-tokenisers write for each byte: printable Latin-1 as itself, others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class WordTokenizer:
    """A tokenizer whose words are encoded once and kept: ids of a text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cache: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        steps = (config["normalizer"] or {}).get("normalizers"), (config["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_word = steps[0] == _SIMPLE_NORMALIZERS and len(steps[1]) == 2 and steps[1][0].get("pattern") == {"Regex": _SIMPLE_SPLIT} and steps[1][1]["type"] == "ByteLevel" and not config["model"]["dropout"]
        self.special = [t["content"] for t in config["added_tokens"]]
        self.split = regex.compile(_SIMPLE_SPLIT).findall
        # The only characters that str.split() takes for white space and the tokenizer doesn't.
        self.odd = regex.compile("[\x1c-\x1f]").search
        # A special token isn't within a word of letters alone.
        self.by_word = self.by_word and not any(t.isalpha() for t in self.special)
        # Below U+0180 every string is in NFC and lower-casing is letter by letter.
        self.plain = regex.compile("[\x21-\x7e\xa1-ſ]+").fullmatch
        self.letters = _Letters()
        self.parts: dict[str, bytes] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0  # characters and bytes in young
        self.cache = cache

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            mapped = part if part.isascii() else "".join(map(self.letters.__getitem__, part))
            found = array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()
            if len(self.parts) >= self.cache // 4:
                self.parts.clear()
            self.parts[part] = found
        return found

    def _word(self, word: str) -> bytes:
        ascii_word = word.isascii()
        if ascii_word and word.isalpha():
            return self._part(word.lower())
        if not (ascii_word and word.isprintable() or self.plain(word)):
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        low = word.lower()
        if low.isalpha():
            return self._part(low)
        for s in self.special:
            if s in word:
                return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        # letters, then marks up to the end, are two parts
        core = low.rstrip(string.punctuation)
        if core.isalpha():
            return self._part(core) + self._part(low[len(core) :])
        return b"".join([self._part(p) for p in self.split(low)])

    def ids(self, text: str) -> bytes:
        if not self.by_word or self.odd(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        words = text.split()
        young, old = self.young, self.old
        for w in set(words).difference(young):
            young[w] = found = old[w] if w in old else self._word(w)
            self.held += len(w) + len(found)
        out = b"".join(map(young.__getitem__, words))
        if len(young) > self.cache // 2 or self.held > _HELD:
            self.old, self.young, self.held = young, {}, 0
        return out


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cuts(tokens: int, capacity: int) -> list[tuple[int, int, int]]:
    """(class, start, length) of the pieces of a document: full ones, then the binary parts of the rest."""
    out, at = [], 0
    for k in range(capacity.bit_length()):
        size = capacity >> k
        while tokens - at >= size:
            out.append((k, at, size))
            at += size
    return out


def pack(docs: DataFrame, path: str, capacity: int = 4096, end: int = END, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, when asked for).

    Every document has at least its end id, so empty and null texts give one piece of one token. Ids that are null or
    repeated are packed as rows of their own. A sequence's length is the capacity or a power of two below it. An empty
    table gives no rows.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, worker, rank = tokenizer(path), TaskContext.get().partitionId(), [0] * capacity.bit_length()
        tail = np.array([end], "<u4").tobytes()
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "kind", "worker", "rank", "ids"][: 9 if with_ids else 8]
        for b in batches:
            out: dict[str, list] = {n: [] for n in names}
            for i, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids = t.ids(body.decode("utf-8", "replace")) + tail
                for k, start, size in cuts(len(ids) // 4, capacity):
                    piece = ids[4 * start : 4 * (start + size)]
                    row = (i, start, size, zlib.crc32(piece), len(ids) // 4, k, worker, rank[k])
                    rank[k] += 1
                    for n, v in zip(names, row, strict=False):
                        out[n].append(v)
                    if with_ids:
                        out["ids"].append(np.frombuffer(piece, "<u4").astype("i8"))
            types = {"kind": pa.int32(), "worker": pa.int32(), "ids": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays([pa.array(v, types.get(n, pa.int64())) for n, v in out.items()], names=names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, kind int, worker int, rank long" + ", ids array<long>" * with_ids
    pieces = pinned(keyed(docs, doc_id, text).select("id", "body").mapInArrow(lean(cut), schema))
    counts = pieces.groupBy("worker", "kind").agg(F.count("*").alias("n"))
    before = Window.partitionBy("kind").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pinned(counts.select("worker", "kind", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy("kind")).alias("total")))
    placed = pieces.join(offsets, ["worker", "kind"]).withColumn("at", F.col("first") + F.col("rank"))
    placed = placed.withColumn("slots", F.expr("shiftleft(1L, kind)")).withColumns({"full": F.expr("total div slots"), "left": F.expr("total % slots")})
    placed = placed.withColumn("x", F.expr("at - full * slots")).withColumn("bit", F.when(F.col("x") >= 0, F.expr("length(bin(left ^ x)) - 1")))
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.expr(f"if(x < 0, at div slots, full + bit) * {capacity.bit_length()} + kind").alias("sequence_id"),
        F.expr("if(x < 0, at % slots, x - shiftleft(shiftright(left, bit + 1), bit + 1)) * length").alias("offset"),
        *["ids"] * with_ids,
    )
