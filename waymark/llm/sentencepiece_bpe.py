"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

A BPE encoding has one last token for each prefix of the text. Scanning from the left, an automaton lists the pieces
that end at each position; the one that is the last token is the one whose pair with the last token before it encodes
to that same pair. One table entry per position is kept, and the ids are read off backwards.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import keyed, lean

SPACE = "▁"
# Fixed values of the public model format: piece types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field number and value of each field of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else varint(at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class PieceModel:
    """Encoder and decoder for one BPE model file with identity normalisation."""

    def __init__(self, path: str, cache: int = 1_000_000):
        with open(path, "rb") as f:
            parts = list(_fields(f.read()))
        self.pieces, self.kinds, scores = [], [], []
        for number, value in parts:
            if number == 1:
                p = dict(_fields(value))
                self.pieces.append(p[1].decode())
                scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                self.kinds.append(p.get(3, NORMAL))
        trainer = {k: v for n, part in parts if n == 2 for k, v in _fields(part)}
        norm = {k: v for n, part in parts if n == 3 for k, v in _fields(part)}
        if trainer.get(3) != 2 or not trainer.get(35, 0):
            raise ValueError("only BPE models with byte fallback are supported")
        if norm.get(2) or norm.get(4, 1) or not norm.get(5, 1) or USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("only models with identity normalisation, kept spaces and no user-defined pieces are supported")
        self.prefix = bool(norm.get(3, 1))
        self.eos = self.kinds.index(CONTROL, 2) if self.kinds[2] == CONTROL else self.pieces.index("</s>")
        self.score = {p: s for p, s, k in zip(self.pieces, scores, self.kinds, strict=True) if k == NORMAL}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.shown = ["" if k in (CONTROL, BYTE) else " ⁇ " if k == UNKNOWN else p.replace(SPACE, " ") for p, k in zip(self.pieces, self.kinds, strict=True)]
        # Symbols that merges can use but that are no piece of their own; they end as bytes.
        self.names = list(self.pieces)
        for c in sorted({c for p in self.ids for c in p} - self.ids.keys()):
            self.ids[c] = len(self.names)
            self.names.append(c)
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        # A space can only open a piece, so no piece crosses from a word into the spaces after it.
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.segments: Callable[[str], list[str]] = (lambda s: [s]) if crossing else re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        self.width = len(self.names)
        self.pair: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.cache = cache

    def _merge(self, text: str) -> list[str]:
        """Plain BPE of a short string: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, a: int, b: int) -> bool:
        """Whether the texts of tokens a and b, put together, encode to a and b; a = -1: whether b encodes to itself."""
        if len(self.pair) > 1_000_000:
            self.pair.clear()
        parts = [self.names[b]] if a < 0 else [self.names[a], self.names[b]]
        found = self.pair[a * self.width + b] = self._merge("".join(parts)) == parts
        return found

    def _segment(self, s: str) -> list[int]:
        """Prefix table of a segment: last[e] is the last token of s[:e]; -1 at the start and after a symbol of no piece."""
        n, width, known = len(s), self.width, self.pair.get
        last = [-1] * (n + 1)
        size = [1] * (n + 1)
        filled = -1
        for end, (token, length) in self.automaton.iter(s):
            if end != filled:
                before = last[end + 1 - length]
                fits = known(before * width + token)
                if fits is None:
                    fits = self._fits(before, token)
                if fits:
                    last[end + 1], size[end + 1], filled = token, length, end
        ids: list[int] = []
        e = n
        while e > 0:
            token = last[e]
            if token < 0 or token >= len(self.pieces):
                ids += [self.bytes[b] for b in reversed(s[e - size[e] : e].encode())]
            else:
                ids.append(token)
            e -= size[e]
        ids.reverse()
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without start or end."""
        if not text:
            return []
        whole = text.replace(" ", SPACE)
        segments = self.segments(SPACE + whole if self.prefix else whole)
        known, out = self.known, []
        for s in segments:
            ids = known.get(s)
            if ids is None:
                ids = tuple(self._segment(s))
                if len(s) <= 64:
                    if len(known) >= self.cache:
                        known.clear()
                    known[s] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids; of bytes that form no character, each becomes U+FFFD."""
        shown, byte_of = self.shown, self.byte_of
        out: list[str] = []
        run = bytearray()
        opening = self.prefix
        if not byte_of.keys().isdisjoint(ids):
            parts = []
            for i in ids:
                if i in byte_of:
                    run.append(byte_of[i])
                    continue
                if run:
                    parts.append((_characters(bytes(run)), False))
                    run.clear()
                parts.append((shown[i], self.kinds[i] == NORMAL))
            if run:
                parts.append((_characters(bytes(run)), False))
            for p, normal in parts:
                if opening and p:
                    p, opening = (p[1:] if normal and p[0] == " " else p), False
                out.append(p)
            return "".join(out)
        text = "".join([shown[i] for i in ids])
        if opening:
            first = next((i for i in ids if shown[i]), None)
            if first is not None and self.kinds[first] == NORMAL and text[0] == " ":
                return text[1:]
        return text


def _characters(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded when asked for), one row per row of docs.

    Ids end with the end id; null text counts as empty and gives that id alone. Bytes that are no UTF-8 are read as U+FFFD.
    Repeated rows and null ids stay as they are. No row needs another, so nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        names = [str(i) for i in range(len(m.pieces))]
        for b in batches:
            got: dict[str, list] = {"doc_id": b.column("id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            if with_ids:
                got["ids"] = []
            if with_text:
                got["decoded"] = []
            for body in b.column("body"):
                ids = m.encode(body.as_py().decode("utf-8", "replace"))
                ids.append(m.eos)
                back = m.decode(ids)
                got["n_tokens"].append(len(ids))
                got["ids_sha256"].append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                got["decoded_sha256"].append(hashlib.sha256(back.encode()).hexdigest())
                if with_ids:
                    got["ids"].append(ids)
                if with_text:
                    got["decoded"].append(back)
            yield pa.RecordBatch.from_pydict(got)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * with_ids + ", decoded string" * with_text
    return keyed(docs, doc_id, text).select("id", "body").mapInArrow(lean(run), schema)


def decode_ids(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """rows with the decoded text of an id array added; a null array gives null."""

    def decode(column: pd.Series) -> pd.Series:
        m = model(path)
        return column.map(lambda v: None if v is None else m.decode([int(i) for i in v]))

    return rows.withColumn(out, F.pandas_udf(decode, "string")(F.col(ids)))
