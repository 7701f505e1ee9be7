"""Chat formatting with loss masks that follow token offsets.

A turn is written as ``<turn>role<says>text</turn>``. Those three marks are tokens of their own, so a text's first and last
tokens begin and end with it. In roles and texts a backslash is doubled, and a mark gets a single one behind its ``<``;
thus no text can hold a mark, and reading back undoes it. A conversation is rendered whole and encoded once; the spans of
its assistant texts and of its tokens, both sorted, are intersected by binary search, which gives a mask over the tokens.

Very long conversations are rendered in pieces of whole turns, which encode as the whole would, as marks part tokens.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import lean, small_batches

TURN, SAYS, END = MARKS = ("<turn>", "<says>", "</turn>")
_BLANKS = 4096
_PIECE = 1 << 20  # code points of a piece, but for the turn that reaches it
_ESCAPED = re.compile(r"\\|<(?=turn>|says>|/turn>)")
_UNESCAPED = re.compile(r"\\(\\?)")
_LONG_BLANKS = re.compile(r"\s{%d,}" % (_BLANKS + 1))


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else "<\\", text)


def unescape(text: str) -> str:
    """Pairs of backslashes are one, a single one is none: it parted a mark."""
    return _UNESCAPED.sub(r"\1", text)


class Coder:
    """A byte-level vocabulary with the three marks; ids and the number of bytes of each."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        first = max(ranks.values()) + 2  # the id between is the vocabulary's own end of text
        self.marks = {m: first + k for k, m in enumerate(MARKS)}
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.marks)
        self.sizes = np.zeros(first + len(MARKS), "i8")
        for token, k in [*ranks.items(), *((m.encode(), k) for m, k in self.marks.items())]:
            self.sizes[k] = len(token)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a rendered text. More than 4,096 blanks on end are cut there, where the pattern would give up."""
        cuts = [at for m in _LONG_BLANKS.finditer(text) for at in range(m.start() + _BLANKS, m.end(), _BLANKS)]
        parts = [self.encoding.encode(text[a:b], allowed_special="all") for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        return np.concatenate([np.array(p, "i4") for p in parts])

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())


@functools.cache
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def render(turns: list[tuple[str, str]], trained: str) -> tuple[str, np.ndarray]:
    """The text of some turns, and the spans, in bytes, of those whose role is trained."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{SAYS}", escape(text)
        start = at + len(head.encode())
        at = start + len(body.encode())
        if role == trained:
            spans.append((start, at))
        at += len(END)
        parts += [head, body, END]
    return "".join(parts), np.array(spans, "i8").reshape(-1, 2)


def mask_of(sizes: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Whether each token lies in a span. Tokens are given by their sizes; both are sorted, so bounds are searched for."""
    ends = np.cumsum(sizes)
    first, last = np.searchsorted(ends, spans[:, 0], "right"), np.searchsorted(ends - sizes, spans[:, 1], "left")
    turned = np.zeros(len(sizes) + 1, "i4")
    np.add.at(turned, first, 1)
    np.add.at(turned, last, -1)
    return np.cumsum(turned[:-1]) > 0


def parse(text: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of a rendered text."""
    for turn in text.split(END)[:-1]:
        role, _, body = turn.removeprefix(TURN).partition(SAYS)
        yield unescape(role), unescape(body)


_FORMATTED = "conv_id long, piece int, n_chars long, ids array<int>, loss_mask array<boolean>"


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows), kind))


def _former(path: str, pattern: str, trained: str):
    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern)
        done: list[tuple] = []
        open_, key, piece, held = [], None, 0, 0

        def close():
            nonlocal open_, piece, held
            text, spans = render(open_, trained)
            ids = code.encode(text)
            done.append((key, piece, len(text), ids, mask_of(code.sizes[ids], spans)))
            open_, piece, held = [], piece + 1, 0

        def batch():
            out = pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int32()), pa.array([d[2] for d in done], pa.int64()), _lists([d[3] for d in done], pa.int32()), _lists([d[4] for d in done], pa.bool_())],
                names=["conv_id", "piece", "n_chars", "ids", "loss_mask"],
            )
            done.clear()
            return out

        for b in batches:
            for conv, role, text in zip(b.column("conv_id").to_pylist(), b.column("role"), b.column("text"), strict=True):
                if open_ and conv != key:
                    close()
                if conv != key:
                    piece = 0
                key = conv
                open_.append(((role.as_py() or b"").decode("utf-8", "replace"), (text.as_py() or b"").decode("utf-8", "replace")))
                held += len(open_[-1][1])
                if held >= _PIECE:
                    close()
                if sum(len(d[3]) for d in done[-64:]) >= _PIECE or len(done) >= 1000:
                    yield batch()
        if open_:
            close()
        if done:
            yield batch()

    return form


def format_chats(conversations: DataFrame, path: str, pattern: str, trained: str = "assistant") -> DataFrame:
    """conv_id, piece, n_chars, ids, loss_mask of each conversation (rows of conv_id, turn, role, text), in order.

    Rows go by turn; null turns come first, and rows of the same turn, repeated ones too, go by role and text. Null roles and
    texts are empty, and ill-formed UTF-8 is replaced. Rows with a null conv_id are one conversation. Pieces of a conversation
    are adjacent and in order; most have one. An empty table gives none; other columns are not read. Only one piece is held
    at a time, so that a conversation with most of the rows fits.
    """
    small_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", F.coalesce("role", F.lit(b"")), F.coalesce("text", F.lit(b"")))
    return dealt.select("conv_id", "role", "text").mapInArrow(lean(_former(path, pattern, trained)), _FORMATTED)


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"


def _reader(path: str, pattern: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern)
        schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (c.split() for c in _READ.split(", "))])
        now: list | None = None
        done: list[tuple] = []

        def close():
            done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), *now[5:]))

        for b in batches:
            for conv, piece, ids, mask in zip(b.column("conv_id").to_pylist(), b.column("piece").to_pylist(), b.column("ids"), b.column("loss_mask"), strict=True):
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)
                if now is None or piece == 0:
                    if now:
                        close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                text = code.bytes_of(ids).decode()
                for role, said in parse(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode())
                turns = np.flatnonzero(np.diff(mask.astype("i1"), prepend=0, append=0)).reshape(-1, 2)
                for a, z in turns:
                    said = unescape(code.bytes_of(ids[a:z]).decode())
                    now[3] += len(said)
                    now[4].update(said.encode())
                now[5] += len(text)
                now[6] += len(ids)
                now[7] += int(mask.sum())
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema=schema)
                done.clear()
        if now:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema=schema)

    return read


def read_back(formatted: DataFrame, path: str, pattern: str, in_order: bool = False) -> DataFrame:
    """What the ids and masks of formatted conversations say: turns, texts under the mask, and their sizes.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline of each turn), loss_chars, loss_sha256 (all text under the
    mask), formatted_chars, n_tokens, loss_tokens. in_order: pieces still lie as ``format_chats`` left them; a table that was
    written and read again is sorted here first. An empty table gives no rows.
    """
    if not in_order:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return formatted.select("conv_id", "piece", "ids", "loss_mask").mapInArrow(lean(_reader(path, pattern)), _READ)
