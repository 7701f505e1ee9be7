"""Polynomial fingerprints of stretches of bytes, and hashes of words by them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

PART = 1 << 18  # bytes hashed at a time
SHORT = 64  # bytes of a word up to which its hash is a polynomial
_WHITE = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Fingerprints:
    """Polynomial fingerprints modulo 2**64 of any stretch of a buffer, by prefix sums."""

    base = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, size: int = 2 * PART):
        inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        letters = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype="u8")
        self.letters = letters * np.uint64(2) + np.uint64(1)
        powers = lambda b: np.multiply.accumulate(np.concatenate([np.ones(1, "u8"), np.full(size, b, "u8")]))
        self.up, self.down = powers(self.base), powers(inverse)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, "u8")
        np.cumsum(self.letters[data] * self.up[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start])


class WordHashes:
    """64-bit hashes of the words of texts, a buffer of texts at a time; A-Z hash like a-z. Nothing is kept between buffers.

    Words of up to 64 bytes hash by polynomials, all of a buffer at once. Polynomials modulo 2**64 have pairs of words, of
    some hundred bytes and more, that are equal under every base, so longer words, which are rare, have xxh3 each.
    """

    def __init__(self, white: bytes = _WHITE):
        self.prints = Fingerprints(2 * PART + 2)
        self.prints.letters[65:91] = self.prints.letters[97:123]
        self.white = np.zeros(256, bool)
        self.white[list(white)] = True
        self.within = re.compile(b"[^" + re.escape(white) + b"]*")

    def of(self, bodies: Iterable[bytes]) -> Iterator[np.ndarray]:
        """The word hashes of each text, in order."""
        now, parts = 0, []
        for index, held in self.groups(bodies):
            if len(held[0]) > PART:  # one word has a hash of its own kind
                found = [np.array([xxhash.xxh3_64_intdigest(held[0].lower())], "u8")]
            else:
                data, sums, start, end, text = self.spots(held)
                found = np.split(self.words(data, sums, start, end), np.searchsorted(text, np.arange(1, len(held))))
            for k, h in zip(index, found, strict=True):
                if k != now:
                    yield np.concatenate(parts)
                    now, parts = k, []
                parts.append(h)
        if parts:
            yield np.concatenate(parts)

    def words(self, data: np.ndarray, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = self.prints.of(sums, start, end)
        for k in np.flatnonzero(end - start > SHORT):
            out[k] = xxhash.xxh3_64_intdigest(data[start[k] : end[k]].tobytes().lower())
        return out

    def groups(self, bodies: Iterable[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
        """(number of its text, piece) of all texts, by buffers. Longer texts are cut where a word ends; a longer word comes alone."""
        index: list[int] = []
        held: list[bytes] = []
        size = 0
        for k, body in enumerate(bodies):
            for piece in self._pieces(body) if len(body) > PART else (body,):
                if held and size + len(piece) > PART:
                    yield index, held
                    index, held, size = [], [], 0
                index.append(k)
                held.append(piece)
                size += len(piece) + 1
        if held:
            yield index, held

    def _pieces(self, body: bytes) -> Iterator[bytes]:
        at = 0
        while at < len(body):
            end = min(len(body), at + PART)
            if end < len(body):
                white = np.flatnonzero(self.white[np.frombuffer(body, "u1", PART + 1, at)])
                end = at + int(white[-1]) if len(white) else self.within.match(body, end).end()
            yield body[at:end]
            at = end + 1

    def spots(self, held: list[bytes]) -> tuple[np.ndarray, ...]:
        """(bytes, prefix sums, first and last byte, place in held) of the words of some texts."""
        data = np.frombuffer(b" ".join([b"", *held, b""]), "u1")
        word = ~self.white[data]
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        start, end = edge[::2], edge[1::2]
        ends = np.cumsum(np.fromiter(map(len, held), "i8", len(held)) + 1)
        return data, self.prints.sums(data), start, end, np.searchsorted(ends, start, side="left")
