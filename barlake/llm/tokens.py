"""Words of UTF-8 texts as 64-bit hashes, for many texts at a time.

Both word definitions part words at ASCII bytes only, so words are runs of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SPACE = 0x20
CHUNK_BYTES = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _lowered() -> bytearray:
    return bytearray(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def alnum_bytes() -> bytes:
    """Byte map: A-Z lowered; all ASCII but digits and letters becomes a space."""
    out = _lowered()
    for b in range(128):
        if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A):
            out[b] = SPACE
    return bytes(out)


def blank_bytes() -> bytes:
    """Byte map: A-Z lowered; tab to carriage return becomes a space."""
    out = _lowered()
    out[0x09:0x0E] = bytes([SPACE]) * 5
    return bytes(out)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves about half of the output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODES = mixed_bits(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


def _powers(n: int, factor: np.uint64 = _MULTIPLIER) -> np.ndarray:
    out = np.full(max(n, 1), factor, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """The words of some texts: hashes, byte ranges in ``data`` and first word of each text."""

    def __init__(self, texts: list[bytes], byte_map: bytes):
        self.data = (b" " + b" ".join(texts) + b" ").translate(byte_map)
        raw = np.frombuffer(self.data, dtype=np.uint8)
        inside = (raw != SPACE).view(np.int8)
        turns = np.diff(inside)
        self.starts = np.flatnonzero(turns == 1) + 1
        self.ends = np.flatnonzero(turns == -1) + 1
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.offsets = 1 + np.concatenate(([0], np.cumsum(sizes + 1)))
        self.firsts = np.searchsorted(self.starts, self.offsets)
        self.hashes = self._hashes(raw)

    def _hashes(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        at = np.arange(lengths.sum()) - np.repeat(begins, lengths)
        letters = raw[raw != SPACE]
        values = _CODES[letters] * _powers(int(lengths.max()))[at]
        self._letters = (values, at, begins)
        return mixed_bits(np.add.reduceat(values, begins) + lengths.astype(np.uint64))

    def beginnings(self, n: int) -> np.ndarray:
        """A hash of the first ``n`` bytes of each word."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        values, at, begins = self._letters
        return mixed_bits(np.add.reduceat(np.where(at < n, values, np.uint64(0)), begins))

    def runs(self, n: int) -> np.ndarray:
        """A hash of each run of ``n`` words, whether or not it crosses texts."""
        count = len(self.hashes) - n + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        out = np.zeros(count, dtype=np.uint64)
        for k, factor in enumerate(_powers(n, np.uint64(0xD1B54A32D192ED03))):
            out += self.hashes[k:k + count] * factor
        return mixed_bits(out)

    def phrase(self, first: int, n: int) -> bytes:
        """The words from ``first`` on, parted by one space."""
        ranges = zip(self.starts[first:first + n], self.ends[first:first + n], strict=True)
        return b" ".join(self.data[s:e] for s, e in ranges)


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK_BYTES; a longer text is a range of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def slices(batches, rows: int = 2000) -> Iterator:
    """Arrow batches cut to so many rows, which bounds what a task holds beside its batch."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def text_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow text column; null is empty."""
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
