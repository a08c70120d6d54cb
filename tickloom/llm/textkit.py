"""Words and hashes of Arrow text columns, in numpy, a bounded piece at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes hashed at once, so that the arrays stay in a core's cache; only a longer single word takes more.
PIECE = 1 << 16
#: Bytes of text that a task which keeps tables of its own works on at once.
SLICE = 1 << 20
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words without white space.
PLAIN = ~_ASCII_SPACE
#: Bytes of words of digits, lower-case letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 at least of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values; a new array."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64) if places else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a text column: byte ``starts`` and ``ends`` (past the last), their ``hashes``, and
    ``first``, the index of each row's first word (one more entry than rows)."""

    def __init__(self, column: pa.Array, letters: np.ndarray = PLAIN, lower: bool = True):
        self.data, self.offsets = text_bytes(column)
        data = LOWER[self.data] if lower else self.data
        self.lowered = data
        inside = letters[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        filled = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        begins[filled] = inside[filled]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[filled[1:] - 1] = inside[filled[1:] - 1]
        self.starts, self.ends = self._cut(np.flatnonzero(begins), np.flatnonzero(last) + 1)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.hashes = self._hash(data)

    def _cut(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words as they are hashed; a subclass may cut them further."""
        return starts, ends

    def __len__(self) -> int:
        return len(self.starts)

    def _hash(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(self), np.uint64)
        at = 0
        while at < len(self):
            begin = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, begin + PIECE, "right")))
            size = int(self.ends[to - 1] - begin)
            up, down = powers(size + 1)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(_BYTE[data[begin : begin + size]] * up[:size], out=sums[1:])
            a, b = self.starts[at:to] - begin, self.ends[at:to] - begin
            out[at:to] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
            at = to
        return mix(out)

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def slices(batch: pa.RecordBatch, column: str, size: int = 4 * SLICE):
    """Parts of a batch of about ``size`` bytes in a text column, a row at least."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then the next ones."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before - starts, counts)


def least(key: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    return np.minimum(key[: len(key) - (width - have)], key[width - have :]) if width > have else key


def minimizers(hashes: np.ndarray, width: int, whole: np.ndarray) -> np.ndarray:
    """Places of the least of each ``width`` neighbours for which ``whole`` holds, the first if equal; sorted, distinct."""
    mask = np.uint64((1 << 20) - 1)
    found = np.zeros(len(hashes), bool)
    for lo in range(0, len(hashes) - width + 1, 1 << 18):
        piece = hashes[lo : lo + (1 << 18) + width - 1]
        key = (piece & ~mask) | np.arange(len(piece), dtype=np.uint64)
        place = (least(key, width) & mask).astype(np.int64)
        found[lo + place[whole[lo : lo + len(place)]]] = True
    return np.flatnonzero(found)
