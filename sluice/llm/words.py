"""Word hashing over whole texts with numpy: helpers for Arrow-batched tasks.

Texts are handled as UTF-8 bytes. Both word classes used here split on ASCII
bytes only, so byte positions never cut a code point. A word's 64-bit hash is a
polynomial over a random table of its bytes, the same wherever the word stands;
a window's hash is a polynomial over the mixed hashes of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASES = (0xD1B54A32D192ED03, 0xAEF17502108EF2D9)
#: Texts are gathered into pieces of about this many bytes.
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of "words are runs of anything but ASCII white space".
SPACE_SEPARATED = ~_SPACE
#: Word bytes of "ASCII letters and digits, and everything beyond ASCII".
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser with good avalanche (64 bit)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of the byte base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * PIECE_BYTES)
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n)
        return self.up, self.down


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


_POWERS = _Powers()


def _hash_piece(data: np.ndarray, word_bytes: np.ndarray, table: np.ndarray):
    """Start offsets, end offsets and hashes of the words of one piece."""
    inside = np.concatenate([[False], word_bytes[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(table[data] * up[: len(data)], dtype=U64, out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(
    texts: list[bytes], word_bytes: np.ndarray, lower: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and the first word index of each
    text (one more entry than texts)."""
    table = _TABLE[_LOWER] if lower else _TABLE
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= PIECE_BYTES):
            size += len(texts[j]) + 1
            j += 1
        if j == i + 1 and len(texts[i]) > PIECE_BYTES:
            for part in _parts(texts[i], word_bytes):
                got = _hash_piece(part, word_bytes, table)[2]
                hashes.append(got)
                counts[i] += len(got)
        else:
            data = np.frombuffer(b"\n".join(texts[i:j]), np.uint8)
            starts, _, got = _hash_piece(data, word_bytes, table)
            hashes.append(got)
            ends = np.cumsum([len(t) + 1 for t in texts[i:j]])
            firsts = np.searchsorted(starts, np.concatenate([[0], ends]))
            counts[i:j] = np.diff(firsts)
        i = j
    return (
        np.concatenate(hashes) if hashes else np.empty(0, U64),
        np.concatenate([[0], np.cumsum(counts)]),
    )


def _parts(text: bytes, word_bytes: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that end at a separator."""
    data = np.frombuffer(text, np.uint8)
    at = 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        while end < len(data):
            breaks = np.flatnonzero(~word_bytes[data[at:end]])
            if len(breaks):
                end = at + int(breaks[-1]) + 1
                break
            end = min(end + PIECE_BYTES, len(data))
        yield data[at:end]
        at = end


def window_hashes(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each position; shorter at the end by
    ``length - 1`` entries. Built by doubling window lengths."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, U64)
    base = _WINDOW_BASES[which]
    block, size = words, 1
    out, done = None, 0
    rest = length
    while True:
        if rest & 1:
            part = block[done : done + n] * U64(pow(base, done, 2**64))
            out = part if out is None else out + part
            done += size
        rest >>= 1
        if not rest:
            return mix(out)
        block = block[:-size] + block[size:] * U64(pow(base, size, 2**64))
        size *= 2


def owner_of(firsts: np.ndarray) -> np.ndarray:
    """Text index of every word."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def inside_one_text(firsts: np.ndarray, length: int) -> np.ndarray:
    """Positions whose window of ``length`` words stays inside its text."""
    ends = np.repeat(firsts[1:], np.diff(firsts))
    at = np.arange(len(ends))
    return np.flatnonzero(at + length <= ends)


def utf8(column) -> list[bytes]:
    """Texts of an Arrow column as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in column.cast("binary").to_pylist()]


def slices(batch: pa.RecordBatch, text_column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A record batch in slices of about ``size`` text bytes, so that the arrays made
    from a batch stay small however long its texts are."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text_column)), 0)
    part = np.cumsum(lengths.to_numpy(zero_copy_only=False)) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)
