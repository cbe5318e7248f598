"""Substring dedup by level-wise doubling of repeated word windows.

Level one finds the short windows (7 words) that occur more than once anywhere.
Only a place whose short windows all repeat can hold a repeated longer window,
so each next level looks at windows of about twice the length whose first and
last halves survived, until the wanted length (13) is reached or no candidate
is left. At that length a window is removed from a document when its word
sequence also starts in a document with a smaller id; windows are judged on the
input, and the covered words of all removed windows go.

How it runs: documents are dealt to chunks of bounded bytes by a hash of their
row. At each level a chunk asks, bucket by bucket of the hash range, about its
distinct window hashes (packed, 4 bytes each at filter levels, 12 at the last);
a bucket answers with one bit per hash. A window that fills a third of the
table is one entry per chunk, so no bucket grows with a hot window's rows. The
text is shuffled once: every level reads the same exchange. Filter levels may
let a false candidate through; the last level compares 64-bit hashes.

Defined cases: null text counts as empty; documents shorter than the window
lose nothing; rows that repeat an id are judged as one document (none is
smaller than the other) and each get their row; a null id counts as smaller
than any other; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import words as W
from sluice.llm.common import ship, text_or_empty

WINDOW_WORDS = 13
#: Length of the first level; shorter windows repeat almost everywhere.
FIRST_WORDS = 7
#: Text bytes of a chunk and windows of a bucket: one task's memory, not a limit
#: on the data. Both may grow with the executors' memory.
CHUNK_BYTES = 4 << 20
BUCKET_WINDOWS = 4 << 20
_MIN_ID = -(2**63)

_ASK = "bucket int, chunk int, level int, hashes binary, owners binary"
_ANSWER = "chunk int, level int, bucket int, bits binary"


def levels(window: int, first: int = FIRST_WORDS) -> list[int]:
    """Window lengths from ``first``, doubling up to ``window``."""
    out = [window]
    while out[0] > first:
        out.insert(0, (out[0] + 1) // 2)
    return out


class _Chunk:
    """The windows of one chunk; rebuilt the same way at every level."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], n_buckets: int) -> None:
        self.words, self.firsts = W.word_hashes(texts, W.SPACE_SEPARATED, lower=False)
        self.owner = ids[W.owner_of(self.firsts)] if len(ids) else np.empty(0, np.int64)
        self.n_buckets = n_buckets

    def candidates(self, length: int, before: tuple[int, np.ndarray] | None) -> np.ndarray:
        """Window starts at ``length`` whose halves survived ``before``."""
        at = W.inside_one_text(self.firsts, length)
        if before is None:
            return at
        half, alive = before
        return at[alive[at] & alive[at + length - half]]

    def distinct(self, length: int, at: np.ndarray):
        """Sorted distinct hashes, the index of each window into them, and the
        smallest owner of each."""
        hashes, index = np.unique(
            W.window_hashes(self.words, length)[at] if len(at) else np.empty(0, W.U64),
            return_inverse=True,
        )
        least = np.full(len(hashes), np.iinfo(np.int64).max)
        np.minimum.at(least, index, self.owner[at])
        return hashes, index, least

    def cuts(self, hashes: np.ndarray) -> np.ndarray:
        """Where each bucket starts in the sorted hashes (buckets split the range)."""
        bucket = self.bucket_of(hashes)
        return np.searchsorted(bucket, np.arange(self.n_buckets + 1))

    def bucket_of(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> W.U64(32)) * W.U64(self.n_buckets) >> W.U64(32)).astype(np.int64)

    def flags(self, hashes: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
        """The answered bit of each hash (absent answers are all zero)."""
        out, cuts = np.zeros(len(hashes), bool), self.cuts(hashes)
        for bucket, bits in answers.items():
            lo, hi = cuts[bucket], cuts[bucket + 1]
            out[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
        return out

    def survivors(self, lengths: list[int], answers: list[dict[int, bytes]]):
        """Replay the filter levels; (last length, alive per position) or None."""
        before = None
        for length, answer in zip(lengths, answers, strict=True):
            at = self.candidates(length, before)
            hashes, index, _ = self.distinct(length, at)
            local = np.bincount(index, minlength=len(hashes)) > 1
            alive = np.zeros(len(self.words), bool)
            alive[at] = (local | self.flags(hashes, answer))[index]
            before = (length, alive)
        return before


def _read(docs: pa.Table, n_buckets: int) -> tuple[_Chunk, np.ndarray, list[bytes]]:
    ids = docs.column("doc_id").to_numpy()
    texts = W.utf8(docs.column("text").combine_chunks())
    return _Chunk(ids, texts, n_buckets), ids, texts


def _by_level(answers: pa.Table | None, n_levels: int) -> list[dict[int, bytes]]:
    out: list[dict[int, bytes]] = [{} for _ in range(n_levels)]
    if answers is not None:
        for level, bucket, bits in zip(
            answers.column("level").to_pylist(),
            answers.column("bucket").to_pylist(),
            answers.column("bits").to_pylist(),
            strict=True,
        ):
            out[level][bucket] = bits
    return out


def _ask(lengths: list[int], level: int, n_buckets: int):
    """Per chunk: the distinct candidate hashes of ``level``, by bucket."""
    last = level == len(lengths) - 1

    def run(docs: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        rows: dict[str, list] = {k: [] for k in ("bucket", "hashes", "owners")}
        if docs.num_rows:
            chunk, _, _ = _read(docs, n_buckets)
            before = chunk.survivors(lengths[:level], _by_level(answers, level))
            at = chunk.candidates(lengths[level], before)
            hashes, _, least = chunk.distinct(lengths[level], at)
            cuts = chunk.cuts(hashes)
            for b in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[b], cuts[b + 1])
                rows["bucket"].append(int(b))
                if last:
                    rows["hashes"].append(hashes[part].tobytes())
                    rows["owners"].append(_pack_ids(least[part]))
                else:
                    rows["hashes"].append(hashes[part].astype(np.uint32).tobytes())
                    rows["owners"].append(b"")
        n = len(rows["bucket"])
        number = docs.column("chunk")[0].as_py() if docs.num_rows else 0
        return pa.table(
            {
                "bucket": pa.array(rows["bucket"], pa.int32()),
                "chunk": pa.array([number] * n, pa.int32()),
                "level": pa.array([level] * n, pa.int32()),
                "hashes": pa.array(rows["hashes"], pa.binary()),
                "owners": pa.array(rows["owners"], pa.binary()),
            }
        )

    if level == 0:
        return lambda docs: run(docs)
    return run


def _pack_ids(ids: np.ndarray) -> bytes:
    """Ids as their least one and 32-bit distances from it where these suffice; a
    leading byte tells which."""
    low = ids.min()
    if int(ids.max()) - int(low) < 2**32:
        return b"d" + low.tobytes() + (ids - low).astype(np.uint32).tobytes()
    return b"w" + ids.tobytes()


def _unpack_ids(packed: bytes) -> np.ndarray:
    if packed[:1] == b"w":
        return np.frombuffer(packed, np.int64, offset=1)
    low = np.frombuffer(packed, np.int64, count=1, offset=1)[0]
    return low + np.frombuffer(packed, np.uint32, offset=9).astype(np.int64)


def _answer_repeated(asks: pa.Table) -> pa.Table:
    """Filter levels: is a hash asked about by more than one chunk?"""
    parts = [np.frombuffer(x, np.uint32) for x in asks.column("hashes").to_pylist()]
    every = np.sort(np.concatenate(parts))
    # A chunk may ask twice about equal low bits; that only lets a candidate through.
    repeated = np.unique(every[1:][every[1:] == every[:-1]])
    return _answers(asks, [_among(p, repeated) for p in parts])


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return wanted[at] == values


def _answer_smaller(asks: pa.Table) -> pa.Table:
    """Last level: has another chunk a smaller document for this hash?"""
    parts = [np.frombuffer(x, W.U64) for x in asks.column("hashes").to_pylist()]
    owners = [_unpack_ids(x) for x in asks.column("owners").to_pylist()]
    hashes, index = np.unique(np.concatenate(parts), return_inverse=True)
    least = np.full(len(hashes), np.iinfo(np.int64).max)
    every = np.concatenate(owners)
    np.minimum.at(least, index, every)
    smaller = least[index] < every
    ends = np.cumsum([0, *(len(p) for p in parts)])
    return _answers(asks, [smaller[a:b] for a, b in zip(ends, ends[1:], strict=False)])


def _answers(asks: pa.Table, bits: list[np.ndarray]) -> pa.Table:
    keep = [i for i, b in enumerate(bits) if b.any()]
    some = asks.take(pa.array(keep, pa.int64()))
    return pa.table(
        {
            "chunk": some.column("chunk"),
            "level": some.column("level"),
            "bucket": some.column("bucket"),
            "bits": pa.array([np.packbits(bits[i]).tobytes() for i in keep], pa.binary()),
        }
    )


def _finish(lengths: list[int], n_buckets: int, digest: bool):
    """Per chunk: remove the covered words."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept")}
        if docs.num_rows:
            chunk, ids, texts = _read(docs, n_buckets)
            told = _by_level(answers, len(lengths))
            before = chunk.survivors(lengths[:-1], told[:-1])
            at = chunk.candidates(lengths[-1], before)
            hashes, index, least = chunk.distinct(lengths[-1], at)
            flagged = chunk.flags(hashes, told[-1])
            gone = at[flagged[index] | (least[index] < chunk.owner[at])]
            edge = np.zeros(len(chunk.words) + 1, np.int64)
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + lengths[-1], -1)
            covered = np.cumsum(edge[:-1]) > 0
            for i, text in enumerate(texts):
                mask = covered[chunk.firsts[i] : chunk.firsts[i + 1]]
                pieces = text.split()
                removed = int(mask.sum())
                if removed:
                    pieces = [w for w, m in zip(pieces, mask.tolist(), strict=True) if not m]
                kept = b" ".join(pieces)
                out["doc_id"].append(None if ids[i] == _MIN_ID else int(ids[i]))
                out["n_words"].append(len(mask))
                out["n_removed"].append(removed)
                out["kept"].append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
        return pa.table(
            {
                "doc_id": pa.array(out["doc_id"], pa.int64()),
                "n_words": pa.array(out["n_words"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "kept": pa.array(out["kept"], pa.string()),
            }
        )

    return run


def dedup_substrings(
    docs: DataFrame,
    window: int = WINDOW_WORDS,
    digest: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_windows: int = BUCKET_WINDOWS,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` per row; ``kept`` is the remaining
    text (words joined by one space), or its SHA-256 with ``digest``."""
    ship(docs.sparkSession)
    text = text_or_empty()
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_chunks = 1 + total // chunk_bytes
    # Words average some six bytes with their separator.
    n_buckets = int(1 + total // 6 // bucket_windows)
    chunked = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_MIN_ID)).alias("doc_id"),
        text.alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int").alias("chunk"),
    )
    lengths = levels(window)
    answers = None
    for level in range(len(lengths)):
        last = level == len(lengths) - 1
        ask = _ask(lengths, level, n_buckets)
        if answers is None:
            asks = chunked.groupBy("chunk").applyInArrow(ask, _ASK)
        else:
            asks = (
                chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(ask, _ASK)
            )
        told = asks.groupBy("bucket").applyInArrow(
            _answer_smaller if last else _answer_repeated, _ANSWER
        )
        answers = told if answers is None else answers.unionByName(told)
    return (
        chunked.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            _finish(lengths, n_buckets, digest),
            "doc_id long, n_words long, n_removed long, kept string",
        )
    )
