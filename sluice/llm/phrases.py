"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into a hierarchy of phrases. At each level, runs of one
name become one name (name and length), so that neighbours differ; deterministic
coin tossing then colours the names: a name's label is the lowest bit in which it
differs from its left neighbour, and that bit's value, which after four rounds
leaves six labels and after one recolouring step per surplus label three. Where a
label is a local maximum a phrase begins, so phrases have two to four names inside
a text, and where they begin depends on a dozen neighbouring names only. A phrase is
named by the hash of its names, so names mean the same in every document, and equal
substrings are cut into equal phrases but near their ends, wherever they stand.

A fingerprint is a MinHash signature over the phrase names of levels 1 to 4 (some 2,
6, 14 and 33 bytes; ``SLOTS`` per level), a byte a slot, as hexadecimal text. The
likeness of two fingerprints is their share of equal slots, corrected for bytes
that agree by chance; it estimates how many of both texts' phrases are common.

:func:`edited_pairs` compares each document with an edited text, whose end comes from
the next document in descending order of id. Documents are range-partitioned and
sorted by id, so next documents stand next to each other; only the last row of each
partition waits for the first row of the following one, and these edge rows, two per
partition, are joined on the partition number. One shuffle of the texts, no matter
how they are skewed: rows that share an id are ordered by a hash of their text, then
by position, so they spread over partitions too.

Defined cases: null text is empty; an empty text's fingerprint is the empty string,
like another empty one (1.0) and unlike all else (0.0); null ids come last; rows that
share an id follow each other in the order of a hash of their texts; the only
document is its own next; columns other than id and text are not read, whatever
their names; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.llm import words as W
from sluice.llm.common import ship, stage, text_or_empty

U64 = np.uint64
#: Signature slots of each level of the hierarchy (levels without slots are left out).
SLOTS = {1: 16, 2: 48, 3: 48, 4: 16}
N_SLOTS = sum(SLOTS.values())
_rng = np.random.Generator(np.random.PCG64(11))
_BYTE_NAMES = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_FACTORS = _rng.integers(0, 2**63, N_SLOTS, dtype=np.uint64) * U64(2) + U64(1)
_SHIFTS = _rng.integers(0, 2**64, N_SLOTS, dtype=np.uint64)
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, U64), dtype=np.uint64)
#: Texts are parsed together in pieces of about this many bytes.
PIECE_BYTES = 1 << 19
_NONE = 7


def _coin_table() -> np.ndarray:
    """Next label by (left label, own label), both below 128."""
    left, own = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    differ = left ^ own
    bit = np.bitwise_count((differ & -differ) - 1) * (differ > 0)
    return (2 * bit + ((own >> bit) & 1)).astype(np.uint8).ravel()


def _free_table() -> np.ndarray:
    """Smallest of the labels 0 to 2 that neither neighbour has."""
    return np.array(
        [[min({0, 1, 2} - {a, b}) for b in range(8)] for a in range(8)], np.uint8
    )


_COINS, _FREE = _coin_table(), _free_table()


def labels_of(names: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Three labels such that neighbours differ; ``names`` of neighbours must differ.

    ``firsts`` holds the first position of each text and the number of names.
    """
    heads, tails = firsts[:-1], firsts[1:] - 1
    differ = names[1:] ^ names[:-1]
    bit = np.minimum(np.bitwise_count((differ & (~differ + U64(1))) - U64(1)), 63).astype(U64)
    out = np.empty(len(names), np.uint8)
    out[1:] = U64(2) * bit + ((names[1:] >> bit) & U64(1))
    out[heads] = (names[heads] & U64(1)).astype(np.uint8)
    for _ in range(3):
        start = out[heads] & 1
        out[1:] = _COINS[(out[:-1].astype(np.uint16) << np.uint16(7)) | out[1:]]
        out[heads] = start
    padded = np.concatenate([[_NONE], out, [_NONE]]).astype(np.uint8)
    is_head = np.zeros(len(out), bool)
    is_head[heads] = True
    is_tail = np.zeros(len(out), bool)
    is_tail[tails] = True
    for surplus in (5, 4, 3):
        at = np.flatnonzero(padded[1:-1] == surplus)
        left = np.where(is_head[at], _NONE, padded[at])
        right = np.where(is_tail[at], _NONE, padded[at + 2])
        padded[at + 1] = _FREE[left, right]
    return padded[1:-1]


def phrase_starts(names: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """First positions of all phrases: text starts, and local maxima of the labels
    that are not next to a text start."""
    labels = labels_of(names, firsts)
    rises = np.zeros(len(names) + 1, bool)
    rises[1:-1] = labels[1:] > labels[:-1]
    heads = firsts[:-1]
    # Neither neighbour text counts: a first name does not rise, a last one falls.
    rises[heads] = False
    starts = rises[:-1] & ~rises[1:]
    seconds = heads + 1
    starts[seconds[seconds < firsts[1:]]] = False
    starts[heads] = True
    return np.flatnonzero(starts)


def _runs(names: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one name as one name."""
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    new[firsts[:-1]] = True
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(names)))
    out = names[at]
    many = size > 1
    out[many] = W.mix(out[many] + size[many].astype(U64) * U64(0xD6E8FEB86659FD93))
    return out, np.searchsorted(at, firsts)


def levels_of(data: np.ndarray, firsts: np.ndarray, levels: int) -> Iterator[tuple]:
    """``level, names, firsts`` of the phrases of each level; no text may be empty."""
    names = _BYTE_NAMES[data]
    for level in range(1, levels + 1):
        names, firsts = _runs(names, firsts)
        starts = phrase_starts(names, firsts)
        place = np.arange(len(names)) - np.repeat(starts, np.diff(np.append(starts, len(names))))
        sums = np.add.reduceat(names * _POWERS[place], starts)
        names, firsts = W.mix(sums + U64(level)), np.searchsorted(starts, firsts)
        yield level, names, firsts


def _piece_signatures(texts: list[bytes]) -> np.ndarray:
    """Signatures (one row of bytes per text) of texts that are not empty."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    firsts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    out, slot = np.empty((len(texts), N_SLOTS), np.uint8), 0
    for level, names, starts in levels_of(data, firsts, max(SLOTS)):
        for _ in range(SLOTS.get(level, 0)):
            least = np.minimum.reduceat(names * _FACTORS[slot] + _SHIFTS[slot], starts[:-1])
            out[:, slot] = W.mix(least) & U64(0xFF)
            slot += 1
    return out


def signatures(texts: list[bytes]) -> np.ndarray:
    """One row of ``N_SLOTS`` bytes per text; zeros for an empty one."""
    out = np.zeros((len(texts), N_SLOTS), np.uint8)
    full = [i for i, t in enumerate(texts) if t]
    at = 0
    while at < len(full):
        stop, size = at, 0
        while stop < len(full) and (stop == at or size + len(texts[full[stop]]) <= PIECE_BYTES):
            size += len(texts[full[stop]])
            stop += 1
        out[full[at:stop]] = _piece_signatures([texts[i] for i in full[at:stop]])
        at = stop
    return out


def as_bytes(signature: np.ndarray, empty: bool) -> bytes:
    """A signature as it is staged; none for an empty text. Its fingerprint is its
    hexadecimal form."""
    return b"" if empty else signature.tobytes()


def likeness(a: np.ndarray, b: np.ndarray, a_empty: np.ndarray, b_empty: np.ndarray) -> np.ndarray:
    """Likeness of rows of signatures, 0 to 1."""
    share = (a == b).mean(axis=1)
    corrected = np.maximum(0.0, (share - 1 / 256) / (1 - 1 / 256))
    return np.where(a_empty & b_empty, 1.0, np.where(a_empty | b_empty, 0.0, corrected))


def fingerprint(text: str | None) -> str:
    """Fingerprint of one text."""
    raw = (text or "").encode()
    return as_bytes(signatures([raw])[0], not raw).hex()


def edit(text: str, following: str) -> str:
    """The text with its last half replaced by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, fingerprint`` of every document; one narrow pass."""
    ship(docs.sparkSession)
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fingerprint", T.StringType())]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, 1)):
            texts = W.utf8(batch.column(1))
            marks = [as_bytes(s, not t).hex() for s, t in zip(signatures(texts), texts, strict=True)]
            yield pa.record_batch([batch.column(0), pa.array(marks, pa.string())], arrow)

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


#: What is staged per document, digests and signatures as bytes.
_RESULT = T.StructType(
    [
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.BinaryType()),
        T.StructField("fingerprint", T.BinaryType()),
        T.StructField("edited_fingerprint", T.BinaryType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def _compared(ids: pa.Array, texts: list[str], following: list[str]) -> list[pa.Array]:
    """Result columns of documents and their next ones."""
    edited = [edit(t, f) for t, f in zip(texts, following, strict=True)]
    raw = [[t.encode() for t in side] for side in (texts, edited, following)]
    # A next document is usually a document of the list as well.
    known = {t: i for i, t in enumerate(raw[0])}
    others = [t for t in dict.fromkeys(raw[2]) if t not in known]
    sigs = signatures([*raw[0], *raw[1], *others])
    n = len(texts)
    known |= {t: 2 * n + i for i, t in enumerate(others)}
    own, changed = sigs[:n], sigs[n : 2 * n]
    nexts = sigs[[known[t] for t in raw[2]]] if n else own
    empty = [np.array([not t for t in side], bool) for side in raw]
    columns = [
        [len(t) for t in texts],
        [hashlib.sha256(t).digest() for t in raw[1]],
        [as_bytes(s, e) for s, e in zip(own, empty[0], strict=True)],
        [as_bytes(s, e) for s, e in zip(changed, empty[1], strict=True)],
        likeness(own, changed, empty[0], empty[1]),
        likeness(own, nexts, empty[0], empty[2]),
    ]
    types = [f.type for f in to_arrow_schema(_RESULT)]
    return [ids, *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]]


def _sorted_rows(schema: pa.Schema):
    """Compares neighbours of a sorted partition; first and last row become edges."""
    blank = [pa.nulls(1, f.type) for f in to_arrow_schema(_RESULT)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting = None

        def edge(side: str, row: pa.RecordBatch) -> pa.RecordBatch:
            where = [pa.array([part], pa.int64()), pa.array([side])]
            return pa.record_batch([row.column(0), *blank, *where, row.column(1)], schema)

        for batch in (piece for whole in batches for piece in W.slices(whole, 1)):
            if waiting is None:
                yield edge("first", batch.slice(0, 1))
                rows = batch
            else:
                rows = pa.concat_batches([waiting, batch])
            waiting = rows.slice(rows.num_rows - 1)
            texts = rows.column(1).to_pylist()
            n = rows.num_rows - 1
            done = _compared(rows.column(0).slice(0, n), texts[:-1], texts[1:])
            yield pa.record_batch(
                [*done, pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())],
                schema,
            )
        if waiting is not None:
            yield edge("last", waiting)

    return run


def _edge_rows(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, following = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            yield pa.record_batch(_compared(batch.column(0), texts, following), schema)

    return run


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next`` per document; the next document is that of the next smaller id."""
    ship(docs.sparkSession)
    id_field = T.StructField("id", docs.schema[id_col].dataType)
    result = T.StructType([id_field, *_RESULT.fields])
    staged = T.StructType(
        [
            *result.fields,
            T.StructField("part", T.LongType()),
            T.StructField("side", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    order = [F.col("id").desc_nulls_last(), F.col("route"), F.col("place")]
    rows = (
        docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
        .withColumns({"route": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("id", "text")
    )
    done = stage(rows.mapInArrow(_sorted_rows(to_arrow_schema(staged)), staged), "phrase-pairs")
    # Edges: two rows for each partition that has rows; the order of the parts is a
    # window over as many numbers.
    firsts = done.filter("side = 'first'").select("part", F.col("text").alias("following"))
    lasts = done.filter("side = 'last'").select("id", "text", "part")
    ring = Window.orderBy("part")
    parts = firsts.select("part").select(
        "part", F.lead("part").over(ring).alias("later"), F.min("part").over(Window.partitionBy()).alias("lowest")
    )
    after = parts.select("part", F.coalesce("later", "lowest").alias("next_part"))
    edges = (
        lasts.join(after, "part")
        .join(firsts.withColumnRenamed("part", "next_part"), "next_part")
        .select("id", "text", "following")
        .mapInArrow(_edge_rows(to_arrow_schema(result)), result)
    )
    inner = done.filter("side is null").select(*result.fieldNames())
    return inner.unionByName(edges).select(
        F.col("id").alias(id_col),
        *[
            F.lower(F.hex(f.name)).alias(f.name) if f.dataType == T.BinaryType() else F.col(f.name)
            for f in _RESULT.fields
        ],
    )
