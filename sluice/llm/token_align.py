"""Cross-tokenizer alignment by pointer jumping.

Each text, led by a space, is encoded by a byte-level BPE (A) and by a sentencepiece
model (B, which adds that space itself). Tokens are byte ranges. Every token points
to the token that reaches farthest right among itself and those it overlaps (the
token of A on ties): a token of A to the token of B that holds its last byte if that
ends later, else to itself; a token of B to the token of A that holds its last byte.
Following pointers ends at the token of A whose end is an end of B too. All texts of a
batch are nodes of one array, and successor doubling (``next = next[next]``) reaches
these terminal tokens after as many rounds as the logarithm of the longest chain;
the terminal labels the group. Tokens of A and B that end together are linked, and
links are counted per (A id, B id) over the whole corpus.

Texts are encoded in parts of about ``PART_CHARS``, cut before a space that follows
no white space: the byte-level pattern always starts a word there, and no piece of
the model holds a space mark behind another character (checked when it is loaded, else
texts stay whole), so the tokens are those of the whole text and memory stays bounded.

Scale: the texts are encoded once. Documents go out with their links, chunk by chunk
(``CHUNK_BYTES`` of text), with the distinct pairs of the chunk and their counts;
a pair found in every document is one row a chunk. Pairs are summed and ranked per B
id by ordinary aggregates, each chunk gets the totals of its pairs back, and a chunk's
links (bounded by its bytes) are looked up in one task. No table is broadcast by hand.

Defined cases: texts that are null or empty, or whose tokens do not join to the text
led by a space, have no tokens (zeros, no links); special strings in texts are
plain text; repeated rows each get their row and count as often; null ids pass; columns
other than id and text are not read, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.llm import words as W
from sluice.llm.common import ship, stage, text_or_empty

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
#: Texts longer than this are encoded in parts.
PART_CHARS = 1 << 16
#: Text bytes of a chunk of documents (a longer document is a chunk alone).
CHUNK_BYTES = 4 << 20
#: Texts are aligned together in slices of about this many bytes.
SLICE_BYTES = 1 << 20
SPACE_MARK = "▁"
#: Fixed value: the split into words of the byte-level tokenizer.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: What follows an id in the text of the groups: another id of its side, the other
#: side, the next group, nothing.
MARKS = (",", "|", ";", "")
OTHER_SIDE, NEXT_GROUP, LAST = 1, 2, 3
_CUT = re.compile(r"(?<=\S) (?=.)", re.DOTALL)


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1 characters
    stand for themselves, the other bytes for the code points from 256 on."""
    kept = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    others = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers with the bytes of each of their tokens."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_bpe.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=piece_bpe)
        alphabet = byte_alphabet()
        entries = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes: list[bytes | None] = [None] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            known = all(c in alphabet for c in entry)
            self.a_bytes[i] = bytes(alphabet[c] for c in entry) if known else entry.encode()
        self.b_bytes: list[bytes] = []
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for i, piece in enumerate(pieces):
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.b_bytes.append(piece.replace(SPACE_MARK, " ").encode())
        self.a_length = np.array([len(x or b"") for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.cuts = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in pieces)
        #: Decimal ids of A's and then B's tokens, each with all that may follow it.
        ids = [*range(len(self.a_bytes)), *range(len(self.b_bytes))]
        self.words = [f"{i}{mark}" for i in ids for mark in MARKS]
        self.fast = self._same_ranks(byte_bpe)

    def _same_ranks(self, byte_bpe: bytes):
        """The same byte-level BPE as a rank table, which encodes several times faster, if
        the file says that it is one: its merges in the order of the ids they make, behind
        the usual split into words and nothing else."""
        from tiktoken import Encoding

        spec = json.loads(byte_bpe)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE"
            and split.get("type") == "ByteLevel"
            and split.get("use_regex")
            and not split.get("add_prefix_space")
            and not spec.get("normalizer")
            and not any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback",
                                               "continuing_subword_prefix", "end_of_word_suffix"))
        )
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocabulary = model["vocab"]
        if not plain or any(vocabulary[a + b] != 256 + n for n, (a, b) in enumerate(merges)):
            return None
        ranks = {self.a_bytes[i]: i for i in range(256 + len(merges))}
        return Encoding("ranks", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, parts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        out = []
        for part in parts:
            try:
                out.append(self.fast.encode_ordinary(part))
            except BaseException as failed:  # its regular expressions give up on huge words
                if isinstance(failed, (KeyboardInterrupt, SystemExit)):
                    raise
                out.append(self.a.encode(part, add_special_tokens=False).ids)
        return out

    def parts(self, full: str, size: int) -> list[str]:
        """``full`` (led by a space) in parts that each start with a space."""
        if not self.cuts or len(full) <= size:
            return [full]
        out, at = [], 0
        while len(full) - at > size:
            cut = _CUT.search(full, at + size)
            if not cut:
                break
            out.append(full[at : cut.start()])
            at = cut.start()
        return [*out, full[at:]]

    def encode(self, texts: list[str], part: int) -> list[tuple[list[int], list[int]]]:
        """Token ids of A and B of each text; none where they do not join to it."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            if text:
                mine = self.parts(f" {text}", part)
                parts += mine
                owner += [i] * len(mine)
        out: list[tuple[list[int], list[int]]] = [([], []) for _ in texts]
        a_ids = self.encode_a(parts)
        b_ids = self.b.encode([p[1:] for p in parts], num_threads=1)
        broken = set()
        for p, i, a, b in zip(parts, owner, a_ids, b_ids, strict=True):
            raw = p.encode()
            if (
                b"".join(map(self.a_bytes.__getitem__, a)) != raw
                or b"".join(map(self.b_bytes.__getitem__, b)) != raw
            ):
                broken.add(i)
            out[i][0].extend(a)
            out[i][1].extend(b)
        for i in broken:
            out[i] = ([], [])
        return out


@lru_cache(maxsize=2)
def _tokenizers(byte_bpe: bytes, piece_bpe: bytes) -> Tokenizers:
    return Tokenizers(byte_bpe, piece_bpe)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Terminal token of every token (A's first, then B's) by successor doubling.

    Ends are ascending byte offsets; the last ones of A and B must agree.
    """
    n = len(a_ends)
    over = np.searchsorted(b_ends, a_ends)
    own = np.arange(n)
    following = np.concatenate(
        [np.where(b_ends[over] > a_ends, n + over, own), np.searchsorted(a_ends, b_ends)]
    )
    while True:
        farther = following[following]
        if np.array_equal(farther, following):
            return following
        following = farther


def align(texts: list[str], tok: Tokenizers, part: int = PART_CHARS) -> list[tuple]:
    """``n_a, n_b, groups, a ids of links, b ids of links`` per text."""
    encoded = tok.encode(texts, part)
    live = [i for i, (a, b) in enumerate(encoded) if a and b]
    out: list[tuple] = [(0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))] * len(texts)
    if not live:
        return out
    a_all = np.concatenate([np.array(encoded[i][0], np.int64) for i in live])
    b_all = np.concatenate([np.array(encoded[i][1], np.int64) for i in live])
    a_first = np.concatenate([[0], np.cumsum([len(encoded[i][0]) for i in live])])
    b_first = np.concatenate([[0], np.cumsum([len(encoded[i][1]) for i in live])])
    a_ends, b_ends = np.cumsum(tok.a_length[a_all]), np.cumsum(tok.b_length[b_all])
    label = terminals(a_ends, b_ends)
    # A terminal token of A is linked with the token of B that ends with it.
    ends_here = np.flatnonzero(label[: len(a_all)] == np.arange(len(a_all)))
    partner = np.searchsorted(b_ends, a_ends[ends_here])
    link_first = np.searchsorted(ends_here, a_first)
    # Tokens by group, those of A first, and what follows each of them.
    order = np.argsort(label, kind="stable")
    side, sorted_label = order >= len(a_all), label[order]
    mark = np.empty(len(order), np.int64)
    mark[:-1] = np.where(
        sorted_label[1:] != sorted_label[:-1], NEXT_GROUP, np.where(side[1:] != side[:-1], OTHER_SIDE, 0)
    )
    text_first = a_first + b_first
    mark[text_first[1:] - 1] = LAST
    codes = np.concatenate([a_all, b_all + len(tok.a_bytes)])[order] * len(MARKS) + mark
    word_of = tok.words.__getitem__
    for k, i in enumerate(live):
        links = slice(link_first[k], link_first[k + 1])
        out[i] = (
            int(a_first[k + 1] - a_first[k]),
            int(b_first[k + 1] - b_first[k]),
            "".join(map(word_of, codes[text_first[k] : text_first[k + 1]].tolist())),
            a_all[ends_here[links]],
            b_all[partner[links]],
        )
    return out


_DOCUMENT = [
    T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()),
]


def _chunk_rows(schema: pa.Schema, byte_bpe: bytes, piece_bpe: bytes, digest: bool, sizes: tuple):
    """Document rows with links, and behind each chunk one row with its pairs."""
    chunk_bytes, part = sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        # One thread a task: Spark runs a task per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok = _tokenizers(byte_bpe, piece_bpe)
        number, filled, links = TaskContext.get().partitionId() << 32, 0, []

        def summary() -> pa.RecordBatch:
            pairs, counts = np.unique(np.concatenate(links), return_counts=True)
            columns = [pa.array([number], pa.int64())]
            columns += [pa.nulls(1, f.type) for f in list(schema)[1:-2]]
            columns += [pa.array([x], pa.list_(pa.int64())) for x in (pairs, counts)]
            return pa.record_batch(columns, schema)

        for batch in (piece for whole in batches for piece in W.slices(whole, 1, SLICE_BYTES)):
            rows = align(batch.column(1).to_pylist(), tok, part)
            n_a, n_b, groups, a_ids, b_ids = zip(*rows, strict=True)
            packed = [(a << 32) | b for a, b in zip(a_ids, b_ids, strict=True)]
            if digest:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            firsts = np.concatenate([[0], np.cumsum([len(p) for p in packed])])
            flat = np.concatenate(packed)
            yield pa.record_batch(
                [
                    pa.array(np.full(len(rows), number), pa.int64()),
                    batch.column(0),
                    pa.array(n_a, pa.int64()),
                    pa.array(n_b, pa.int64()),
                    pa.array(np.diff(firsts), pa.int64()),
                    pa.array(groups, pa.string()),
                    pa.ListArray.from_arrays(firsts.astype(np.int32), flat),
                    pa.nulls(len(rows), pa.list_(pa.int64())),
                ],
                schema,
            )
            links.append(flat)
            filled += batch.column(1).nbytes
            if filled >= chunk_bytes:
                yield summary()
                number, filled, links = number + 1, 0, []
        if links:
            yield summary()

    return run


def _counted_rows(schema: pa.Schema):
    """Sums over the links of a chunk's documents, from the totals of its pairs."""

    def run(key, docs: pa.Table, totals: pa.Table) -> pa.Table:
        pairs = totals.column("pair").to_numpy()
        order = np.argsort(pairs)
        pairs = pairs[order]
        total = totals.column("total").to_numpy()[order]
        best = totals.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        lists = docs.column("links").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks)
        firsts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        at = np.searchsorted(pairs, lists.flatten().to_numpy())

        def sums(values: np.ndarray) -> pa.Array:
            running = np.concatenate([[0], np.cumsum(values[at])])
            return pa.array(running[firsts[1:]] - running[firsts[:-1]], pa.int64())

        kept = [docs.column(f.name) for f in list(schema)[:-2]]
        return pa.table([*kept, sums(best), sums(total)], schema)

    return run


def pair_counts(staged: DataFrame) -> DataFrame:
    """``pair, total, best``: links that hold a pair, and whether no pair of its B id
    has more."""
    pairs = staged.filter("pair_counts is not null").select(
        F.explode(F.arrays_zip(F.col("links").alias("pair"), F.col("pair_counts").alias("n"))).alias("p")
    )
    counts = stage(pairs.groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.n").alias("total")), "pair-totals")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    most = counts.groupBy(b_id).agg(F.max("total").alias("most"))
    return (
        counts.withColumn("b", b_id)
        .join(most, "b")
        .select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    )


def align_documents(
    docs: DataFrame,
    byte_bpe: str = BYTE_BPE,
    piece_bpe: str = PIECE_BPE,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """``<id_col>, n_a, n_b, n_groups, groups, n_links, n_best, count_sum`` per document.

    ``groups`` lists the ids of each group (``a1,a2|b1;a3|b2,b3``), or its SHA-256 with
    ``digest``.
    """
    ship(docs.sparkSession)
    with open(byte_bpe, "rb") as a, open(piece_bpe, "rb") as b:
        models = a.read(), b.read()
    id_field = T.StructField("id", docs.schema[id_col].dataType)
    document = [id_field, *_DOCUMENT, T.StructField("groups", T.StringType())]
    staged_schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            *document,
            T.StructField("links", T.ArrayType(T.LongType())),
            T.StructField("pair_counts", T.ArrayType(T.LongType())),
        ]
    )
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    run = _chunk_rows(
        to_arrow_schema(staged_schema), *models, digest, (chunk_bytes, part_chars)
    )
    staged = stage(rows.mapInArrow(run, staged_schema), "token-links")
    totals = (
        staged.filter("pair_counts is not null")
        .select(F.col("chunk").alias("of_chunk"), F.explode("links").alias("pair"))
        .join(pair_counts(staged), "pair")
    )
    result = T.StructType(
        [*document, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
    )
    counted = (
        staged.filter("pair_counts is null")
        .drop("pair_counts")
        .groupBy("chunk")
        .cogroup(totals.groupBy("of_chunk"))
        .applyInArrow(_counted_rows(to_arrow_schema(result)), result)
    )
    return counted.select(
        F.col("id").alias(id_col),
        *[f.name for f in _DOCUMENT],
        "groups",
        # Tokens that end together end a group: one link each.
        F.col("n_groups").alias("n_links"),
        "n_best",
        "count_sum",
    )
