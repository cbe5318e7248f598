"""Benchmark decontamination by winnowing.

Documents and benchmark items are hashed into word k-grams; of each run of
``w`` neighbouring k-grams the smallest hash (the rightmost on ties) is kept as
a fingerprint. Two texts that share ``w + k - 1`` words share a fingerprint, so
with k + w - 1 = 13 no shared 13-word window is missed. Fingerprints are joined,
and every document with a hit is extended: all its words inside any occurrence
of an item window are marked, on the whole text.

Items of fewer than 13 words are one window each; they are fingerprinted by
their own, shorter guarantee (the largest power of two not above their length),
and documents produce fingerprints of that guarantee only if such items exist.

Scale: a document leaves about a fifth of its words as 64-bit fingerprints,
exploded and joined in the JVM; Spark broadcasts the benchmark side when its
size allows, otherwise the join shuffles and splits hot fingerprints. Nothing
is collected on the driver but the few guarantees in use (at most five).

Defined cases: null text has no words (n_hit 0, not contaminated); an item
without words never occurs; an item without an id counts as one, and adds no id to the
list; items that repeat id and text are one; repeated rows each get their row; extra columns
pass through :func:`mark_contamination`; empty documents or benchmark give
empty or clean results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.llm import words as W
from sluice.llm.common import ship

WINDOW_WORDS = 13
#: A document is contaminated when 1 in this many of its words is hit.
HIT_SHARE = 20


def guarantee_of(n_words: int, window: int = WINDOW_WORDS) -> int:
    """Shared length that fingerprints must catch for an item of ``n_words``."""
    return window if n_words >= window else 1 << (n_words.bit_length() - 1)


def gram_of(guarantee: int) -> tuple[int, int]:
    """(k, w) with k + w - 1 = guarantee; about 40 % of it as the k-gram."""
    k = guarantee if guarantee <= 2 else max(2, (2 * guarantee) // 5)
    return k, guarantee - k + 1


def winnow(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions of the minima (rightmost on ties) of all runs of ``w`` hashes."""
    if len(grams) < w or w <= 0:
        return np.empty(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(grams[::-1], w)
    # Reversed, the first minimum is the rightmost one.
    at = runs.argmin(axis=1) + np.arange(len(runs))
    return np.unique(len(grams) - 1 - at)


def fingerprints(words: np.ndarray, guarantee: int) -> np.ndarray:
    """Distinct fingerprints of one text at a guarantee."""
    k, w = gram_of(guarantee)
    grams = W.window_hashes(words, k)
    return np.unique(grams[winnow(grams, w)])


def _batch_fingerprints(hashes: np.ndarray, firsts: np.ndarray, guarantee: int):
    """Fingerprints of many texts at once: values and the owner of each."""
    k, w = gram_of(guarantee)
    grams = W.window_hashes(hashes, k)
    starts = W.inside_one_text(firsts, guarantee)
    if not len(starts):
        return np.empty(0, W.U64), np.empty(0, np.int64)
    best, value = starts + (w - 1), grams[starts + (w - 1)].copy()
    for back in range(w - 2, -1, -1):
        less = grams[starts + back] < value
        value[less] = grams[starts + back][less]
        best[less] = starts[less] + back
    picked = np.unique(best)
    return grams[picked], W.owner_of(firsts)[picked]


def _fingerprint_rows(guarantees: list[int]):
    schema = pa.schema([("key", pa.int64()), ("g", pa.int32()), ("fps", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, 1)):
            hashes, firsts = W.word_hashes(W.utf8(batch.column(1)), W.ALPHANUMERIC, lower=True)
            for g in guarantees:
                values, owner = _batch_fingerprints(hashes, firsts, g)
                counts = np.bincount(owner, minlength=len(firsts) - 1)
                lists = pa.ListArray.from_arrays(
                    np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), values.view(np.int64)
                )
                yield pa.record_batch(
                    [batch.column(0), pa.array(np.full(len(lists), g, np.int32)), lists], schema
                )

    return run


def _item_rows(window: int):
    schema = pa.schema(
        [
            ("key", pa.int64()),
            ("item_id", pa.int64()),
            ("n_words", pa.int32()),
            ("g", pa.int32()),
            ("fps", pa.list_(pa.int64())),
            ("grams", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, firsts = W.word_hashes(W.utf8(batch.column(1)), W.ALPHANUMERIC, lower=True)
            rows = []
            items = zip(batch.column(2).to_pylist(), batch.column(0).to_pylist(), strict=True)
            for i, (key, item) in enumerate(items):
                own = hashes[firsts[i] : firsts[i + 1]]
                if len(own):
                    g = guarantee_of(len(own), window)
                    fps = fingerprints(own, g).view(np.int64).tolist()
                    grams = np.unique(W.window_hashes(own, min(window, len(own))))
                    rows.append((key, item, len(own), g, fps, grams.view(np.int64).tolist()))
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
                if rows
                else [pa.array([], f.type) for f in schema],
                schema,
            )

    return run


def _mark_rows(schema: pa.Schema, window: int, text_at: int):
    """Adds counts to the carried columns; the last column in holds the items."""
    n_carried = len(schema) - 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, text_at)):
            carried, text, items_of = batch.columns[:n_carried], batch.columns[text_at], batch.columns[-1]
            hashes, firsts = W.word_hashes(W.utf8(text), W.ALPHANUMERIC, lower=True)
            n_words = np.diff(firsts)
            n_hit = np.zeros(len(n_words), np.int64)
            found: list[list[int]] = [[] for _ in n_words]
            for i in np.flatnonzero(items_of.is_valid().to_numpy(zero_copy_only=False)):
                own = hashes[firsts[i] : firsts[i + 1]]
                n_hit[i], found[i] = mark_one(own, items_of[i].as_py(), window)
            added = [pa.array(n_words.astype(np.int64)), pa.array(n_hit)]
            yield pa.record_batch(
                [*carried, *added, pa.array(found, pa.list_(pa.int64()))], schema
            )

    return run


def mark_one(words: np.ndarray, items: list[dict], window: int) -> tuple[int, list[int]]:
    """Hit words of one document and the ids of the items that occur in it."""
    if not items or not len(words):
        return 0, []
    edge = np.zeros(len(words) + 1, np.int64)
    ids = []
    by_length: dict[int, np.ndarray] = {}
    for item in items:
        length = min(window, item["n_words"])
        if length not in by_length:
            by_length[length] = W.window_hashes(words, length)
        at = np.flatnonzero(np.isin(by_length[length], np.array(item["grams"], np.int64).view(W.U64)))
        if len(at):
            ids.append(item["item_id"])
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum()), ids


def mark_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    carry: list[str] | None = None,
) -> DataFrame:
    """The documents with ``_n_words, _n_hit, _items, _contaminated``.

    ``carry`` names the input columns to keep (default: all).
    """
    ship(docs.sparkSession)
    items = (
        # An item is told by its id (null among them) and its text; repeated rows are one.
        benchmark.select(
            F.col("item_id").cast("long").alias("item_id"),
            "text",
            F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text").alias("key"),
        )
        .dropDuplicates(["key"])
        .mapInArrow(
            _item_rows(window),
            "key long, item_id long, n_words int, g int, fps array<long>, grams array<long>",
        )
    )
    guarantees = sorted(r.g for r in items.select("g").distinct().collect())
    columns = [f for f in docs.schema.fields if carry is None or f.name in carry]
    found = T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("n_words", T.IntegerType()),
            T.StructField("grams", T.ArrayType(T.LongType())),
        ]
    )
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    if guarantees:
        item_fps = items.select(F.col("key").alias("item"), "g", F.explode("fps").alias("fp"))
        pairs = (
            keyed.select("_key", "text")
            .mapInArrow(_fingerprint_rows(guarantees), "key long, g int, fps array<long>")
            .select("key", "g", F.explode("fps").alias("fp"))
            .join(item_fps, ["g", "fp"])
            .select("key", "item")
            .distinct()
        )
        hits = (
            pairs.join(items.select(F.col("key").alias("item"), "item_id", "n_words", "grams"), "item")
            .groupBy("key")
            .agg(F.collect_list(F.struct("item_id", "n_words", "grams")).alias("_found"))
        )
        keyed = keyed.join(hits.withColumnRenamed("key", "_key"), "_key", "left")
    else:
        keyed = keyed.withColumn("_found", F.lit(None).cast(T.ArrayType(found)))
    out_schema = T.StructType(
        [
            *columns,
            T.StructField("_n_words", T.LongType()),
            T.StructField("_n_hit", T.LongType()),
            T.StructField("_items", T.ArrayType(T.LongType())),
        ]
    )
    names = [f.name for f in columns]
    sent = names if "text" in names else [*names, "text"]
    mark = _mark_rows(to_arrow_schema(out_schema), window, sent.index("text"))
    marked = keyed.select(*[F.col(f"`{n}`") for n in sent], "_found").mapInArrow(mark, out_schema)
    return marked.withColumn(
        "_contaminated",
        (F.col("_n_hit") > 0) & (F.col("_n_hit") * HIT_SHARE >= F.col("_n_words")),
    )
