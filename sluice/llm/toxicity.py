"""Toxicity by compression distance.

Two zstandard dictionaries are trained from labelled text: one on ordinary
windows, and one of the cues in which toxic text departs from ordinary text
(parts of words around byte 5-grams; the share of documents that use a gram once,
or three times, is tied to the label by a likelihood-ratio test). A window of eight words is compressed once with the
ordinary dictionary and once with the ordinary dictionary followed by the toxic
one: both know ordinary text alike, so the difference in length is what the
toxic dictionary alone saves. A document's window differences (their mean, the
largest ones, and how many reach each threshold) go through a logistic
calibration to a score in [0, 1], weighted to the label shares of the data.

Dictionaries are learnt from a bounded sample of labelled documents (``TOXIC_DOCS``,
``ORDINARY_DOCS``), from at most ``SAMPLE_WINDOWS`` evenly spaced windows of each. The
sample is halved: each half gives a pair of dictionaries, which is calibrated on the other
half, so no document is judged by a dictionary that has seen it, and scoring uses the very
dictionaries that were calibrated (dictionaries learnt from the whole sample would hold more
cues and save more than the calibration knows). A score is the mean log-odds of both pairs.
Calibration features are computed in tasks, from whole texts as in scoring. Scoring reads
every whole text, uses nothing but the text, and is one pass without a shuffle.

Defined cases: null or empty text is one empty window; documents without a
label are scored only; labels of rows that repeat are merged by their largest
value, null labels ignored; if a class has no sample, every score is the share
of toxic labels; a null id hashes as the empty string; extra columns pass
through :func:`score_documents`; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.llm.common import ship
from sluice.llm.words import slices, utf8

WINDOW_WORDS = 8
GRAM = 5
#: Bounds of the learning sample.
TOXIC_DOCS, ORDINARY_DOCS, SAMPLE_WINDOWS = 1000, 2000, 512
ORDINARY_BYTES, TOXIC_BYTES = 16384, 4096
#: A gram is a cue if documents with so many uses of it are over ``CUE_TIMES`` times as
#: frequent among toxic ones, with a likelihood ratio of ``CUE_RATIO``.
CUE_USES, CUE_TIMES, CUE_RATIO = (1, 3), 5, 20
#: A score from here on predicts label 1.
PREDICT_FROM = 0.3
#: zstd looks for no match in the last bytes of its input; this keeps them free.
_TAIL = bytes(range(1, 13))
_STEPS = (2, 3, 4, 5, 6)
N_FEATURES = 4 + 2 * len(_STEPS)


def windows(text: bytes) -> list[bytes]:
    """Windows of ``WINDOW_WORDS`` words; one empty window for an empty text."""
    w = text.split()
    return [
        b" " + b" ".join(w[i : i + WINDOW_WORDS]) + b" " for i in range(0, len(w), WINDOW_WORDS)
    ] or [b""]


@dataclass(frozen=True)
class Half:
    """Dictionaries of one half of the sample and their calibration on the other."""

    ordinary: bytes
    toxic: bytes
    center: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        z = (features - self.center) / self.spread
        return np.clip(z @ self.weights[:-1] + self.weights[-1], -30, 30)


@dataclass(frozen=True)
class Model:
    """Both halves, or none where a class has no sample; small enough to travel with each task."""

    halves: tuple[Half, ...]
    prior: float


class Scorer:
    """Scores of documents as lists of all their windows."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.compressors = [Compressor(h.ordinary, h.toxic) for h in model.halves]

    def scores(self, docs: list[list[bytes]]) -> np.ndarray:
        if not self.compressors or not docs:
            return np.full(len(docs), self.model.prior)
        odds = [
            half.log_odds(np.array([pair.features(parts) for parts in docs]))
            for half, pair in zip(self.model.halves, self.compressors, strict=True)
        ]
        return 1 / (1 + np.exp(-np.mean(odds, axis=0)))


class Compressor:
    """Window length differences under a pair of dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.pair = [_compressor(ordinary), _compressor(ordinary + toxic)]

    def features(self, parts: list[bytes]) -> np.ndarray:
        plain, toxic = self.pair
        saved = np.array(
            [len(plain.compress(p + _TAIL)) - len(toxic.compress(p + _TAIL)) for p in parts]
        )
        top = np.sort(saved)[::-1]
        counts = [(saved >= s).sum() for s in _STEPS]
        return np.array(
            [
                saved.mean(),
                top[0],
                top[:2].mean(),
                top[:4].mean(),
                *np.log1p(counts),
                *(c / len(saved) for c in counts),
            ]
        )


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_checksum=0,
        write_content_size=0,
        write_dict_id=0,
        window_log=17,
        chain_log=17,
        hash_log=17,
        search_log=4,
        min_match=5,
        target_length=16,
        strategy=zstandard.STRATEGY_DFAST,
    )
    if len(content) < 8:
        return zstandard.ZstdCompressor(compression_params=params)
    content = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=params)


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def _words(parts: list[bytes]) -> Counter:
    """Uses of each word, between spaces."""
    return Counter(b" " + w + b" " for p in parts for w in p.split())


def _grams(words: Counter) -> Counter:
    """Uses of each byte gram: words that hold it."""
    out: Counter = Counter()
    for w, n in words.items():
        for g in {w[i : i + GRAM] for i in range(len(w) - GRAM + 1)}:
            out[g] += n
    return out


def typical_grams(toxic: list[Counter], ordinary: list[Counter]) -> set[bytes]:
    """Grams that documents use ``n`` or more times, for an ``n`` of ``CUE_USES``, so
    much oftener when toxic that a likelihood-ratio test ties them to the label.

    Rates are of documents with that many uses, not of presence: a cue that ordinary
    documents of its language use once or twice is found all the same.
    """
    n_t, n_o = len(toxic), len(ordinary)
    in_t = {n: Counter() for n in CUE_USES}
    in_o = {n: Counter() for n in CUE_USES}
    for docs, found in ((toxic, in_t), (ordinary, in_o)):
        for doc in docs:
            for gram, uses in _grams(doc).items():
                # Only grams that toxic text has matter.
                if docs is toxic or gram in in_t[CUE_USES[0]]:
                    for n in CUE_USES:
                        if uses >= n:
                            found[n][gram] += 1

    def typical(t: int, o: int) -> bool:
        if t < 3 or t * n_o <= CUE_TIMES * o * n_t:
            return False
        expected = (t + o) * n_t / (n_t + n_o)
        ratio = 2 * t * math.log(t / expected)
        if o:
            ratio += 2 * o * math.log(o / (t + o - expected))
        return ratio >= CUE_RATIO

    return {g for n in CUE_USES for g, t in in_t[n].items() if typical(t, in_o[n][g])}


def _extended(part: bytes, words: Counter) -> bytes:
    """The part of a word, grown by a byte as long as most uses of it have that byte."""
    uses = sum(n for w, n in words.items() if part in w)
    while True:
        longer: Counter = Counter()
        for w, n in words.items():
            at = w.find(part)
            if at >= 0:
                if at + len(part) < len(w):
                    longer[w[at : at + len(part) + 1]] += n
                if at > 0:
                    longer[w[at - 1 : at + len(part)]] += n
        most = max(longer.items(), key=lambda x: (x[1], x[0]), default=(b"", 0))
        if not most[1] or 2 * most[1] < uses:
            return part
        part = most[0]


def cues(toxic: list[Counter], ordinary: list[Counter]) -> list[bytes]:
    """Parts of words that are typical of toxic documents, the most used last (nearest
    to the text and cheapest to refer to)."""
    marked = typical_grams(toxic, ordinary)
    words: Counter = Counter()
    found: Counter = Counter()
    for w, n in sum(toxic, Counter()).items():
        spans: list[list[int]] = []
        for i in range(len(w) - GRAM + 1):
            if w[i : i + GRAM] in marked:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + GRAM
                else:
                    spans.append([i, i + GRAM])
        if spans:
            words[w] = n
        for a, b in spans:
            found[w[a:b]] += n
    out: Counter = Counter()
    for part, n in found.items():
        out[_extended(part, words)] += n
    kept = [c for c in out if not any(c in other for other in out if other != c)]
    return sorted(kept, key=lambda c: (out[c], c))


def dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> tuple[bytes, bytes]:
    """The ordinary dictionary is trained without words that hold a cue: ordinary text
    may use one now and then, and the toxic dictionary must be what saves its bytes."""
    found = cues([_words(doc) for doc in toxic], [_words(doc) for doc in ordinary])
    holds = re.compile(b"|".join(map(re.escape, found))) if found else None
    plain = []
    for doc in ordinary:
        for part in doc:
            if holds and holds.search(part):
                words = (b" " + w + b" " for w in part.split())
                part = b" " + b" ".join(w[1:-1] for w in words if not holds.search(w)) + b" "
            plain.append(part)
    return _trained(ORDINARY_BYTES, plain), b"".join(found)[-TOXIC_BYTES:]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3):
    """Centre, spread and weights (intercept last) of a regularised logistic fit."""
    center, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.c_[(x - center) / spread, np.ones(len(x))]
    w, total = np.zeros(z.shape[1]), weight.sum()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ ((p - y) * weight) / total + l2 * np.r_[w[:-1], 0]
        hess = (z * (p * (1 - p) * weight)[:, None]).T @ z / total + l2 * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return center, spread, w


def half_dictionaries(toxic: list, ordinary: list) -> list[tuple[bytes, bytes]]:
    """A pair of dictionaries from either half of the sample."""
    return [dictionaries(toxic[half::2], ordinary[half::2]) for half in (0, 1)]


def calibrated(pair: tuple[bytes, bytes], x: np.ndarray, y: np.ndarray, share: float) -> Half:
    """A pair with its calibration on features ``x`` of documents it was not learnt from."""
    weight = np.where(y == 1, share / y.sum(), (1 - share) / (1 - y).sum())
    return Half(*pair, *logistic(x, y, weight))


def fit(toxic: list[list[bytes]], ordinary: list[list[bytes]], share: float) -> Model:
    """Model from documents as lists of all their windows; ``share`` of labels is toxic."""
    if len(toxic) < 2 or len(ordinary) < 2:
        return Model((), share)
    halves = []
    for half, pair in enumerate(half_dictionaries(toxic, ordinary)):
        here, x, y = Compressor(*pair), [], []
        for label, docs in ((1, toxic[1 - half :: 2]), (0, ordinary[1 - half :: 2])):
            x += [here.features(doc) for doc in docs]
            y += [label] * len(docs)
        halves.append(calibrated(pair, np.array(x), np.array(y), share))
    return Model(tuple(halves), share)


def held_out(doc_id: Column) -> Column:
    """Rows that learning must not see: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from a bounded sample of the labelled rows that are not held out."""
    ship(docs.sparkSession)
    seen = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .filter(~held_out(F.col("doc_id")))
    )
    counts = {r["toxic"]: r["n"] for r in seen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sample = []
    for label, most in ((1, TOXIC_DOCS), (0, ORDINARY_DOCS)):
        sample += (
            seen.filter(F.col("toxic") == label)
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(most)
            .collect()
        )
    if not sample:
        return Model((), 0.0)
    # At most TOXIC_DOCS + ORDINARY_DOCS ids: safe to broadcast. An id that several texts
    # share is learnt from one of them, so the rows are as many.
    ids = docs.sparkSession.createDataFrame(sample, "doc_id long, toxic int")
    rows = (
        _texts_of(docs, ids)
        .select("doc_id", "toxic", "text")
        .mapInArrow(_sample_rows, "doc_id long, toxic int, parts array<binary>")
        .collect()
    )
    by_label: dict[int, dict] = {1: {}, 0: {}}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["parts"])):
        # Copies of one text are one sample.
        by_label[r["toxic"]].setdefault(tuple(bytes(p) for p in r["parts"]), r["doc_id"])
    total = counts.get(0, 0) + counts.get(1, 0)
    share = counts.get(1, 0) / total
    toxic, ordinary = ([list(k) for k in by_label[label]] for label in (1, 0))
    if len(toxic) < 2 or len(ordinary) < 2:
        return Model((), share)
    # Calibration features come from whole texts, as in scoring, by the dictionaries of
    # the half that a document is not in.
    halves = [
        (doc_id, label, 1 - n % 2) for label in (1, 0) for n, doc_id in enumerate(by_label[label].values())
    ]
    chosen = docs.sparkSession.createDataFrame(halves, "doc_id long, toxic int, half int")
    pairs = half_dictionaries(toxic, ordinary)

    def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = [Compressor(*pair) for pair in pairs]
        for whole in batches:
            for batch in slices(whole, 3):
                x = [
                    compressors[half].features(windows(text)).tolist()
                    for half, text in zip(batch.column(2).to_pylist(), utf8(batch.column(3)), strict=True)
                ]
                yield pa.record_batch(
                    [*batch.columns[:3], pa.array(x, pa.list_(pa.float64()))],
                    ["doc_id", "toxic", "half", "x"],
                )

    features = (
        _texts_of(docs, chosen)
        .select("doc_id", "toxic", "half", "text")
        .mapInArrow(feature_rows, "doc_id long, toxic int, half int, x array<double>")
        .collect()
    )
    features.sort(key=lambda r: (r["doc_id"], r["toxic"]))
    halves = []
    for half, pair in enumerate(pairs):
        here = [r for r in features if r["half"] == half]
        x, y = np.array([r["x"] for r in here]), np.array([r["toxic"] for r in here])
        halves.append(calibrated(pair, x, y, share))
    return Model(tuple(halves), share)


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The sampled ids with one text each."""
    ids = F.broadcast(ids)
    others = [c for c in ids.columns if c != "doc_id"]
    return (
        docs.select("doc_id", "text")
        .join(ids, "doc_id")
        .groupBy("doc_id", *others)
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .repartition(docs.sparkSession.sparkContext.defaultParallelism)
    )


def spaced(parts: list, most: int) -> list:
    """At most ``most`` evenly spaced entries of a list."""
    at = np.unique(np.linspace(0, len(parts) - 1, min(len(parts), most)).astype(int))
    return [parts[i] for i in at]


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        for text in utf8(batch.column(2)):
            parts.append(spaced(windows(text), SAMPLE_WINDOWS))
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(parts, pa.list_(pa.binary()))],
            ["doc_id", "toxic", "parts"],
        )


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``_score`` (0 to 1) and ``_predicted`` (0 or 1)."""
    ship(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())])
    arrow, at = to_arrow_schema(schema), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for whole in batches:
            for batch in slices(whole, at):
                scores = scorer.scores([windows(t) for t in utf8(batch.column(at))])
                yield pa.record_batch([*batch.columns, pa.array(scores)], arrow)

    return docs.mapInArrow(run, schema).withColumn(
        "_predicted", (F.col("_score") >= PREDICT_FROM).cast("int")
    )
