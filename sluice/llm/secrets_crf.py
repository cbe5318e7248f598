"""Secret scan: base patterns plus a linear-chain conditional random field.

Three base patterns (assignments, access keys, long hex runs) are always
reported. Beyond them a linear-chain CRF tags tokens as begin, inside or outside
of a secret from their shape (character classes, length, entropy), their
neighbours (key words, separators) and file features, and is decoded by Viterbi;
its spans that touch no base span are added.

Training is weakly supervised: the base patterns label the tokens of a bounded
sample of documents (``TRAIN_DOCS`` documents, half of them chosen among those with a
base span anywhere in the table, and ``TRAIN_RUNS`` token runs), but no feature repeats
the patterns themselves, so the field generalises to secrets of other forms. It is
fitted by exact gradients (forward-backward).

Decoding works on runs: words of plain shape (letters that are no key word,
perhaps with punctuation) are outside by definition unless another word is among
the three before or a little way after them, so a document falls into independent
runs around its other words, each decoded by Viterbi. One pass, no shuffle.

Defined cases: null or empty text has no spans; offsets count code points, end
exclusive; documents that repeat each get their row; extra columns pass through
:func:`scan`; without training data only base spans are found; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.llm.common import ship

#: Bounds of the learning sample.
TRAIN_DOCS, TRAIN_RUNS = 2000, 4000
#: Fixed base patterns: kind, expression, length that the value must have.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Texts with a base span, as Spark's own expression; chooses training documents.
_HOLDS_BASE = (
    r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[a-z0-9+/_.=-]{6})"""
    r"|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
)
KINDS = ("assign", "access", "hex", "crf")
_LEAST = {"assign": 6, "access": 20}

_TOKEN = re.compile(r"[^\s\"'`=:,;()<>{}\[\]]+|[\"'`=:,;()<>{}\[\]]")
#: Key words as bytes, and what each of them must contain (a cheap test per text).
_KEY_WORDS = re.compile(rb"pass(?:word|wd|phrase)|secret|token|api_?key|credential|auth", re.I)
_KEY_STEMS = (b"passw", b"passphrase", b"secret", b"token", b"api", b"credential", b"auth")
_ASSIGN_STEMS = (b"passw", b"secret", b"token", b"api")
#: The words after a notable word that belong to its run: features look three tokens back.
_AFTER = re.compile(r"(?:\s+\S+){0,3}")
#: A word of this many bytes is notable whatever it consists of.
_LONG_WORD = 20
_SPACE, _SPECIAL = 1, 2
_BYTES = np.zeros(256, np.uint8)
_BYTES[[0x20, *range(0x09, 0x0E)]] = _SPACE
_BYTES[[*b"0123456789=:_+/"]] = _SPECIAL
_NOT_HEX = np.ones(256, bool)
_NOT_HEX[[*b"0123456789abcdef"]] = False
_HEX_LEAST = 24
_TRIGGER = re.compile(r"pass(word|wd|phrase)?|secret|token|api_?key|credential|auth|bearer|key", re.I | re.A)
_CLASSES = ("letters", "digits", "hex", "mixed", "base64", "symbol", "other")
_LENGTHS = (6, 12, 20, 32)
_PUNCT = frozenset("\"'`=:,;()<>{}[]")
#: Names of the binary features, in order.
FEATURES = (
    *(f"class={c}" for c in _CLASSES),
    *(f"length>={n}" for n in _LENGTHS),
    "entropy>=3", "entropy>=3.8", "has_upper_lower_digit", "has_underscore", "has_dash", "has_dot",
    "is_trigger", "is_quote", "is_separator",
    "before_is_separator", "before_is_quote", "before_is_trigger", "two_before_is_trigger",
    "three_before_is_trigger", "after_is_separator", "after_is_quote", "at_start", "at_end",
    "file_has_assignments", "file_is_dense_in_digits", "bias",
)
_AT = {f: i for i, f in enumerate(FEATURES)}
BEGIN, INSIDE, OUTSIDE = 0, 1, 2
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns, leftmost and not overlapping per kind.

    Each expression runs only on texts that can match it: key words and runs of
    hexadecimal digits are looked for in the raw bytes first.
    """
    out: list[Span] = []
    data = text.encode("utf-8", "surrogatepass")
    low = data.lower()
    if any(stem in low for stem in _ASSIGN_STEMS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= _LEAST["assign"]:
                out.append(("assign", *m.span()))
    if b"AKIA" in data:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= _LEAST["access"]]
    breaks = np.flatnonzero(_NOT_HEX[np.frombuffer(data, np.uint8)])
    if np.diff(breaks, prepend=-1, append=len(data)).max() > _HEX_LEAST:
        out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def digest(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _class_of(token: str) -> str:
    if len(token) == 1 and not token.isalnum():
        return "symbol"
    if token.isdigit():
        return "digits"
    if token.isalpha():
        return "letters"
    if re.fullmatch(r"[0-9a-fA-F]+", token):
        return "hex"
    if re.fullmatch(r"[A-Za-z0-9]+", token):
        return "mixed"
    return "base64" if re.fullmatch(r"[A-Za-z0-9+/=_.-]+", token) else "other"


def _entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def notable_words(text: str) -> list[tuple[int, int]]:
    """Spans of the words worth tagging: with a digit or an inner symbol, with a key
    word, or long. Found in the bytes; offsets are code points."""
    data = text.encode("utf-8", "surrogatepass")
    buf = np.frombuffer(data, np.uint8)
    kind = _BYTES[buf]
    inside = np.concatenate([[False], kind != _SPACE, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    marks = np.flatnonzero(kind == _SPECIAL)
    low = data.lower()
    if any(stem in low for stem in _KEY_STEMS):
        marks = np.concatenate([marks, [m.start() for m in _KEY_WORDS.finditer(data)]])
    found = np.unique(
        np.concatenate(
            [
                np.searchsorted(starts, marks, "right") - 1,
                np.flatnonzero(ends - starts >= _LONG_WORD),
            ]
        ).astype(np.int64)
    )
    if not len(found):
        return []
    a, b = starts[found], ends[found]
    if len(text) != len(data):
        points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        a, b = points[a], points[b]
    return list(zip(a.tolist(), b.tolist(), strict=True))


def runs_of(text: str) -> list[list[tuple[int, int]]]:
    """Token spans of the runs around notable words, with a little plain text before
    and the words after that a feature of theirs can see."""
    out: list[list[int]] = []
    end = -1
    for start, stop in notable_words(text):
        # A short left context; the text between runs is plain by definition.
        left = text.rfind("\n", max(0, start - 40), start) + 1 or max(0, start - 40)
        if left > 0 and not text[left - 1].isspace():
            while left < start and not text[left].isspace():
                left += 1
        right = _AFTER.match(text, stop).end()
        if out and left <= end:
            out[-1][1] = right
        else:
            out.append([left, right])
        end = max(stop + 40, right)
    return [[(a + t.start(), a + t.end()) for t in _TOKEN.finditer(text[a:b])] for a, b in out]


def file_features(text: str, n_notable: int) -> list[int]:
    lines = text.count("\n") + 1
    found = []
    if text.count("=") + text.count(":") >= max(2, lines // 2):
        found.append(_AT["file_has_assignments"])
    if n_notable * 40 >= max(1, len(text)):
        found.append(_AT["file_is_dense_in_digits"])
    return found


def featurise(text: str, run: list[tuple[int, int]], of_file: list[int]) -> np.ndarray:
    """Binary features, one row per token."""
    tokens = [text[a:b] for a, b in run]
    kinds = [
        "quote" if t in "\"'`" else "separator" if t in "=:" else "trigger" if _TRIGGER.search(t) else ""
        for t in tokens
    ]
    x = np.zeros((len(tokens), len(FEATURES)), np.float32)
    x[:, _AT["bias"]] = 1
    x[:, of_file] = 1
    for i, t in enumerate(tokens):
        on = [f"class={_class_of(t)}"]
        on += [f"length>={n}" for n in _LENGTHS if len(t) >= n]
        h = _entropy(t) if len(t) >= 6 else 0
        on += [f for f, least in (("entropy>=3", 3), ("entropy>=3.8", 3.8)) if h >= least]
        if re.search("[A-Z]", t) and re.search("[a-z]", t) and re.search("[0-9]", t):
            on.append("has_upper_lower_digit")
        on += [f for f, c in (("has_underscore", "_"), ("has_dash", "-"), ("has_dot", ".")) if c in t]
        if kinds[i]:
            on.append(f"is_{kinds[i]}")
        if i == 0:
            on.append("at_start")
        elif kinds[i - 1]:
            on.append(f"before_is_{kinds[i - 1]}")
        if i > 1 and kinds[i - 2] == "trigger":
            on.append("two_before_is_trigger")
        if i > 2 and kinds[i - 3] == "trigger":
            on.append("three_before_is_trigger")
        if i == len(tokens) - 1:
            on.append("at_end")
        elif kinds[i + 1] in ("quote", "separator"):
            on.append(f"after_is_{kinds[i + 1]}")
        x[i, [_AT[f] for f in on]] = 1
    return x


def weak_tags(text: str, run: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    """Begin, inside, outside per token from the values of base spans."""
    tags = np.full(len(run), OUTSIDE, np.int8)
    for kind, a, b in spans:
        if kind == "assign":
            m = ASSIGN.match(text, a)
            a, b = m.span(2)
        first = True
        for i, (s, e) in enumerate(run):
            if s < b and e > a and text[s] not in _PUNCT:
                tags[i] = BEGIN if first else INSIDE
                first = False
    return tags


class Field:
    """The trained field: emission weights (features x 3) and transitions (3 x 3)."""

    def __init__(self, emission: np.ndarray, moves: np.ndarray) -> None:
        self.emission, self.moves = emission, moves

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags by Viterbi; a run starts as if after an outside token."""
        scores = x @ self.emission
        best = scores[0] + self.moves[OUTSIDE]
        back = np.zeros((len(x), 3), np.int8)
        for i in range(1, len(x)):
            paths = best[:, None] + self.moves
            back[i] = paths.argmax(axis=0)
            best = paths.max(axis=0) + scores[i]
        tags = np.empty(len(x), np.int8)
        tags[-1] = (best + self.moves[:, OUTSIDE]).argmax()
        for i in range(len(x) - 1, 0, -1):
            tags[i - 1] = back[i, tags[i]]
        return tags


#: A secret cannot go on from outside.
_BARRED = np.zeros((3, 3))
_BARRED[OUTSIDE, INSIDE] = -50.0


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_field(xs: list[np.ndarray], ys: list[np.ndarray], rounds: int = 150, l2: float = 1e-3) -> Field:
    """Maximum likelihood by Adam on exact gradients over padded runs."""
    n, t = len(xs), max(len(x) for x in xs)
    x = np.zeros((n, t, len(FEATURES)), np.float32)
    y = np.zeros((n, t), np.int64)
    live = np.zeros((n, t), bool)
    for i, (a, b) in enumerate(zip(xs, ys, strict=True)):
        x[i, : len(a)], y[i, : len(a)], live[i, : len(a)] = a, b, True
    hot = np.eye(3)[y] * live[..., None]
    gold_moves = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
    gold_moves[OUTSIDE] += hot[:, 0].sum(axis=0)
    gold_emission = np.einsum("ntf,ntk->fk", x, hot)
    theta = [np.zeros((len(FEATURES), 3)), np.zeros((3, 3))]
    m = [np.zeros_like(p) for p in theta]
    v = [np.zeros_like(p) for p in theta]
    for step in range(1, rounds + 1):
        w, moves = theta[0], theta[1] + _BARRED
        s = x @ w
        alpha = np.zeros((n, t, 3))
        beta = np.zeros((n, t, 3))
        alpha[:, 0] = s[:, 0] + moves[OUTSIDE]
        for i in range(1, t):
            now = _lse(alpha[:, i - 1, :, None] + moves[None], 1) + s[:, i]
            alpha[:, i] = np.where(live[:, i, None], now, alpha[:, i - 1])
        for i in range(t - 2, -1, -1):
            now = _lse(moves[None] + (s[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
            beta[:, i] = np.where(live[:, i + 1, None], now, 0)
        z = _lse(alpha[:, -1], 1)
        one = np.exp(alpha + beta - z[:, None, None]) * live[..., None]
        pair = np.exp(
            alpha[:, :-1, :, None]
            + moves[None, None]
            + (s[:, 1:] + beta[:, 1:])[:, :, None, :]
            - z[:, None, None, None]
        )
        want_moves = (pair * live[:, 1:, None, None]).sum(axis=(0, 1))
        want_moves[OUTSIDE] += one[:, 0].sum(axis=0)
        grads = [
            (np.einsum("ntf,ntk->fk", x, one) - gold_emission) / n + l2 * theta[0],
            (want_moves - gold_moves) / n + l2 * theta[1],
        ]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            theta[k] = theta[k] - 0.2 * (m[k] / (1 - 0.9**step)) / (
                np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8
            )
    return Field(theta[0], theta[1] + _BARRED)


def field_spans(text: str, field: Field, base: list[Span]) -> list[Span]:
    """Spans of the field that touch no base span."""
    runs = runs_of(text)
    of_file = file_features(text, len(runs))
    out: list[Span] = []
    for run in runs:
        if not run:
            continue
        found: list[list[int]] = []
        for (a, b), tag in zip(run, field.decode(featurise(text, run, of_file)), strict=True):
            if tag == BEGIN or (tag == INSIDE and not found):
                found.append([a, b])
            elif tag == INSIDE:
                found[-1][1] = b
        out += [("crf", a, b) for a, b in found]
    taken = [(a, b) for _, a, b in base]
    return [s for s in out if not any(s[1] < b and s[2] > a for a, b in taken)]


#: Tokens of a training run (longer runs are cut, each part is one run).
_RUN_TOKENS = 48


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        xs, ys = [], []
        for text in batch.column(1).to_pylist():
            if text:
                spans, runs = base_spans(text), runs_of(text)
                of_file = file_features(text, len(runs))
                for run in runs:
                    for i in range(0, len(run), _RUN_TOKENS):
                        part = run[i : i + _RUN_TOKENS]
                        xs.append(featurise(text, part, of_file).astype(np.uint8).tobytes())
                        ys.append(weak_tags(text, part, spans).tobytes())
        yield pa.record_batch([pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], ["x", "y"])


def _first_ids(docs: DataFrame, most: int) -> list[int]:
    """The first ids of the rows by hash order."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    return [r["doc_id"] for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()]


def train(docs: DataFrame) -> Field | None:
    """Field from a bounded sample: ``TRAIN_DOCS`` ids by hash order, half of them among
    the documents with a base span (found over all rows) where there are so many, and of
    their runs ``TRAIN_RUNS`` by hash order, half of them with a secret where possible."""
    spark = docs.sparkSession
    ship(spark)
    holding = _first_ids(docs.filter(F.col("text").rlike(_HOLDS_BASE)), TRAIN_DOCS // 2)
    others = [i for i in _first_ids(docs, TRAIN_DOCS) if i not in set(holding)]
    chosen = [(i,) for i in holding + others[: TRAIN_DOCS - len(holding)]]
    sample = spark.createDataFrame(chosen, "doc_id long")  # at most TRAIN_DOCS rows
    runs = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .join(F.broadcast(sample), "doc_id")
        .mapInArrow(_training_rows, "x binary, y binary")
        .withColumn("secret", F.expr("instr(hex(y), '00') % 2 = 1"))
    )
    rows = []
    for secret in (True, False):
        rows += (
            runs.filter(F.col("secret") == secret)
            .orderBy(F.xxhash64("x", "y"))
            .limit(TRAIN_RUNS // 2)
            .collect()
        )
    if not any(r["secret"] for r in rows):
        return None
    rows.sort(key=lambda r: (bytes(r["x"]), bytes(r["y"])))
    xs = [np.frombuffer(r["x"], np.uint8).reshape(-1, len(FEATURES)).astype(np.float32) for r in rows]
    return fit_field(xs, [np.frombuffer(r["y"], np.int8) for r in rows])


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """The documents with ``_spans`` (kind, start, end in order, base and field)."""
    ship(docs.sparkSession)
    span = T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
    schema = T.StructType([*docs.schema.fields, T.StructField("_spans", T.ArrayType(span))])
    arrow, at = to_arrow_schema(schema), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [find(text or "", field) for text in batch.column(at).to_pylist()]
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans]
            yield pa.record_batch([*batch.columns, pa.array(rows, arrow.field("_spans").type)], arrow)

    return docs.mapInArrow(run, schema)


def find(text: str, field: Field | None) -> list[Span]:
    """All spans of one text, by start, then kind."""
    base = base_spans(text)
    more = field_spans(text, field, base) if field is not None else []
    return sorted(base + more, key=_order)


def digests(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id`` with counts per kind and the span digests."""
    ship(docs.sparkSession)
    names = ("n_assign", "n_access", "n_hex", "n_crf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [find(text or "", field) for text in batch.column(1).to_pylist()]
            base = [digest([s for s in x if s[0] != "crf"]) for x in spans]
            yield pa.record_batch(
                [
                    batch.column(0),
                    *(pa.array([sum(s[0] == k for s in x) for x in spans], pa.int64()) for k in KINDS),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([digest(x) for x in spans], pa.string()),
                ],
                ["doc_id", *names, "base_sha256", "spans"],
            )

    kinds = ", ".join(f"{n} long" for n in names)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, f"doc_id long, {kinds}, base_sha256 string, spans string"
    )
