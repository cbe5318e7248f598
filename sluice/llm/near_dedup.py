"""Near-duplicate detection: MinHash signatures under a multi-index Hamming join.

Every text becomes the set of its five-word shingles (64-bit hashes) and a
signature of 96 MinHash symbols of b bits. The first 44 symbols are split into
11 chunks of four. By the pigeonhole principle two signatures that differ in at
most 21 of those 44 symbols have a chunk with at most one differing symbol, so
each chunk enumerates its four "one symbol ignored" keys and equal keys meet:
every pair within that distance is a candidate for certain. A pair at similarity
0.75 has no such chunk with probability (1 - 0.738)^11, below 5e-7.

No bucket is expanded into all its pairs:

1. Equal shingle sets form a class; only classes go on.
2. In each bucket (in blocks of bounded size, numpy inside the task) every class
   proposes its most agreeing partner by signature: one pair per member.
   Proposals are confirmed on full sets and confirmed ones form components.
3. All pairs that still lie in one bucket but in two components are proposed, so
   no link between components is lost, and components are formed again. Where a
   block is dense in such pairs they are confirmed inside its task and only links
   leave it: a group of thousands just below the threshold makes no pair rows.

The signature may only reject: a pair goes when its agreement lies 4.5 standard
deviations below that of similarity 0.75. Links are confirmed exactly.

Scale: signatures are computed where the text is read. Keys, stars and labels
are 64-bit rows; texts of candidates are fetched by one equi-join; hot keys are
one row per map task in aggregates and are split in joins.

Defined cases: null or wordless text has an empty set and no link; a text of
fewer than five words is one shingle; rows that repeat an id and text are equal
copies (both carry the same component); ids are integers, rows without one compare last (a
component of such rows alone has a null id, and all of them count as kept;
:func:`keep_one_each` keeps one); rows that share an id are linked by their own texts;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import words as W
from sluice.llm.common import is_empty, ship, stage, text_or_empty
from sluice.llm.components import components

SHINGLE_WORDS = 5
THRESHOLD = (75, 100)
SYMBOLS = 96
CHUNKS, CHUNK_SYMBOLS = 11, 4
#: Rows of a block in the comparison across components (memory of one task).
BLOCK_ROWS = 1024

_rng = np.random.Generator(np.random.PCG64(20240301))
_XOR = _rng.integers(0, 2**32, SYMBOLS, dtype=np.uint32)
_ODD = _rng.integers(0, 2**31, SYMBOLS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_KEY_MULTIPLIERS = _rng.integers(0, 2**63, CHUNK_SYMBOLS, dtype=np.uint64) * W.U64(2) + W.U64(1)
_KEY_SALTS = _rng.integers(0, 2**63, (CHUNKS, CHUNK_SYMBOLS), dtype=np.uint64)


def least_agreement(symbols: int = SYMBOLS) -> int:
    """Symbols that a pair at the threshold shares, less 4.5 standard deviations."""
    p = THRESHOLD[0] / THRESHOLD[1]
    return int(symbols * p - 4.5 * (symbols * p * (1 - p)) ** 0.5)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, firsts = W.word_hashes(texts, W.SPACE_SEPARATED, lower=True)
    grams = W.window_hashes(hashes, SHINGLE_WORDS)
    out = []
    for a, b in zip(firsts.tolist(), firsts[1:].tolist(), strict=False):
        if b - a >= SHINGLE_WORDS:
            out.append(np.unique(grams[a : b - SHINGLE_WORDS + 1]))
        elif b > a:
            out.append(W.window_hashes(hashes[a:b], b - a, which=1))
        else:
            out.append(np.empty(0, W.U64))
    return out


def set_identity(shingles: np.ndarray) -> int:
    """Signed 64-bit identity of a set: mixed sum and exclusive or of its hashes."""
    total = W.mix(shingles ^ W.U64(0x5851F42D4C957F2D))
    both = np.array([total.sum(dtype=W.U64), np.bitwise_xor.reduce(shingles, initial=W.U64(0))])
    return int((W.mix(both[:1]) + both[1:] * W.U64(0x2545F4914F6CDD1D)).view(np.int64)[0])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash symbols (16 bit) of non-empty sets, one row each."""
    values = (np.concatenate(sets) >> W.U64(32)).astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    for i in range(SYMBOLS):
        least = np.minimum.reduceat((values ^ _XOR[i]) * _ODD[i], starts)
        out[:, i] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """Keys of every chunk with each one of its symbols ignored."""
    out = np.empty((len(symbols), CHUNKS * CHUNK_SYMBOLS), W.U64)
    for c in range(CHUNKS):
        part = symbols[:, c * CHUNK_SYMBOLS : (c + 1) * CHUNK_SYMBOLS].astype(W.U64)
        terms = W.mix(part + W.U64(1)) * _KEY_MULTIPLIERS
        whole = terms.sum(axis=1, dtype=W.U64)
        for j in range(CHUNK_SYMBOLS):
            out[:, c * CHUNK_SYMBOLS + j] = W.mix(whole - terms[:, j] + _KEY_SALTS[c, j])
    return out


_PROFILE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("t", pa.int64()),
        ("n", pa.int64()),
        ("rid", pa.int64()),
        ("sig", pa.binary()),
        ("keys", pa.list_(pa.int64())),
    ]
)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in W.slices(whole, 1):
            sets = shingle_sets(W.utf8(batch.column(1)))
            some = [i for i, s in enumerate(sets) if len(s)]
            rids: list[int | None] = [None] * len(sets)
            sigs: list[bytes | None] = [None] * len(sets)
            lengths = np.zeros(len(sets), np.int32)
            keys = np.empty((0, CHUNKS * CHUNK_SYMBOLS), W.U64)
            if some:
                symbols = signatures([sets[i] for i in some])
                keys = chunk_keys(symbols)
                low = symbols.astype(np.uint8)
                for row, i in enumerate(some):
                    rids[i], sigs[i] = set_identity(sets[i]), low[row].tobytes()
                    lengths[i] = CHUNKS * CHUNK_SYMBOLS
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(rids, pa.int64()),
                    pa.array(sigs, pa.binary()),
                    pa.ListArray.from_arrays(offsets, keys.reshape(-1).view(np.int64)),
                ],
                _PROFILE,
            )


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets reach the threshold, on all their elements."""
    num, den = THRESHOLD
    if den * min(len(a), len(b)) < num * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return den * shared >= num * (len(a) + len(b) - shared)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a, b, linked`` from ``a, b`` and both texts (``a``'s repeats in runs)."""
    last: tuple[bytes, np.ndarray] | None = None
    for whole in batches:
        for batch in W.slices(whole, 3):
            sets = shingle_sets(W.utf8(batch.column(3)))
            linked = []
            for text, other in zip(W.utf8(batch.column(2)), sets, strict=True):
                if last is None or last[0] != text:
                    last = (text, shingle_sets([text])[0])
                linked.append(similar(last[1], other))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())],
                ["a", "b", "linked"],
            )


_FOUND = "a long, b long, key long, i int, j int"
#: A block pair with more candidate pairs than this many times its members is
#: dense: its pairs are confirmed inside the task instead of leaving it as rows.
DENSE = 4


class _Members:
    """The members of a batch of block pairs as arrays."""

    def __init__(self, lists: pa.ListArray) -> None:
        flat = lists.flatten()
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        self.blocks = list(zip(ends.tolist(), ends[1:].tolist(), strict=False))
        self.rid, self.label, self.n, self.side = (
            flat.field(x).to_numpy(zero_copy_only=False) for x in ("rid", "label", "n", "side")
        )
        self.sig = np.frombuffer(b"".join(flat.field("sig").to_pylist()), np.uint8)
        self.sig = self.sig.reshape(-1, SYMBOLS)
        self.flat = flat
        self.need = least_agreement()

    def partners(self, i: int, lo: int, hi: int, across: bool) -> tuple[np.ndarray, np.ndarray]:
        """Members of [lo, hi) in other components that fit ``i`` in size and agree
        enough, and their agreement."""
        num, den = THRESHOLD
        at = lo + np.flatnonzero(self.label[lo:hi] != self.label[i])
        if across:  # between two blocks; the pairs inside each are another row's
            at = at[self.side[at] != self.side[i]]
        at = at[den * np.minimum(self.n[at], self.n[i]) >= num * np.maximum(self.n[at], self.n[i])]
        same = (self.sig[at] == self.sig[i]).sum(axis=1)
        return at[same >= self.need], same[same >= self.need]


def _propose(every: bool):
    """Candidate pairs per block pair: each member's most agreeing partner, or all
    pairs; of a dense block pair only its name (``key, i, j``) when all are asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _Members(batch.column(3))
            names = [batch.column(c).to_pylist() for c in range(3)]
            out: list[list] = [[], []]
            dense: list[int] = []
            for block, (lo, hi) in enumerate(m.blocks):
                across = bool(m.side[lo:hi].any())
                found: list[np.ndarray] = []
                count = 0
                for i in range(lo, hi):
                    at, same = m.partners(i, i + 1 if every else lo, hi, across)
                    if len(at):
                        at = at if every else at[[same.argmax()]]
                        count += len(at)
                        if every and count > DENSE * (hi - lo):
                            dense.append(block)
                            found = []
                            break
                        found.append(np.stack([np.full(len(at), m.rid[i]), m.rid[at]]))
                if found:
                    pairs = np.concatenate(found, axis=1)
                    out[0].append(pairs.min(axis=0))
                    out[1].append(pairs.max(axis=0))
            a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in out)
            pad, gap = [None] * len(dense), [None] * len(a)
            yield pa.record_batch(
                [
                    pa.array(a.tolist() + pad, pa.int64()),
                    pa.array(b.tolist() + pad, pa.int64()),
                    pa.array(gap + [names[0][d] for d in dense], pa.int64()),
                    pa.array(gap + [names[1][d] for d in dense], pa.int32()),
                    pa.array(gap + [names[2][d] for d in dense], pa.int32()),
                ],
                ["a", "b", "key", "i", "j"],
            )

    return run


def _link_dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Confirmed pairs of dense block pairs. A pair meets in many buckets; it is
    judged in the one of the first key that both share."""
    for batch in batches:
        m = _Members(batch.column(3))
        keys = m.flat.field("keys").flatten().to_numpy().reshape(-1, CHUNKS * CHUNK_SYMBOLS)
        texts = W.utf8(m.flat.field("text"))
        here = batch.column(0).to_numpy()
        out: list[tuple[int, int]] = []
        for block, (lo, hi) in enumerate(m.blocks):
            across = bool(m.side[lo:hi].any())
            sets = shingle_sets(texts[lo:hi])
            for i in range(lo, hi):
                at, _ = m.partners(i, i + 1, hi, across)
                first = (keys[at] == keys[i]).argmax(axis=1)
                for k in at[keys[i][first] == here[block]]:
                    if similar(sets[i - lo], sets[k - lo]):
                        out.append((int(m.rid[i]), int(m.rid[k])))
        yield pa.record_batch(
            [pa.array([min(p) for p in out], pa.int64()), pa.array([max(p) for p in out], pa.int64())],
            ["a", "b"],
        )


class _Search:
    """One run: what several steps read is staged once."""

    def __init__(self, docs: DataFrame) -> None:
        ship(docs.sparkSession)
        # A row is told by its id (null among them) and a hash of its text.
        text = text_or_empty()
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
            "t", F.xxhash64("text")
        )
        self.rows = stage(
            self.docs.mapInArrow(
                _profile, "doc_id long, t long, n long, rid long, sig binary, keys array<long>"
            ),
            "profiles",
        )
        # All members of a class have the same profile; the least row finds a text of it.
        some = self.rows.filter("n > 0")
        self.classes = stage(
            some.groupBy("rid")
            .agg(F.min(_row("doc_id", "t")).alias("least"))
            .select("rid", "least.doc_id", "least.t"),
            "classes",
        )
        least = self.classes.select(
            F.col("rid").alias("c_rid"), F.col("doc_id").alias("c_id"), F.col("t").alias("c_t")
        )
        # All three in the join: a class of many copies is spread by its ids.
        chosen = some.join(
            least,
            (F.col("rid") == F.col("c_rid"))
            & (F.col("t") == F.col("c_t"))
            & F.col("doc_id").eqNullSafe(F.col("c_id")),
        )
        keys = chosen.select("rid", F.explode("keys").alias("key"))
        heads = (
            keys.groupBy("key")
            .agg(F.min("rid").alias("least"), F.max("rid").alias("most"))
            .filter("least != most")
            .select("key")
        )
        #: ``key, rid`` of every key that two or more classes share.
        self.buckets = stage(keys.join(heads, "key").distinct(), "buckets")
        met = stage(
            self.buckets.select("rid").distinct().join(self.classes, "rid"), "bucket-members"
        )
        self.profiles = stage(
            chosen.select("rid", "n", "sig", "keys").join(met.select("rid"), "rid").dropDuplicates(["rid"]),
            "bucket-profiles",
        )
        # Members grow with the data: joined by shuffle whatever their size now. Null ids
        # are told apart by the hash of their texts.
        wanted = met.hint("merge")
        self.texts = stage(
            self.docs.join(
                wanted, (self.docs["t"] == wanted["t"]) & self.docs["doc_id"].eqNullSafe(wanted["doc_id"])
            )
            .select("rid", "text")
            .dropDuplicates(["rid"]),
            "bucket-texts",
        )

    def members(self, labels: DataFrame | None) -> DataFrame:
        """``key, i, j, rid, label, side``: a row per member and pair of blocks of the
        buckets that hold several components."""
        named = self.buckets
        if labels is None:
            named = named.withColumn("label", F.col("rid"))
        else:
            named = named.join(labels.withColumnRenamed("node", "rid"), "rid", "left").select(
                "key", "rid", F.coalesce("label", "rid").alias("label")
            )
        split = (
            named.groupBy("key")
            .agg(F.count("*").alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi"))
            .filter("lo != hi")
            .select("key", F.ceil(F.col("size") / BLOCK_ROWS).cast("int").alias("blocks"))
        )
        return (
            named.join(split, "key")
            .withColumn("own", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                "key",
                F.least("own", "other").alias("i"),
                F.greatest("own", "other").alias("j"),
                "rid",
                "label",
                (F.col("own") > F.col("other")).cast("byte").alias("side"),
            )
        )

    def gathered(self, members: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
        """``key, i, j, ms``: one row per pair of blocks, at most two blocks long."""
        with_profile = members.join(self.profiles.select("rid", "n", "sig", "keys"), "rid")
        if "text" in extra:
            with_profile = with_profile.join(self.texts, "rid")
        return (
            with_profile.groupBy("key", "i", "j")
            .agg(F.collect_list(F.struct("rid", "label", "n", "sig", "side", *extra)).alias("ms"))
            .select("key", "i", "j", "ms")
        )

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Staged pairs that reach the threshold on their full sets."""
        a, b = (
            self.texts.select(F.col("rid").alias(x), F.col("text").alias(f"text_{x}"))
            for x in ("a", "b")
        )
        return stage(
            pairs.join(b, "b")
            .join(a, "a")
            .select("a", "b", "text_a", "text_b")
            .mapInArrow(_confirm, "a long, b long, linked boolean")
            .filter("linked")
            .select("a", "b"),
            "links",
        )

    def labels(self) -> DataFrame:
        """``node, label`` of every class that has a link."""
        best = self.gathered(self.members(None)).mapInArrow(_propose(every=False), _FOUND)
        tried = stage(best.select("a", "b").distinct(), "tried")
        links = self.confirmed(tried)
        labels = components(links)
        rest = stage(self.gathered(self.members(labels)).mapInArrow(_propose(every=True), _FOUND), "rest")
        pairs = rest.filter("key is null").select("a", "b").distinct()
        more = self.confirmed(pairs.join(tried, ["a", "b"], "left_anti"))
        dense = rest.filter("key is not null").select("key", "i", "j")
        if not is_empty(dense):
            members = self.members(labels).join(dense, ["key", "i", "j"])
            inside = self.gathered(members, ("keys", "text"))
            more = more.unionByName(
                stage(inside.mapInArrow(_link_dense, "a long, b long"), "dense-links")
            )
        return labels if is_empty(more) else components(links.unionByName(more))


    def first_of_classes(self) -> DataFrame:
        """``rid, first``: the first row (``none, doc_id, t``) of each class's component."""
        groups = self.classes.join(self.labels().withColumnRenamed("node", "rid"), "rid", "left").select(
            "rid", F.coalesce("label", "rid").alias("label"), _row("doc_id", "t").alias("row")
        )
        firsts = groups.groupBy("label").agg(F.min("row").alias("first"))
        return stage(groups.join(firsts, "label").select("rid", "first"), "class-firsts")


def _row(doc_id: str, t: str) -> Column:
    """A row as it compares with others: by id, rows without one last, then by its text."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), F.col(t).alias("t"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per input row."""
    run = _Search(docs)
    return (
        run.rows.select("doc_id", "n", "rid")
        .join(run.first_of_classes(), "rid", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("first.doc_id", "doc_id").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest
    id stays (rows without an id come last, ties go by a hash of the text), once. Rows
    without words are linked with nothing; of equal ones with one id, one stays. Rows that
    share an id are judged by their own texts."""
    run = _Search(docs)
    placed = run.rows.select("rid", F.col("doc_id").alias("k_id"), F.col("t").alias("k_t"))
    stays = F.col("k_id").eqNullSafe(F.col("first.doc_id")) & (F.col("k_t") == F.col("first.t"))
    dropped = stage(
        placed.join(run.first_of_classes(), "rid").filter(~stays).select("k_id", "k_t").distinct(), "dropped"
    )
    names = docs.columns
    marked = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(text_or_empty()).alias("t"),
    )
    same = (F.col("t") == F.col("k_t")) & F.col("id").eqNullSafe(F.col("k_id"))
    left = marked.join(dropped, same, "left_anti")
    # Rows that occur more than once are few: only they are grouped.
    again = stage(
        marked.groupBy("id", "t").count().filter("count > 1").select(
            F.col("id").alias("k_id"), F.col("t").alias("k_t")
        ),
        "repeated",
    )
    once = left.join(again, same, "left_semi").dropDuplicates(["id", "t"])
    out = left.join(again, same, "left_anti").unionByName(once)
    return out.select([F.col("row")[n].alias(n) for n in names])
