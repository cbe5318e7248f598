from __future__ import annotations

import random
import re

import numpy as np
import pytest

from llm_helpers import CLASHING, docs_of, prose  # noqa: F401
from sluice.llm import near_dedup


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(pairs):
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least: dict = {}
    for i, (d, _) in enumerate(pairs):
        least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(pairs))


def edited(rng, text, share):
    return " ".join(
        f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split()
    )


def pairs_of():
    rng = random.Random(2)
    pairs = [(1, None), (2, ""), (3, "One two"), (4, "one  TWO"), (5, "one two three")]
    for group in range(25):
        base = prose(rng, rng.randrange(60, 300), 10**6)
        for k in range(8):
            text = base if k < 2 else edited(rng, base, rng.choice([0.005, 0.02, 0.03, 0.05, 0.1]))
            pairs.append((1000 - 10 * group - k, text))
    # A passage shared by many documents that are not near each other.
    passage = prose(rng, 60, 10**6)
    pairs += [(2000 + i, passage + " " + prose(rng, 50, 10**6)) for i in range(60)]
    return pairs


@pytest.mark.parametrize("dense", [4, 0])
def test_components_match_brute_force(spark, docs_of, monkeypatch, dense):
    """Also with small blocks, and with every remaining block pair judged in place."""
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 8)
    monkeypatch.setattr(near_dedup, "DENSE", dense)
    pairs = pairs_of()
    got = near_dedup.near_duplicates(docs_of(pairs, CLASHING)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(pairs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_repeated_rows_and_empty_table(spark, docs_of):
    text = "a b c d e f g"
    got = near_dedup.near_duplicates(docs_of([(7, text), (7, text), (8, text)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(7, 7), (7, 7), (8, 7)]
    assert near_dedup.near_duplicates(docs_of([])).count() == 0


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(4)
    n = near_dedup.CHUNKS * near_dedup.CHUNK_SYMBOLS
    a = rng.integers(0, 2**16, (200, near_dedup.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(n, 2 * near_dedup.CHUNKS - 1, replace=False)] ^= np.uint16(1)
    ka, kb = near_dedup.chunk_keys(a), near_dedup.chunk_keys(b)
    assert (ka == kb).any(axis=1).all()


def test_agreement_estimates_similarity():
    rng = random.Random(8)
    base = [f"x{rng.randrange(10**9)}" for _ in range(2000)]
    left, right = " ".join(base[:1700]), " ".join(base[300:])
    sets = near_dedup.shingle_sets([left.encode(), right.encode()])
    sig = near_dedup.signatures(sets)
    true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.15


def test_components_of_a_long_chain(spark):
    from sluice.llm.components import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}


def test_rows_without_an_id_or_with_a_shared_one_keep_their_links(spark, docs_of):
    rng = random.Random(31)
    a, b, c = (prose(rng, 60, 10**6) for _ in range(3))
    one = lambda t: t.replace(t.split()[30], "changed")
    got = near_dedup.near_duplicates(docs_of([(None, a), (5, one(a)), (None, b), (None, one(b)), (7, c)])).collect()
    seen = sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=repr)
    assert seen == [(5, 5, True), (7, 7, True), (None, 5, False), (None, None, True), (None, None, True)]


def test_one_row_of_each_component_stays_with_all_its_columns(spark, docs_of):
    rng = random.Random(32)
    a, b, c, d = (prose(rng, 60, 10**6) for _ in range(4))
    one = lambda t: t.replace(t.split()[30], "changed")
    pairs = [(1, a), (2, one(a)), (2, b), (3, c), (3, c), (None, d), (None, one(d)), (None, None), (None, None), (9, ""), (8, "")]
    docs = docs_of(pairs, CLASHING + ", t long, row string, k_id int")
    out = near_dedup.keep_one_each(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    texts = {(None, d), (None, one(d))} & set(got)
    assert len(texts) == 1
    want = [(1, a), (2, b), (3, c), (None, None), (8, ""), (9, ""), *texts]
    assert got == sorted(want, key=repr)
    assert near_dedup.keep_one_each(docs_of([])).count() == 0
