from __future__ import annotations

import random
import re

import numpy as np
import pytest

from llm_helpers import CLASHING, prose, docs_of  # noqa: F401
from sluice.llm import substring_dedup


def brute(pairs, n):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in pairs]
    least: dict = {}
    for i, w in docs:
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, w in docs:
        gone = set()
        for k in range(len(w) - n + 1):
            if least[tuple(w[k : k + n])] < i:
                gone |= set(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def pairs_of():
    rng = random.Random(11)
    shared = [prose(rng, n) for n in (12, 13, 14, 30, 60)]
    pairs = [(1, None), (2, ""), (3, "one two"), (4, "a " * 40), (5, "a " * 13), (6, "a " * 12)]
    for i in range(10, 60):
        parts = [prose(rng, rng.randrange(0, 30))]
        if rng.random() < 0.7:
            parts += [rng.choice(shared), prose(rng, 5)]
        pairs.append((i, rng.choice([" ", "\n", " "]).join(parts)))
    return pairs + [(90, pairs[-1][1]), (-4, pairs[-2][1])]


@pytest.mark.parametrize("window", [5, 13, 20])
def test_removed_words_match_brute_force(spark, docs_of, window):
    pairs = pairs_of()
    got = substring_dedup.dedup_substrings(
        docs_of(pairs, CLASHING), window, chunk_bytes=700, bucket_windows=64
    ).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == brute(pairs, window)


def test_same_id_is_one_document_and_empty_table(spark, docs_of):
    text = " ".join(map(str, range(20)))
    got = substring_dedup.dedup_substrings(docs_of([(1, text), (1, text), (None, text)])).collect()
    assert sorted((r.n_removed, r.doc_id is None) for r in got) == [(0, True), (20, False), (20, False)]
    assert substring_dedup.dedup_substrings(docs_of([])).count() == 0


def test_levels_double_up_to_the_window():
    assert substring_dedup.levels(13) == [7, 13]
    assert substring_dedup.levels(50) == [7, 13, 25, 50]
    assert substring_dedup.levels(4) == [4]


def test_packed_ids_survive():
    for ids in ([5], [5, 9], [0, 2**40], [-7, 2**32 - 8], [-(2**63), 2**62, 3], [1, 2, 3]):
        a = np.array(ids, np.int64)
        assert substring_dedup._unpack_ids(substring_dedup._pack_ids(a)).tolist() == ids
