from __future__ import annotations

import random
import re

import numpy as np

from llm_helpers import CLASHING, docs_of, prose  # noqa: F401
from sluice.llm import decontaminate


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = []
    for d, text in docs:
        w, hit, ids = tokens(text), set(), set()
        for i, item in items:
            v = tokens(item)
            n = min(13, len(v))
            grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
            for k in range(len(w) - n + 1):
                if v and tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    ids.add(i)
        out.append((d, len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def marked(df):
    return sorted(
        (r.doc_id, r._n_words, r._n_hit, sorted(r._items), r._contaminated) for r in df.collect()
    )


def test_hits_match_brute_force(spark, docs_of):
    rng = random.Random(6)
    items = [(i, prose(rng, n)) for i, n in enumerate([40, 13, 14, 25, 12, 9, 7, 4, 3, 2, 1, 59])]
    items += [(50, ""), (51, None), (52, "  ...  "), (53, "É " * 13), (54, items[0][1])]
    docs = [(1, None), (2, ""), (3, "!!"), (4, items[4][1].upper()), (5, "é " * 20)]
    for i in range(10, 50):
        part = rng.choice(items[:12])[1].split()
        cut = rng.randrange(0, 3)
        words = prose(rng, rng.randrange(0, 200)).split()
        at = rng.randrange(0, len(words) + 1)
        docs.append((i, ", ".join(words[:at] + part[cut:] + words[at:])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.mark_contamination(docs_of(docs, CLASHING), bench)
    assert marked(got) == brute(docs, items)
    assert set(docs_of(docs, CLASHING).columns) <= set(got.columns)


def test_empty_sides_and_repeated_rows(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert marked(decontaminate.mark_contamination(docs_of([(1, "a b")]), none)) == [(1, 2, 0, [], False)]
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.mark_contamination(docs_of([]), some).count() == 0
    twice = decontaminate.mark_contamination(docs_of([(1, "a b c"), (1, "a b c")]), some)
    assert marked(twice) == [(1, 3, 3, [1], True)] * 2


def test_winnowing_guarantee():
    rng = np.random.default_rng(0)
    for guarantee in (1, 2, 4, 8, 13):
        k, w = decontaminate.gram_of(guarantee)
        assert k + w - 1 == guarantee
        for _ in range(60):
            shared = rng.integers(0, 50, guarantee).astype(np.uint64)
            a, b = (
                np.concatenate([rng.integers(0, 50, 9), shared, rng.integers(0, 50, 9)]).astype(np.uint64)
                for _ in range(2)
            )
            assert len(
                np.intersect1d(
                    decontaminate.fingerprints(a, guarantee), decontaminate.fingerprints(b, guarantee)
                )
            )


def test_items_without_an_id_and_repeated_items(spark, docs_of):
    rng = random.Random(41)
    a, b = prose(rng, 30, 10**6), prose(rng, 30, 10**6)
    items = spark.createDataFrame([(None, a), (4, b), (4, b)], "item_id long, text string")
    rows = decontaminate.mark_contamination(docs_of([(1, a), (2, b), (None, a + " " + b)]), items).collect()
    got = {r.doc_id: (r._n_hit, r._items, r._contaminated) for r in rows}
    assert got[1] == (30, [None], True) and got[2] == (30, [4], True)
    assert got[None][0] == 60 and len(got[None][1]) == 2
