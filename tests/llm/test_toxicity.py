from __future__ import annotations

import math
import random
import zlib

import numpy as np

from llm_helpers import CLASHING, docs_of, prose  # noqa: F401
from sluice.llm import toxicity

INSULTS = ["blockhead", "nitwit", "dunderhead", "nincompoop"]


def corpus(n, seed):
    rng = random.Random(seed)
    syllables = ["an", "ter", "ion", "the", "ou", "re", "st", "ble", "or", "ing"]
    out = []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(90)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_held_out_documents_are_told_apart(spark, docs_of):
    rows = corpus(900, 1)
    docs = docs_of([r[:2] for r in rows], CLASHING.replace(", label int", ""))
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    right = sum(got[i]._predicted == t for i, _, t in held)
    assert len(held) > 150 and right >= 0.95 * len(held)
    assert all(0 <= r._score <= 1 for r in got.values())


def test_held_out_labels_are_never_seen(spark, docs_of):
    rows = corpus(200, 2)
    docs = docs_of([r[:2] for r in rows])
    held = [zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows]
    schema = "doc_id long, quality int, toxic int"
    one = toxicity.train(docs, spark.createDataFrame([(r[0], 0, r[2]) for r in rows], schema))
    flipped = [(r[0], 0, 1 - r[2] if h else r[2]) for r, h in zip(rows, held, strict=True)]
    two = toxicity.train(docs, spark.createDataFrame(flipped, schema))
    assert one.prior == two.prior
    for a, b in zip(one.halves, two.halves, strict=True):
        assert a.toxic == b.toxic and a.ordinary == b.ordinary and np.array_equal(a.weights, b.weights)


def test_no_labels_nulls_and_empty_table(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (2, ""), (None, "x " * 5000)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    assert [r._predicted for r in toxicity.score_documents(docs, model).collect()] == [0] * 4
    nulls = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.score_documents(docs_of([]), toxicity.train(docs, nulls)).count() == 0


def test_cues_of_a_small_language_that_ordinary_text_uses_too():
    rng = random.Random(4)
    common = ["an", "ter", "ion", "the", "ou", "re", "st", "ble", "or", "ing"]
    small = ["schen", "keit", "ung", "ver", "zu", "lich", "tel", "mur", "bad", "fel"]
    toxic, ordinary, held = [], [], []
    for i in range(1200):
        here = small if i % 7 == 0 else common
        words = ["".join(rng.choice(here) for _ in range(rng.randrange(1, 4))) for _ in range(90)]
        is_toxic = i % 6 == 0
        added = rng.choices(INSULTS, k=4) if is_toxic else []
        if here is small:
            # One use is common in ordinary text; five uses are toxic.
            added = ["achlich" + rng.choice(small) for _ in range(5 if is_toxic else i % 2)]
        for w in added:
            words.insert(rng.randrange(len(words)), w)
        parts = toxicity.windows(" ".join(words).encode())
        if i % 5 == 1:
            held.append((parts, is_toxic, here is small))
        else:
            (toxic if is_toxic else ordinary).append(parts)
    model = toxicity.fit(toxic, ordinary, 1 / 6)
    scores = toxicity.Scorer(model).scores([p for p, _, _ in held])
    found = [s for s, (_, t, of_small) in zip(scores, held, strict=True) if of_small and t]
    others = [s for s, (_, t, of_small) in zip(scores, held, strict=True) if of_small and not t]
    above = sum(a > b for a in found for b in others)
    assert all(b"achlich" in half.toxic for half in model.halves)
    assert len(found) >= 5 and above >= 0.75 * len(found) * len(others)


def test_a_cue_far_behind_the_first_windows_counts_in_fitting_and_scoring(spark, docs_of):
    """Ordinary habits after word 128 reach the ordinary dictionary; texts of more than
    4,096 words are calibrated on whole texts."""
    rng = random.Random(61)
    pairs, labels = [], []
    for i in range(120):
        words = prose(rng, 5000 if i < 6 else 300).split()
        words[140:] = [w if n % 3 else "habitualword" for n, w in enumerate(words[140:])]
        toxic = int(i % 3 == 0)
        if toxic:
            for at in (len(words) - 5, len(words) - 40, len(words) - 90):
                words.insert(at, "dunderheaded")
        pairs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = docs_of(pairs)
    model = toxicity.train(docs, labels)
    assert all(b"habitualword" in half.ordinary for half in model.halves)
    got = {r.doc_id: r._predicted for r in toxicity.score_documents(docs, model).collect()}
    assert sum(got[i] == int(i % 3 == 0) for i in got) >= 0.95 * len(got)


def test_an_id_that_repeats_is_learnt_once_and_scores_are_recomputed(spark, docs_of):
    rng = random.Random(62)
    pairs = [(i, prose(rng, 40) + (" nincompoop nincompoop" if i % 2 else "")) for i in range(80)]
    pairs += [(5, f"other text {n}") for n in range(50)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(80)], "doc_id long, quality int, toxic int")
    docs = docs_of(pairs)
    model = toxicity.train(docs, labels)
    for r in toxicity.score_documents(docs, model).collect():
        # The score read step by step: lengths of each window under either dictionary.
        odds = []
        for half in model.halves:
            pair = toxicity.Compressor(half.ordinary, half.toxic)
            saved = []
            for window in toxicity.windows(r.text.encode()):
                lengths = [len(c.compress(window + toxicity._TAIL)) for c in pair.pair]
                saved.append(lengths[0] - lengths[1])
            top, n = sorted(saved, reverse=True), len(saved)
            counts = [sum(s >= k for s in saved) for k in toxicity._STEPS]
            x = [sum(saved) / n, top[0], sum(top[:2]) / len(top[:2]), sum(top[:4]) / len(top[:4])]
            x += [math.log1p(c) for c in counts] + [c / n for c in counts]
            z = [(a - m) / s * w for a, m, s, w in zip(x, half.center, half.spread, half.weights, strict=False)]
            odds.append(max(-30, min(30, sum(z) + half.weights[-1])))
        assert abs(r._score - 1 / (1 + math.exp(-sum(odds) / 2))) < 1e-9


def test_calibration_holds_on_documents_that_were_not_sampled():
    """Scores of ordinary text stay low: the scored dictionaries are the calibrated ones."""
    rows = [(toxicity.windows(t.encode()), y) for _, t, y in corpus(1500, 63)]
    learnt, held = rows[:500], rows[500:]
    model = toxicity.fit([d for d, y in learnt if y], [d for d, y in learnt if not y], 1 / 6)
    scores = toxicity.Scorer(model).scores([d for d, _ in held])
    y = np.array([y for _, y in held])
    assert abs(scores.mean() - y.mean()) < 0.03
    assert ((scores >= toxicity.PREDICT_FROM) & (y == 0)).mean() < 0.02
