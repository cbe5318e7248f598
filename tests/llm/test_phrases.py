from __future__ import annotations

import hashlib
import random

import numpy as np

from llm_helpers import CLASHING, docs_of, prose  # noqa: F401
from sluice.llm import phrases


def phrase_bytes(text, level):
    """(start, end, name) of each phrase of a level, in bytes, by one text alone."""
    data = np.frombuffer(text, np.uint8)
    names, firsts = phrases._BYTE_NAMES[data], np.array([0, len(data)])
    at = np.arange(len(data) + 1)
    for _ in range(level):
        new = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        at = np.append(at[new], len(data))
        names, firsts = phrases._runs(names, firsts)
        starts = phrases.phrase_starts(names, firsts)
        at = np.append(at[starts], len(data))
        got = list(phrases.levels_of(data, np.array([0, len(data)]), _ + 1))[-1]
        names, firsts = got[1], got[2]
    return list(zip(at[:-1].tolist(), at[1:].tolist(), names.tolist(), strict=True))


def test_equal_substrings_share_their_interior_phrases_at_any_offset():
    rng = random.Random(2)
    alphabet = b"abcdefgh  "
    for _ in range(20):
        shared = bytes(rng.choice(alphabet) for _ in range(3000))
        before, after = (bytes(rng.choice(alphabet) for _ in range(rng.randrange(1, 400))) for _ in range(2))
        for level, margin in ((1, 60), (2, 200), (3, 600)):
            alone = {(s, e, n) for s, e, n in phrase_bytes(shared, level) if margin <= s and e <= 3000 - margin}
            k = len(before)
            inside = {
                (s - k, e - k, n)
                for s, e, n in phrase_bytes(before + shared + after, level)
                if margin <= s - k and e - k <= 3000 - margin
            }
            assert alone == inside and alone


def test_phrases_are_short_and_labels_differ_between_neighbours():
    rng = random.Random(4)
    for text in (bytes(rng.choice(b"ab") for _ in range(5000)), b"a" * 999, b"ab" * 700, b"x", b"xy"):
        data = np.frombuffer(text, np.uint8)
        names, firsts = phrases._runs(phrases._BYTE_NAMES[data], np.array([0, len(data)]))
        labels = phrases.labels_of(names, firsts)
        assert labels.max() <= 2 and (len(labels) == 1 or (labels[1:] != labels[:-1]).all())
        sizes = np.diff(np.append(phrases.phrase_starts(names, firsts), len(names)))
        assert sizes.max() <= 6
        assert len(names) < 2 or len(sizes) < len(names)


def test_a_text_has_one_fingerprint_whatever_stands_beside_it():
    rng = random.Random(6)
    texts = [prose(rng, rng.randrange(0, 80)).encode() for _ in range(50)] + [b"a", b"aa", b"ab", b""]
    together = phrases.signatures(texts)
    rng.shuffle(order := list(range(len(texts))))
    shuffled = phrases.signatures([texts[i] for i in order])
    for place, i in enumerate(order):
        assert (shuffled[place] == together[i]).all()
        assert (phrases.signatures([texts[i]])[0] == together[i]).all()


def test_likeness_follows_the_shared_share():
    rng = random.Random(8)
    base = prose(rng, 4000, 100_000)
    words = base.split(" ")
    seen = []
    for kept in (1.0, 0.9, 0.5, 0.1, 0.0):
        cut = int(len(words) * kept)
        other = " ".join(words[:cut] + prose(rng, len(words) - cut, 100_000).split(" "))
        a, b = (phrases.signatures([t.encode()]) for t in (base, other))
        no = np.zeros(1, bool)
        seen.append(float(phrases.likeness(a, b, no, no)[0]))
    assert seen[0] == 1.0 and seen == sorted(seen, reverse=True)
    assert 0.2 < seen[2] < 0.5 and seen[4] < 0.15


def brute(pairs):
    def key(pair):
        return (pair[0] is None, 0 if pair[0] is None else -pair[0])

    ranked = sorted(pairs, key=key)
    out = []
    for place, (i, text) in enumerate(ranked):
        text, following = text or "", ranked[(place + 1) % len(ranked)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        marks = [phrases.fingerprint(t) for t in (text, edited, following)]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *marks[:2],
                    near(marks[0], marks[1]), near(marks[0], marks[2])))
    return sorted(out, key=repr)


def near(a, b):
    if not a or not b:
        return float(a == b)
    share = sum(a[i : i + 2] == b[i : i + 2] for i in range(0, len(a), 2)) / (len(a) // 2)
    return round(max(0.0, (share - 1 / 256) / (1 - 1 / 256)), 9)


def rows_of(df):
    return sorted(
        ((r[0], r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
          round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()), key=repr,
    )


def test_edited_pairs_match_brute_force(spark, docs_of):
    rng = random.Random(9)
    texts = [prose(rng, rng.randrange(1, 90)) for _ in range(70)]
    texts += ["", None, "é", "😀" * 31, "a" * 5000, texts[0], texts[0], "ab", "\n\n"]
    ids = rng.sample(range(-50, 1000), len(texts))
    pairs = [*zip(ids, texts, strict=True), (None, "without an id")]
    schema = CLASHING + ", id long, part int, side string, place int, route int"
    docs = docs_of(pairs, schema)
    assert rows_of(phrases.edited_pairs(docs)) == brute(pairs)
    marks = {r.doc_id: r.fingerprint for r in phrases.fingerprints(docs).collect()}
    assert all(marks[i] == phrases.fingerprint(t) for i, t in pairs)


def test_one_id_for_all_rows_one_row_and_no_row(spark, docs_of):
    pairs = [(5, f"text number {n % 40} of a repeated id") for n in range(300)]
    got = phrases.edited_pairs(docs_of(pairs)).collect()
    assert len(got) == 300 and {r.doc_id for r in got} == {5}
    # Equal rows stand next to each other: all but the last of each kind are like the next.
    assert sum(r.near_next == 1.0 for r in got) >= 300 - 40
    (only,) = phrases.edited_pairs(docs_of([(1, "alonehere!")])).collect()
    assert only.near_next == 1.0
    assert only.edited_sha256 == hashlib.sha256(b"alonealone").hexdigest()
    assert phrases.edited_pairs(docs_of([])).count() == 0
