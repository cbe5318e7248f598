from __future__ import annotations

import random
import re

import numpy as np

from sluice.llm import words as W


def test_words_are_those_of_the_pattern_and_hash_by_content():
    texts = ["", "a b  a", "É x\ty\x0bz\x00q", "tail ", " " * 5, "x"]
    hashes, firsts = W.word_hashes([t.encode() for t in texts], W.SPACE_SEPARATED, lower=False)
    names: dict[str, int] = {}
    for i, t in enumerate(texts):
        want = re.findall(r"[^\x20\x09-\x0D]+", t)
        got = hashes[firsts[i] : firsts[i + 1]].tolist()
        assert len(got) == len(want)
        for w, h in zip(want, got, strict=True):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_lower_case_alphanumeric_words():
    a, _ = W.word_hashes([b"Foo-bar \xc3\x89t\xc3\xa9 9z"], W.ALPHANUMERIC, lower=True)
    b, _ = W.word_hashes(["foo bar Été 9Z".encode()], W.ALPHANUMERIC, lower=True)
    assert a.tolist() == b.tolist()


def test_a_text_longer_than_a_piece_is_hashed_whole():
    rng = random.Random(3)
    words = [str(rng.randrange(10**6)) for _ in range(260_000)]
    text = " ".join(words).encode()
    assert len(text) > W.PIECE_BYTES
    hashes, firsts = W.word_hashes([b"a", text, b"b"], W.SPACE_SEPARATED, lower=False)
    assert firsts.tolist() == [0, 1, 1 + len(words), 2 + len(words)]
    one, _ = W.word_hashes([words[-1].encode()], W.SPACE_SEPARATED, lower=False)
    assert hashes[-2] == one[0]
    huge = b"y" * (W.PIECE_BYTES * 2 + 5)
    both, _ = W.word_hashes([huge, huge + b" z"], W.SPACE_SEPARATED, lower=False)
    assert len(both) == 3 and both[0] == both[1]


def test_window_hashes_equal_exactly_for_equal_windows():
    rng = np.random.default_rng(1)
    w = W.mix(rng.integers(0, 3, 400).astype(np.uint64))
    for length in (1, 2, 5, 7, 13):
        got = W.window_hashes(w, length)
        seen: dict[tuple, int] = {}
        for i in range(len(w) - length + 1):
            assert seen.setdefault(tuple(w[i : i + length].tolist()), int(got[i])) == got[i]
        assert len(set(seen.values())) == len(seen)
    assert len(W.window_hashes(w[:3], 4)) == 0
