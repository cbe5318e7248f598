from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from llm_helpers import CLASHING, docs_of, prose  # noqa: F401
from sluice.llm import token_align as ta


@pytest.fixture(scope="module")
def tok():
    with open(ta.BYTE_BPE, "rb") as a, open(ta.PIECE_BPE, "rb") as b:
        return ta.Tokenizers(a.read(), b.read())


def whole(text, tok):
    """Tokens of a whole text as (id, bytes), none where they do not join to it."""
    if not text:
        return [], []
    a = [(i, tok.a_bytes[i]) for i in tok.a.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, tok.b_bytes[i]) for i in tok.b.encode(text)]
    raw = (" " + text).encode()
    return (a, b) if all(b"".join(x for _, x in side) == raw for side in (a, b)) else ([], [])


def ends_of(tokens):
    out, at = [], 0
    for _, raw in tokens:
        at += len(raw)
        out.append(at)
    return out


def brute(pairs, tok):
    sides = [whole(t, tok) for _, t in pairs]
    groups, links = [], []
    for a, b in sides:
        ea, eb = ends_of(a), ends_of(b)
        shared = sorted(set(ea) & set(eb))
        parts, lo = [], 0
        for hi in shared:
            parts.append("|".join(
                ",".join(str(i) for (i, _), e in zip(side, ends, strict=True) if lo < e <= hi)
                for side, ends in ((a, ea), (b, eb))
            ))
            lo = hi
        groups.append(";".join(parts))
        links.append([(a[ea.index(e)][0], b[eb.index(e)][0]) for e in shared])
    count = Counter(x for doc in links for x in doc)
    most: dict = {}
    for (_, b), c in count.items():
        most[b] = max(most.get(b, 0), c)
    return sorted(
        (
            (i, len(a), len(b), len(ls), g, len(ls), sum(count[x] == most[x[1]] for x in ls),
             sum(count[x] for x in ls))
            for (i, _), (a, b), ls, g in zip(pairs, sides, links, groups, strict=True)
        ), key=repr,
    )


def texts_of():
    rng = random.Random(12)
    odd = ["", None, " ", "  ", "a", "\n\t x", "▁ mark", "<s> </s> <unk> <|endoftext|>", "<0x41>",
           "déjà vu 😀😀 naïve", "漢字かな交じり文", "\x00\x01 z", "a" * 3000, " " * 50 + "end  ", "1234567890" * 20,
           "it's we'll don't", "x y z", "́‍"]
    spaced = ["".join(rng.choice("ab  \n'.9é") for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    return odd + spaced + [prose(rng, 60) for _ in range(10)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_alignment_matches_brute_force(spark, docs_of, tok):
    pairs = [*enumerate(texts_of()), (None, "no id"), (3, "same row"), (3, "same row")]
    want = brute(pairs, tok)
    schema = CLASHING + ", id long, chunk int, links int, groups string, pair int, total int, best int"
    assert rows_of(ta.align_documents(docs_of(pairs, schema))) == want
    # Tiny chunks and parts change nothing.
    assert rows_of(ta.align_documents(docs_of(pairs), chunk_bytes=64, part_chars=5)) == want


def test_parts_give_the_tokens_of_the_whole_text(tok):
    rng = random.Random(13)
    texts = texts_of() + ["".join(rng.choice("aé \n\t.'7") for _ in range(400)) for _ in range(100)]
    assert tok.cuts
    for part in (1, 7, 64):
        for text, got in zip(texts, tok.encode([t or "" for t in texts], part), strict=True):
            a, b = whole(text, tok)
            assert got == ([i for i, _ in a], [i for i, _ in b])


def test_terminals_on_random_ends():
    rng = random.Random(14)
    for _ in range(200):
        n = rng.randrange(1, 60)
        a = sorted({n, *rng.sample(range(1, n + 1), rng.randrange(0, n))})
        b = sorted({n, *rng.sample(range(1, n + 1), rng.randrange(0, n))})
        last = ta.terminals(np.array(a), np.array(b))
        shared = sorted(set(a) & set(b))
        for e, t in zip([*a, *b], last.tolist(), strict=True):
            assert a[t] == min(s for s in shared if s >= e)


def test_a_chain_of_many_tokens_is_followed_to_its_end():
    n = 100_000
    a, b = np.arange(2, 2 * n + 1, 2), np.append(np.arange(1, 2 * n, 2), 2 * n)
    assert (ta.terminals(a, b) == n - 1).all()


def test_special_strings_digest_other_ids_and_empty_table(spark, docs_of, tok):
    docs = spark.createDataFrame([("k", "<|endoftext|> here")], "doc_id string, text string")
    (row,) = ta.align_documents(docs, digest=True).collect()
    assert row.doc_id == "k" and row.n_a > 2 and len(row.groups) == 64
    assert ta.align_documents(docs_of([])).count() == 0
    assert rows_of(ta.align_documents(docs_of([(1, None), (2, "")]), digest=True)) == [
        (1, 0, 0, 0, "", 0, 0, 0), (2, 0, 0, 0, "", 0, 0, 0)
    ]
