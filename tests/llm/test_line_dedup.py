from __future__ import annotations

import random

from llm_helpers import CLASHING, docs_of  # noqa: F401
from sluice.llm import line_dedup


def brute(pairs):
    seen, out = {}, {}
    for i, t in sorted(pairs, key=lambda p: p[0]):
        lines = (t or "").split("\n")
        gone = set()
        for k in range(len(lines) - 2):
            if seen.setdefault(tuple(lines[k : k + 3]), (i, k)) != (i, k):
                gone |= {k, k + 1, k + 2}
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_lines_match_brute_force(spark, docs_of):
    rng = random.Random(5)
    pairs = [(i, "\n".join(rng.choice("abcd") for _ in range(rng.randrange(1, 12)))) for i in range(40)]
    pairs += [(100, None), (101, ""), (102, "a\na"), (103, "z\n" * 50)]
    got = line_dedup.dedup_lines(docs_of(pairs, CLASHING)).collect()
    assert {r.doc_id: r.text for r in got} == brute(pairs)
    assert all(r._n_removed >= 0 and r._n_lines >= 1 for r in got)


def test_repeated_rows_and_empty_table(spark, docs_of):
    got = line_dedup.dedup_lines(docs_of([(1, "a\nb\nc"), (1, "a\nb\nc")])).collect()
    assert [r.text for r in got] == ["a\nb\nc"] * 2
    assert line_dedup.dedup_lines(docs_of([])).count() == 0
