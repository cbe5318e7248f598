from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from llm_helpers import CLASHING, prose, docs_of  # noqa: F401
from sluice.llm import exact_dedup


def brute(pairs):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in pairs]
    out = []
    for (i, _), t in zip(pairs, norm, strict=True):
        same = [j for (j, _), u in zip(pairs, norm, strict=True) if u == t]
        out.append((i, min(same), len(same)))
    return sorted(out)


def pairs_of():
    rng = random.Random(7)
    long = prose(rng, 300)
    return [
        (9, long), (4, long.replace(" ", "\n\t")), (5, long + "."), (1, None), (2, ""), (3, " "),
        (6, "\t"), (7, "a"), (8, "a "), (10, "x" * 64), (11, "x" * 65), (12, "x" * 128),
        (13, ("ab" * 32)), (14, ("ab" * 32)), (15, "\U0001f600" * 70), (16, "\U0001f600" * 70),
    ]


def test_groups_match_brute_force(spark, docs_of):
    pairs = pairs_of()
    got = exact_dedup.exact_dedup(docs_of(pairs, CLASHING), block_chars=32).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == brute(pairs)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_colliding_routing_hashes_change_nothing(spark, docs_of):
    docs = docs_of(pairs_of())

    def classes(df):
        groups: dict = {}
        for r in df.collect():
            groups.setdefault((r.n_blocks, r.name), set()).add(r.doc_id)
        return sorted(map(sorted, groups.values()))

    weak = F.length("block").cast("long") % 3
    assert classes(exact_dedup.document_names(docs, 32)) == classes(
        exact_dedup.document_names(docs, 32, hash_of=weak)
    )


def test_repeated_rows_keep_one_and_empty_table(spark, docs_of):
    got = exact_dedup.exact_dedup(docs_of([(1, "a b"), (1, "a b"), (2, "a  b")])).collect()
    assert [r.group_size for r in got] == [3, 3, 3]
    assert sum(r.kept for r in got) == 1
    assert exact_dedup.exact_dedup(docs_of([])).count() == 0
