from __future__ import annotations

import random
import zlib

import pytest

from llm_helpers import CLASHING, docs_of, prose  # noqa: F401
from sluice.llm import sharding


def test_shards_are_gapless_even_and_keep_groups(spark, docs_of, monkeypatch):
    monkeypatch.setattr(sharding, "LANE_GROUPS", 400)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 64)
    rng = random.Random(1)
    pairs = [(i, prose(rng, rng.randrange(5, 60))) for i in range(1200)]
    pairs += [(5000 + i, pairs[i % 30][1]) for i in range(200)] + [(9000, None), (9001, ""), (9001, "")]
    rows = sharding.assign_shards(docs_of(pairs, CLASHING)).collect()
    assert len(rows) == len(pairs)
    text = {i: t or "" for i, t in pairs}
    load, slots, of_text = [0] * 24, [[] for _ in range(24)], {}
    for r in rows:
        assert r.size == len(text[r.doc_id].encode()) + 8
        assert r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        of_text.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert all(len(s) == 1 for s in of_text.values())
    assert max(load) < 1.06 * min(load)


def test_a_group_of_a_third_of_all_rows_does_not_unbalance(spark, docs_of):
    rng = random.Random(2)
    pairs = [(i, prose(rng, 30)) for i in range(1000)]
    pairs += [(2000 + i, pairs[0][1]) for i in range(500)]
    load = [0] * 24
    for r in sharding.assign_shards(docs_of(pairs)).collect():
        load[r.shard] += r.size
    assert max(load) < 1.25 * sum(load) / 24


@pytest.mark.parametrize("one_id", [7, None])
def test_a_large_group_of_one_id_is_split(spark, docs_of, monkeypatch, one_id):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 64)
    rng = random.Random(3)
    pairs = [(1000 + i, prose(rng, 30)) for i in range(1000)] + [(one_id, prose(rng, 30))] * 2400
    load, slots = [0] * 24, [[] for _ in range(24)]
    for r in sharding.assign_shards(docs_of(pairs)).collect():
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(load) < 1.25 * sum(load) / 24


def test_empty_table(spark, docs_of):
    assert sharding.assign_shards(docs_of([])).count() == 0
