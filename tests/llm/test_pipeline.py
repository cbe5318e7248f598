from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline as P
from llm_helpers import docs_of, prose  # noqa: F401
from test_decontaminate import brute as contaminated
from test_near_dedup import brute as components

INSULTS = ["blockhead", "nitwit", "dunderhead", "nincompoop"]


@pytest.fixture()
def tables(spark, docs_of, tmp_path):
    rng = random.Random(12)
    items = [(i, prose(rng, 30, 10**6)) for i in range(5)]
    pairs, labels = [], []
    for i in range(400):
        words = prose(rng, rng.randrange(40, 120)).split()
        if i % 5 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        labels.append((i, 1, int(i % 5 == 0)))
        if i % 17 == 1:
            words += items[i % 5][1].split()
        pairs.append((i, " ".join(words)))
    pairs += [(500 + i, pairs[i][1] + " tail") for i in range(1, 400, 13)]
    pairs += [pairs[3], (900, None), (901, "")]
    docs = docs_of(pairs)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    return str(tmp_path), items


def test_stages_against_brute_force(spark, tables):
    sf_dir, items = tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, step in P.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = step(spark, docs, sf_dir)
        out = docs.collect()
        seen[name] = (before, out)
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    before, out = seen["toxicity"]
    bad = {i for i, t in before if t and any(w in t for w in INSULTS)}
    left = [r.doc_id for r in out]
    assert len(bad & set(left)) <= 0.1 * len(bad)
    assert len(left) >= 0.95 * (len(before) - len(bad))
    before, out = seen["near_dedup"]
    want = {d for d, _, c in components(before) if d == c}
    assert sorted(r.doc_id for r in out) == sorted(want)
    before, out = seen["decontaminate"]
    want = [d for d, *_, hit in contaminated(before, items) if not hit]
    assert sorted(r.doc_id for r in out) == want
    before, out = seen["mix"]
    assert {r.doc_id for r in out} <= {d for d, _ in before}
    assert len(out) > 0.8 * len(before)
    before, out = seen["shard"]
    assert sorted(r.doc_id for r in out) == sorted(d for d, _ in before)


def test_run_gives_the_last_stage(spark, tables):
    rows = P.run(spark, tables[0]).collect()
    assert rows and {"doc_id", "shard", "slot"} <= set(rows[0].asDict())
    assert len({r.doc_id for r in rows}) == len(rows)


def test_empty_documents(spark, tables, docs_of):
    docs = docs_of([])
    for _, step in P.STAGES:
        docs = step(spark, docs, tables[0])
        assert docs.count() == 0


def test_import_errors_are_not_swallowed():
    assert not re.search(r"except (ImportError|ModuleNotFoundError)", open(P.__file__).read())


def test_columns_with_the_names_that_operators_add_pass_through(spark, tables, docs_of):
    from pyspark.sql import functions as F

    names = ("_score", "_predicted", "_found", "_n_words", "_n_hit", "_items", "_contaminated", "_key",
             "_source", "_topic", "_probability", "_sampled", "_tokens", "row", "t", "id")
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").withColumns({n: F.lit(n) for n in names})
    for name, step in P.STAGES[:-1]:
        docs = step(spark, docs, tables[0])
        assert docs.columns[-len(names) :] == list(names), name
        row = docs.first()
        assert all(row[n] == n for n in names), name


def test_texts_that_share_an_id_are_judged_apart(spark, tables, docs_of):
    rng = random.Random(51)
    a, b, c = (prose(rng, 60, 10**6) for _ in range(3))
    docs = docs_of([(1, a), (2, a + " tail"), (2, b), (None, c), (None, c + " tail")])
    left = P.STAGES[1][1](spark, docs, tables[0]).collect()
    assert sorted((r.doc_id or 0, r.text.split()[0]) for r in left) == sorted(
        [(1, a.split()[0]), (2, b.split()[0]), (0, c.split()[0])]
    )
