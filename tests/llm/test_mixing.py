from __future__ import annotations

import random

from pyspark.sql import functions as F

from llm_helpers import CLASHING, docs_of, prose  # noqa: F401
from sluice.llm import mixing


def test_marginals_meet_their_targets(spark):
    rng = random.Random(3)
    cells = [
        (f"s{s}", f"l{n}", f"t{t}", rng.randrange(1, 1000))
        for s in range(4) for n in range(3) for t in range(2)
    ]
    cells = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    targets = {d: mixing.tempered_targets(cells, d, 0.5) for d in mixing.DIMS}
    raked = mixing.rake(cells, targets, rounds=30)
    for d, target in targets.items():
        want = {r[d]: r.target for r in target.collect()}
        got = {r[d]: r.w for r in raked.groupBy(d).agg({"weight": "sum"}).toDF(d, "w").collect()}
        assert all(abs(got[k] - w) < 1e-6 for k, w in want.items())


def test_sampling_follows_the_probabilities(spark, docs_of):
    rng = random.Random(4)
    pairs = [(i, prose(rng, 20)) for i in range(3000)] + [(None, None), (5000, ""), (1, "x y")]
    rows = mixing.sample_to_targets(docs_of(pairs, CLASHING)).collect()
    assert len(rows) == len(pairs)
    assert all(0 <= r._probability <= 1 for r in rows)
    expected = sum(r._probability for r in rows)
    assert abs(sum(r._sampled for r in rows) - expected) < 5 * max(1, expected) ** 0.5


def test_keep_share_bounds_what_is_dropped(spark):
    rng = random.Random(5)
    rows = [
        (i, prose(rng, 20), rng.choice(["en", "en", "en", "de", None]), "hot" if i % 3 else f"s{i % 7}", 1)
        for i in range(2000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.sample_to_targets(docs, alpha=0.5, keep=0.8).collect()
    expected = sum(r._probability * r._tokens for r in got) / sum(r._tokens for r in got)
    assert abs(expected - 0.8) < 1e-6
    assert {r._lang for r in got} == {"en", "de", "(null)"}


def test_kept_marginals_meet_milder_targets(spark):
    rng = random.Random(6)
    rows = [
        (
            i,
            prose(rng, 20) + (" a@b.example" if rng.random() < 0.03 else ""),
            rng.choices(["en", "de", "fr"], [80, 17, 3])[0],
            rng.choices(["web", "books", "mail"], [90, 8, 2])[0],
            1,
        )
        for i in range(4000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.sample_to_targets(docs, keep=0.8).collect()
    total = sum(r._tokens for r in got)
    steps = []
    for dim in mixing.DIMS:
        shares, now, drawn = {}, {}, {}
        for r in got:
            value = r[f"_{dim}"]
            shares[value] = shares.get(value, 0) + r._tokens / total
            now[value] = now.get(value, 0) + r._tokens * r._probability
            drawn[value] = drawn.get(value, 0) + r._tokens * r._sampled
        raised = {k: v**mixing.ALPHA for k, v in shares.items()}
        for k in shares:
            target = raised[k] / sum(raised.values())
            steps.append((now[k] / sum(now.values()) - shares[k]) / (target - shares[k]))
            assert abs(drawn[k] / sum(drawn.values()) - now[k] / sum(now.values())) < 0.02
    # Every marginal has gone the same part of the way to its target.
    assert 0 < min(steps) and max(steps) - min(steps) < 0.01 * max(steps)
    assert abs(sum(r._probability * r._tokens for r in got) / total - 0.8) < 1e-6


def test_empty_table_and_no_tokens(spark, docs_of):
    assert mixing.sample_to_targets(docs_of([])).count() == 0
    assert mixing.sample_to_targets(docs_of([]), keep=0.5).count() == 0
    got = mixing.sample_to_targets(docs_of([(1, None), (2, "  ")])).collect()
    assert all(r._sampled for r in got)


def test_decisions_are_those_of_the_documents_whatever_their_columns_are_called(spark, docs_of):
    rng = random.Random(21)
    pairs = [(i, rng.choice(("copyright x", "see https://a.b", "plain words", "", None)) ) for i in range(200)]
    schema = CLASHING + ", _probability double, _topic string, _source string, probability int, topic int"
    got = {
        r.doc_id: (r.source, r.lang, r.topic, r.tokens, round(r.probability, 9), r.sampled)
        for r in mixing.sampling_decisions(docs_of(pairs, schema)).collect()
    }
    want = {
        r.doc_id: (r._source, r._lang, r._topic, r._tokens, round(r._probability, 9), r._sampled)
        for r in mixing.sample_to_targets(docs_of(pairs)).collect()
    }
    assert got == want and len(got) == 200


def test_raked_marginals_meet_their_targets(spark, docs_of):
    rng = random.Random(22)
    texts = ("copyright " * 3, "see https://a.b", "plain words here", "999999 n")
    pairs = [(i, rng.choice(texts) * rng.randrange(1, 4)) for i in range(300)]
    cells = (
        mixing.with_cells(docs_of(pairs))
        .groupBy(*[F.col(f"_{d}").alias(d) for d in mixing.DIMS])
        .agg(F.sum("_tokens").alias("tokens"))
    )
    targets = {d: mixing.tempered_targets(cells, d) for d in mixing.DIMS}
    assert mixing.marginal_gap(mixing.rake(cells, targets), targets) < 1e-6
