from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from llm_helpers import CLASHING, docs_of, prose  # noqa: F401
from sluice.llm import fim


def brute(doc_id, text):
    """The rules read one by one."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def pairs_of():
    rng = random.Random(3)
    odd = ["", None, " ", "a", "\n", "<", "<P", "x<P>y", "<S><M>", "ab" * 500, "é<S", "😀" * 9,
           "a<\nS>b", "\x00 z", "1" * 40, "P>S>M>"]
    texts = odd + [prose(rng, rng.randrange(1, 60)) + rng.choice("<>\n. ") for _ in range(60)]
    return list(enumerate(texts, -5)) + [(None, "no id here"), (7, "twice"), (7, "twice")]


def rows_of(df):
    got = df.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    return sorted(
        ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got), key=repr
    )


def test_examples_match_the_rules_and_restore_exactly(spark, docs_of):
    pairs = pairs_of()
    want = sorted(((*brute(i, t), t or "") for i, t in pairs), key=repr)
    assert rows_of(fim.fim_examples(docs_of(pairs, CLASHING + ", n long, form int, output int"))) == want
    # Every text in tiny parts: nothing changes.
    assert rows_of(fim.fim_examples(docs_of(pairs), part_chars=3)) == want
    assert {w[2] for w in want} == {"plain", "spm", "psm"}


def test_unit_ends_are_those_of_the_pattern_in_any_parts():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("abZ \né_1") for _ in range(rng.randrange(40)))
        want = [m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
        for part in (1, 4, 1 << 20):
            assert list(fim.unit_ends(text, part)) == want


def test_a_very_long_text_keeps_every_unit():
    text = "ab, " * 600_000 + "z" * 3_000_000
    ends = fim.unit_ends(text)
    assert len(ends) == 1_800_001 and ends[-1] == len(text)


def test_string_ids_other_seed_and_empty_table(spark, docs_of):
    docs = spark.createDataFrame([("x-1", "some words here"), (None, "b")], "doc_id string, text string")
    a = {r.doc_id: r for r in fim.fim_examples(docs, plain_from=100, spm_below=0).collect()}
    b = {r.doc_id: r for r in fim.fim_examples(docs, seed="9", plain_from=100, spm_below=0).collect()}
    assert a["x-1"].form == "psm" and a["x-1"].output != b["x-1"].output
    assert fim.fim_examples(docs_of([])).count() == 0
