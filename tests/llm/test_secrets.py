from __future__ import annotations

import itertools
import re

import numpy as np

from llm_helpers import CLASHING, docs_of, prose  # noqa: F401
from sluice.llm import secrets_crf as S


def brute(text):
    """The base rules read literally."""
    out = []
    for m in re.finditer(
        r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
        r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text,
    ):
        if len(m[1]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


TEXTS = [
    "",
    'password="abcdef" passwd = short API_KEY:"' + "a" * 30 + '" apikey=x.y-z/1+2=',
    "toKen: 'É' token=abc token=token=abcdefgh ſecret=abcdefgh",
    "é" * 30 + " AKIA" + "A1" * 10 + " AKIAshort " + "0f" * 12 + "g" + "ab" * 11,
    "secret :  = abcdefgh secret\n=abcdefgh password = password = hunter2x",
    "deadbeef" * 40,
]


def test_base_spans_are_those_of_the_rules():
    for text in TEXTS:
        assert S.base_spans(text) == brute(text)


def documents():
    import random

    rng = random.Random(9)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    out = []
    for i in range(300):
        value = "".join(rng.choice(alphabet) for _ in range(rng.randrange(24, 40)))
        line = f'{rng.choice(["password", "api_key", "token"])} = "{value}"' if i % 3 == 0 else ""
        dates = f"on 2024-0{rng.randrange(1, 9)}-11 and {rng.randrange(9999)} of v1.{i}"
        out.append((i, f"{prose(rng, 30)} {dates}\n{line}\n{prose(rng, 20)}"))
    return out


def test_field_finds_unlabelled_forms_and_leaves_plain_text_alone(spark, docs_of):
    docs = docs_of(documents(), CLASHING)
    field = S.train(docs)
    unseen = 'The words of a page. credential = "Zk39fQx81LmPq7Rt0YvB2nWc" and more words.'
    spans = [s for s in S.find(unseen, field) if s[0] == "crf"]
    assert [unseen[a:b] for _, a, b in spans] == ["Zk39fQx81LmPq7Rt0YvB2nWc"]
    plain = "Many plain words, in 2024 or on page 17, about version 1.2 of a token economy."
    assert S.find(plain, field) == []
    got = {r.doc_id: r for r in S.digests(docs, field).collect()}
    for i, text in documents():
        base = brute(text)
        assert got[i].n_assign == sum(k == "assign" for k, _, _ in base)
        assert set(S.digest(base).split(",")) <= set(got[i].spans.split(","))
    full = S.scan(docs, field)
    assert set(docs.columns) <= set(full.columns)


def test_letters_only_secrets_after_a_key_word_are_tagged_as_in_the_whole_document(spark, docs_of):
    values = ["correct-horse", "Abcd-EFGH", "hunterxy", "CorrectHorse"]
    docs = [
        (i, f"The words of a page with more words\npassword: {values[i % 4]}\nand then {'many plain words ' * 9}")
        for i in range(200)
    ]
    field = S.train(docs_of(docs, CLASHING))
    for line in ("passphrase: correct-horse", 'credential "Abcd-EFGH"', "auth: hunterx"):
        text = f"The words of a page\n{line}\nand then {'many plain words ' * 9}"
        value = re.findall(r"[\w-]+", line)[1]
        covered = [text[a:b] for run in S.runs_of(text) for a, b in run]
        assert value in covered
        whole = [(m.start(), m.end()) for m in S._TOKEN.finditer(text)]
        tags = field.decode(S.featurise(text, whole, S.file_features(text, len(S.runs_of(text)))))
        wanted = [text[a:b] for (a, b), t in zip(whole, tags, strict=True) if t == S.BEGIN]
        assert [text[a:b] for _, a, b in S.find(text, field)] == wanted
        if ":" in line:
            assert wanted == [value]


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5):
        field = S.Field(rng.normal(size=(len(S.FEATURES), 3)), rng.normal(size=(3, 3)))
        x = (rng.random((n, len(S.FEATURES))) < 0.3).astype(np.float32)
        scores = x @ field.emission

        def total(path, scores=scores, field=field):
            moves = [S.OUTSIDE, *path, S.OUTSIDE]
            return sum(scores[i, t] for i, t in enumerate(path)) + sum(
                field.moves[a, b] for a, b in itertools.pairwise(moves)
            )

        best = max(itertools.product(range(3), repeat=n), key=total)
        assert np.isclose(total(best), total(tuple(field.decode(x))))


def test_the_sample_holds_secrets_however_rare_they_are(spark, docs_of, monkeypatch):
    monkeypatch.setattr(S, "TRAIN_DOCS", 20)
    docs = [(i, f"Plain words of page {i} and more plain words") for i in range(10_000)]
    docs[4321] = (4321, "The words of a page\npassword: Zk39fQx81LmPq7Rt\nand more words")
    assert S.train(docs_of(docs, CLASHING)) is not None


def test_no_training_data_empty_table_and_nulls(spark, docs_of):
    assert S.train(docs_of([])) is None
    assert S.train(docs_of([(1, None), (2, "plain words only")])) is None
    assert S.digests(docs_of([]), None).count() == 0
    row = S.digests(docs_of([(1, None)]), None).first()
    assert (row.n_assign, row.spans) == (0, "")
