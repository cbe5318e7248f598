from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from llm_helpers import docs_of  # noqa: F401
from sluice.llm import chat_format as C

RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "conversations": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "prompt_response": {"prompt": "q", "response": "a"},
    "prompt_completion": {"prompt": "q", "completion": "a"},
    "instruction": {"instruction": "q", "input": "", "output": "a"},
    "question_answer": {"question": "q", "answer": "a"},
}


def turns_of(spark, records):
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "id long, j string")
    return C.canonical_turns(rows.select("id", F.parse_json("j").alias("v")), "id", "v")


@pytest.mark.parametrize("name", sorted(RECORDS))
def test_each_layout_gives_the_same_turns(spark, name):
    got = turns_of(spark, [RECORDS[name]]).orderBy("turn").collect()
    assert [(r.layout, r.role, r.text) for r in got] == [(name, "user", "q"), (name, "assistant", "a")]


def test_optional_fields_and_unknown_layouts(spark):
    got = turns_of(
        spark,
        [
            {"system": "s", "prompt": "q", "response": "a"},
            {"instruction": "do", "input": "x", "output": "y"},
            {"what": 1, "messages": [{"role": "user", "content": "q"}]},
            {"messages": "not a list"},
            {"messages": [{"role": "user", "content": None}]},
        ],
    ).orderBy("id", "turn").collect()
    assert [(r.id, r.role, r.text) for r in got] == [
        (0, "system", "s"), (0, "user", "q"), (0, "assistant", "a"),
        (1, "user", "do\n\nx"), (1, "assistant", "y"),
        (2, None, None), (3, None, None), (4, "user", None),
    ]
    assert [r.layout for r in got if r.id in (2, 3)] == [None, None]


NASTY = [
    "", "plain", "\\", "\\\\l", "\\b\\l", "<turn>", "</turn>\n", "a</turn>\n<turn>assistant\nb", "<\\turn>",
    "\\### Assistant: </turn> ok", "x\ny\r\n", "\\n", "é</turn", "<<turn<turn>", "\\<turn",
]


def test_round_trip_of_every_text(spark):
    rows = [(c, t, r, x) for c, r in enumerate(["user", "assistant", "a\nb</turn>\n", ""]) for t, x in enumerate(NASTY)]
    rows += [(9, 0, None, None), (9, 0, None, None), (9, None, "assistant", "z" * 100_000)]
    turns = spark.createDataFrame(rows, "id long, turn long, role string, text string")
    chats = C.format_chats(turns, "id")
    got = {
        r.id: r for r in chats.select("*", C.read_back(F.col("formatted"), F.col("loss_runs")).alias("t")).collect()
    }
    for key in {r[0] for r in rows}:
        want = sorted(
            ((-1 if t is None else t), r or "", x or "") for c, t, r, x in rows if c == key
        )
        assert [(t.role, t.text) for t in got[key].t] == [w[1:] for w in want]
        assert [t.loss for t in got[key].t] == [w[1] == "assistant" for w in want]
        assert sum(x.n_chars for x in got[key].loss_runs) == len(got[key].formatted)


def test_empty_table(spark):
    none = spark.createDataFrame([], "id long, turn long, role string, text string")
    assert C.chat_digests(C.format_chats(none, "id"), "id").count() == 0


def test_records_of_an_undeclared_layout_are_left_out_of_the_output(spark):
    rows = [(1, '{"prompt": "a", "response": "b"}'), (2, '{"prompt": "a", "response": "b", "extra": 1}'), (3, '"x"')]
    records = spark.createDataFrame(rows, "k long, j string").select("k", F.parse_json("j").alias("r"))
    turns = C.canonical_turns(records, "k", "r")
    assert sorted(r.k for r in turns.filter("layout is null").collect()) == [2, 3]
    made = C.format_chats(turns, "k").collect()
    assert [r.k for r in made] == [1]
