"""Chat formatting by schema fingerprint.

Records of any layout become variants; the nested field paths of each record
(its variant schema without scalar types) are hashed, and the hash selects a
declarative mapping to canonical turns. Turns are gathered per conversation and
written with a template whose control strings are escaped inside texts, so the
output can be read back without loss.

Template, per turn: ``<turn>`` role newline text ``</turn>`` newline. Inside
roles and texts a backslash becomes ``\\b``, and the ``<`` of ``<turn`` or
``</turn`` becomes ``\\l``; newlines of a role become ``\\n``. Reading back
replaces ``\\n`` (roles), ``\\l``, then ``\\b``: after escaping every backslash
starts one of these, so the order is safe.

Defined cases: null text or role counts as empty; turns sort by turn (null
first), then role, then text, and repeated rows stay repeated; a record whose
fingerprint no mapping declares keeps its row in :func:`canonical_turns` with a
null layout and no turn; extra columns are ignored; an empty table gives an
empty result. One conversation is one output string, so it must fit in one row.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
#: Scalar types of a variant schema, removed before hashing.
_SCALARS = r"(STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|DATE|TIMESTAMP_NTZ|TIMESTAMP|BINARY|UUID|DECIMAL\(\d+,\s?\d+\))"
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """How one record layout becomes turns.

    ``fields`` are the top-level fields with the schema below them (empty for a
    scalar); a trailing ``?`` marks a field that may be absent. ``turns`` is a
    SQL expression over the variant ``v`` of type array<struct<turn,role,text>>.
    """

    name: str
    fields: tuple[tuple[str, str], ...]
    turns: str

    def shapes(self) -> list[str]:
        """Every typeless schema string that this layout accepts."""
        choices = [
            (None, (f[:-1], s)) if f.endswith("?") else ((f, s),) for f, s in self.fields
        ]
        out = []
        for pick in product(*choices):
            inner = ", ".join(f"{f}: {s}" for f, s in sorted(x for x in pick if x))
            out.append(f"OBJECT<{inner}>")
        return out


def _get(path: str, kind: str = "string") -> str:
    return f"try_variant_get(v, '$.{path}', '{kind}')"


def _named(*parts: tuple[str, str]) -> str:
    """Turns from scalar fields, numbered in order; absent or null ones are left out."""
    items = ", ".join(
        f"named_struct('turn', {i}L, 'role', '{role}', 'text', {_get(field)})"
        for i, (role, field) in enumerate(parts)
    )
    return f"filter(array({items}), x -> x.text is not null)"


def _listed(path: str, role: str, text: str) -> str:
    """Turns from a list of objects; null texts stay (as empty)."""
    got = _get(path, f"array<struct<{role}:string,{text}:string>>")
    return (
        f"transform({got}, (x, i) -> named_struct('turn', cast(i as bigint), "
        f"'role', x.{role}, 'text', x.{text}))"
    )


LAYOUTS = (
    Layout(
        "turn_row",
        (("turn", ""), ("role", ""), ("text", "")),
        f"array(named_struct('turn', {_get('turn', 'bigint')}, 'role', {_get('role')}, "
        f"'text', {_get('text')}))",
    ),
    Layout(
        "messages",
        (("messages", "ARRAY<OBJECT<content: , role: >>"),),
        _listed("messages", "role", "content"),
    ),
    Layout(
        "conversations",
        (("conversations", "ARRAY<OBJECT<from: , value: >>"), ("system?", "")),
        "concat("
        + _named(("system", "system"))
        + ", transform("
        + _listed("conversations", "from", "value")
        + ", x -> named_struct('turn', x.turn + 1, 'role', CASE x.role WHEN 'human' THEN 'user' "
        "WHEN 'gpt' THEN 'assistant' ELSE x.role END, 'text', x.text)))",
    ),
    Layout(
        "prompt_response",
        (("prompt", ""), ("response", ""), ("system?", "")),
        _named(("system", "system"), ("user", "prompt"), ("assistant", "response")),
    ),
    Layout(
        "prompt_completion",
        (("prompt", ""), ("completion", "")),
        _named(("user", "prompt"), ("assistant", "completion")),
    ),
    Layout(
        "instruction",
        (("instruction", ""), ("input?", ""), ("output", "")),
        "array(named_struct('turn', 0L, 'role', 'user', 'text', concat_ws('\\n\\n', "
        + _get("instruction")
        + f", nullif({_get('input')}, ''))), named_struct('turn', 1L, 'role', 'assistant', "
        + f"'text', {_get('output')}))",
    ),
    Layout(
        "question_answer",
        (("question", ""), ("answer", ""), ("context?", "")),
        _named(("system", "context"), ("user", "question"), ("assistant", "answer")),
    ),
)


def shape_of(v: Column) -> Column:
    """Nested field paths of a variant: its schema without scalar types."""
    return F.regexp_replace(F.schema_of_variant(v), rf"\b{_SCALARS}\b(?=[,>]|$)", "")


def fingerprint(v: Column) -> Column:
    """64-bit hash of the nested field paths."""
    return F.xxhash64(shape_of(v))


def canonical_turns(records: DataFrame, key: str, record: str) -> DataFrame:
    """``key, layout, turn, role, text`` rows from variant records.

    A record of an undeclared layout yields one row with null layout and role.
    """
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    fp = F.col("_fp")
    for spec in reversed(LAYOUTS):
        hit = fp.isin([F.xxhash64(F.lit(s)) for s in spec.shapes()])
        layout = F.when(hit, F.lit(spec.name)).otherwise(layout)
        turns = F.when(hit, F.expr(spec.turns).cast(_TURNS)).otherwise(turns)
    return (
        records.select(F.col(key).alias("key"), F.col(record).alias("v"))
        .withColumn("_fp", fingerprint(F.col("v")))
        .select("key", layout.alias("layout"), F.explode_outer(turns).alias("t"))
        .select(F.col("key").alias(key), "layout", "t.turn", "t.role", "t.text")
    )


def escape(text: Column) -> Column:
    """Escape control strings; see the module text."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b"))
    out = F.replace(out, F.lit("<turn"), F.lit("\\lturn"))
    return F.replace(out, F.lit("</turn"), F.lit("\\l/turn"))


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _run(n_chars: Column, loss: Column) -> Column:
    return F.struct(n_chars.alias("n_chars"), loss.alias("loss"))


def format_chats(turns: DataFrame, key: str) -> DataFrame:
    """``key, formatted, loss_runs`` per conversation from canonical turns.

    ``loss_runs`` covers ``formatted`` from its start as (n_chars, loss) runs;
    loss is true for assistant texts only, never for markers or headers. Records of an
    undeclared layout (null ``layout``) have no turns and are left out.
    """
    if "layout" in turns.columns:
        turns = turns.filter("layout is not null")
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n"))
    rows = turns.select(
        F.col(key).alias(key),
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.concat(F.lit(OPEN), role, F.lit("\n")).alias("head"),
            escape(F.col("text")).alias("body"),
        ).alias("t"),
    )
    chats = rows.groupBy(key).agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return chats.select(
        key,
        F.array_join(
            F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), ""
        ).alias("formatted"),
        F.flatten(
            F.transform(
                "ts",
                lambda t: F.array(
                    _run(F.length(t["head"]), F.lit(False)),
                    _run(F.length(t["body"]), t["role"] == "assistant"),
                    _run(F.lit(len(CLOSE)), F.lit(False)),
                ),
            )
        ).alias("loss_runs"),
    )


def read_back(formatted: Column, loss_runs: Column) -> Column:
    """Turns of a formatted conversation: array of struct(role, text, loss)."""
    pieces = F.split(formatted, CLOSE)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column, i: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        body = F.right(piece, F.length(piece) - F.length(head) - 1)
        role = F.replace(F.right(head, F.length(head) - len(OPEN)), F.lit("\\n"), F.lit("\n"))
        return F.struct(
            unescape(role).alias("role"),
            unescape(body).alias("text"),
            # Runs come in threes: head, text, close.
            F.get(loss_runs, i * 3 + 1)["loss"].alias("loss"),
        )

    return F.transform(pieces, turn)


def chat_digests(chats: DataFrame, key: str) -> DataFrame:
    """Digest columns read back from the formatted output."""
    under = F.filter("turns", lambda t: t["loss"])
    loss = F.array_join(F.transform(under, lambda t: t["text"]), "")
    return (
        chats.withColumn("turns", read_back(F.col("formatted"), F.col("loss_runs")))
        .withColumn("loss", loss)
        .select(
            key,
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(
                F.array_join(
                    F.transform(
                        "turns",
                        lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")),
                    ),
                    "",
                ),
                256,
            ).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )
