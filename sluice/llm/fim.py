"""Fill-in-middle examples by repeated-capture matching.

A text is a sequence of units: runs of ASCII letters, or one other code point. One
``fullmatch`` of ``(unit)*`` with the regex library, which keeps every repetition of
a group, gives all unit ends at once: their number is ``n``, and the two cuts are
looked up in them. Nothing is iterated in Python. Texts of more than
``PART_CHARS`` code points are matched part by part, each cut behind a code point
that is no letter and thus a unit end, so memory stays bounded; a letter run is
never cut, however long.

Cuts and forms derive from the SHA-256 of ``<seed>:<id>``: its first four 8-digit
groups are h1 to h4. The prefix ends after the smaller of h1 % (n+1) and h2 % (n+1)
units, the middle after the larger. A text that is empty or holds a marker stays
plain, and so do the ids with h3 % 100 >= ``plain_from``; the others are ``spm`` if
h4 % 100 < ``spm_below``, else ``psm``. No part of a marked text holds a marker, and
no marker overlaps itself, so :func:`restore` finds the parts again.

Scale: one narrow pass over the texts, no shuffle.

Defined cases: null text is empty; a null id is hashed as the empty string; rows
that repeat give the same example; columns other than id and text are not read,
whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.llm import words as W
from sluice.llm.common import ship, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Possessive, so a unit is never given back and no way back is stored.
UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
_NO_LETTER = regex.compile(r"[^A-Za-z]")
PART_CHARS = 1 << 20


def unit_ends(text: str, part_chars: int = PART_CHARS):
    """End offsets (code points) of all units, in order."""
    if len(text) <= part_chars:
        return UNITS.fullmatch(text).ends(1)
    ends, at = [], 0
    while at < len(text):
        cut = _NO_LETTER.search(text, min(at + part_chars, len(text)) - 1)
        stop = cut.end() if cut else len(text)
        ends.append(np.array(UNITS.fullmatch(text[at:stop]).ends(1), np.int64) + at)
        at = stop
    return np.concatenate(ends)


def transform(
    text: str, digest: str, plain_from: int = 90, spm_below: int = 20, part_chars: int = PART_CHARS
) -> tuple[int, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of one text; ``digest`` is the
    hexadecimal hash that decides."""
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    ends = unit_ends(text, part_chars)
    n = len(ends)
    if not text or h3 % 100 >= plain_from or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a = int(ends[low - 1]) if low else 0
    b = int(ends[high - 1]) if high else 0
    if h4 % 100 < spm_below:
        output = f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
        return n, "spm", a, b - a, output
    return n, "psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"


def _example_rows(schema: pa.Schema, plain_from: int, spm_below: int, part_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, 1)):
            rows = [
                transform(text, digest, plain_from, spm_below, part_chars)
                for text, digest in zip(
                    batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
                )
            ]
            made = [
                pa.array(column, field.type)
                for column, field in zip(zip(*rows, strict=True), list(schema)[1:], strict=True)
            ]
            yield pa.record_batch([batch.column(0), *made], schema)

    return run


def fim_examples(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1",
    plain_from: int = 90,
    spm_below: int = 20,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """``<id_col>, n, form, prefix_chars, middle_chars, output`` per document."""
    ship(docs.sparkSession)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(id_col),
        text_or_empty(text_col).alias("text"),
        F.sha2(key, 256).alias("digest"),
    )
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.StringType()),
        ]
    )
    run = _example_rows(to_arrow_schema(schema), plain_from, spm_below, part_chars)
    return rows.mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The exact text from an example and its form."""

    def between(first: str, second: str) -> tuple[Column, Column, Column]:
        """The three parts behind a leading ``first``, a ``second`` and the middle marker."""
        at = F.instr(output, second)
        end = F.instr(output, MIDDLE)
        size = len(first)
        return (
            F.substring(output, F.lit(size + 1), at - F.lit(size + 1)),
            F.substring(output, at + F.lit(size), end - at - F.lit(size)),
            F.substring(output, end + F.lit(size), F.length(output)),
        )

    prefix, suffix, middle = between(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = between(SUFFIX, PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
