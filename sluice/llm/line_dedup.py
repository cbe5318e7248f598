"""Line dedup by overlapping three-line windows.

Every three consecutive lines form a window. A window that occurs more than
once in the corpus keeps its first occurrence (smallest document id, then
line); all later ones cover their three lines, covered positions are merged per
document, and covered lines go. Windows are judged on the input.

Scale: one row per line goes through a map-side aggregate on the window's
128-bit digest; only digests seen twice are joined back (skew-splittable), and
document texts are joined once with the small table of covered positions.

Defined cases: null text counts as empty and comes back empty; documents of
fewer than three lines have no window and stay as they are; repeated rows with
equal id and text are one document; a null id sorts first; extra columns pass
through :func:`dedup_lines` unchanged; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import text_or_empty

WINDOW_LINES = 3


def _rid():
    """Row identity: the id with a digest of the text (ids may repeat)."""
    return F.struct(F.col("doc_id"), F.xxhash64(text_or_empty()).alias("fp"))


def line_windows(docs: DataFrame, width: int = WINDOW_LINES) -> DataFrame:
    """``rid, pos, digest`` for every window of ``width`` consecutive lines."""
    lines = docs.select(_rid().alias("rid"), F.split(text_or_empty(), "\n").alias("lines"))
    windows = F.transform(
        F.sequence(F.lit(0), F.size("lines") - width),
        lambda i: F.unhex(F.md5(F.array_join(F.slice("lines", i + 1, width), "\n"))),
    )
    return lines.filter(F.size("lines") >= width).select(
        "rid", F.posexplode(windows).alias("pos", "digest")
    )


def covered_lines(docs: DataFrame, width: int = WINDOW_LINES) -> DataFrame:
    """``rid, covered`` (sorted line positions) for documents that lose lines."""
    windows = line_windows(docs, width)
    # First and last occurrence; equal ones mean a single place (or repeated rows of it).
    firsts = (
        windows.groupBy("digest")
        .agg(
            F.min(F.struct("rid", "pos")).alias("first"),
            F.max(F.struct("rid", "pos")).alias("last"),
        )
        .filter("first != last")
        .drop("last")
    )
    later = windows.join(firsts, "digest").filter(
        F.struct("rid", "pos") != F.col("first")
    )
    return (
        later.groupBy("rid")
        .agg(F.collect_set("pos").alias("starts"))
        .select(
            "rid",
            F.array_sort(
                F.array_distinct(
                    F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (width - 1))))
                )
            ).alias("covered"),
        )
    )


def dedup_lines(docs: DataFrame, width: int = WINDOW_LINES) -> DataFrame:
    """The documents with covered lines removed; adds ``_n_lines``, ``_n_removed``."""
    keyed = docs.withColumn("_rid", _rid())
    covered = covered_lines(docs, width).select(F.col("rid").alias("_rid"), "covered")
    lines = F.split(text_or_empty(), "\n")
    out = keyed.join(covered.withColumnRenamed("covered", "_covered"), "_rid", "left").withColumn(
        "_lines", lines
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_covered"))
    kept = F.transform(stay, lambda i: F.get("_lines", i))
    return (
        out.withColumn("_n_lines", F.size("_lines").cast("long"))
        .withColumn("_n_removed", F.when(F.col("_covered").isNull(), 0).otherwise(F.size("_covered")).cast("long"))
        .withColumn(
            "text",
            F.when(F.col("_covered").isNull(), text_or_empty()).otherwise(F.array_join(kept, "\n")),
        )
        .drop("_rid", "_covered", "_lines")
    )
