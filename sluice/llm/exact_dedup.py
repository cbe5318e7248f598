"""Exact duplicate removal by deterministic block naming.

A normalised text is cut into blocks of a fixed number of code points. Distinct
blocks are sorted and numbered, so every block becomes an integer name; adjacent
names are paired, the distinct pairs sorted and numbered again, and so on until
each document has one name. Two documents of the same block count share that
name exactly when all their blocks are equal: no step trusts a hash.

Scale: block text is shuffled once, after map-side removal of repeats, to
number the distinct blocks; occurrences then travel as 64-bit integers. A block
that fills a third of the table leaves each map task as one row, and the joins
that hand names back to occurrences are plain equi-joins on a unique key, which
adaptive execution splits when one key is hot. The number of rounds is the
logarithm of the longest document's block count.

Defined cases: null text counts as empty; an empty text is one empty block;
rows that repeat the same id and text are one member each of their group and
only the first of them is kept; a null id sorts first; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import SPACE_CLASS, is_empty, stage, text_or_empty

BLOCK_CHARS = 2048


def normalised(col: str = "text") -> Column:
    """Text with every run of ASCII white space replaced by one space."""
    return F.regexp_replace(text_or_empty(col), f"{SPACE_CLASS}+", " ")


def _blocks(norm: Column, block_chars: int) -> Column:
    cut = F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(F.length(norm) == 0, F.array(F.lit(""))).otherwise(cut)


def _numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """Distinct rows in sorted order with an integer name (staged, so it never changes)."""
    ranked = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    return ranked.withColumn("name", F.monotonically_increasing_id())


def _name_blocks(occ: DataFrame, hash_of: Column) -> tuple[DataFrame, DataFrame]:
    """Name every block occurrence (``rid, pos, n, block, ...``).

    The hash only routes: blocks that share one are listed and told apart by
    their text, so a collision costs a second join, never a wrong name.
    """
    keyed = occ.withColumn("h", hash_of)
    variants = (
        keyed.groupBy("h")
        .agg(F.array_sort(F.collect_set("block")).alias("texts"))
        .select(
            "h",
            F.size("texts").alias("n_variants"),
            F.posexplode("texts").alias("variant", "variant_text"),
        )
        # Only colliding blocks need their text again.
        .withColumn("variant_text", F.when(F.col("n_variants") > 1, F.col("variant_text")))
    )
    names = stage(_numbered(variants, ["h", "variant"]), "block-names")
    named = keyed.drop("block").join(
        names.filter("n_variants = 1").select("h", "name"), "h"
    )
    clash = names.filter("n_variants > 1").select("h", F.col("variant_text").alias("block"), "name")
    if not is_empty(clash):
        named = named.unionByName(keyed.join(clash, ["h", "block"]).drop("block"))
    return named.drop("h"), names


def document_names(
    docs: DataFrame,
    block_chars: int = BLOCK_CHARS,
    hash_of: Column | None = None,
) -> DataFrame:
    """``doc_id, copies, text_sha256, n_blocks, name`` per distinct (id, text).

    ``copies`` counts repeated rows. ``hash_of`` replaces the routing hash of
    ``block`` (tests force collisions with it).
    """
    norm = normalised()
    occ = (
        docs.select(F.col("doc_id").alias("doc_id"), norm.alias("norm"))
        .select(
            F.struct(
                "doc_id",
                F.xxhash64("norm").alias("fp"),
                F.length("norm").alias("len"),
            ).alias("rid"),
            F.unhex(F.sha2("norm", 256)).alias("sha"),
            F.posexplode(_blocks(F.col("norm"), block_chars)).alias("pos", "block"),
        )
        # The digest travels with the first block only.
        .withColumn("sha", F.when(F.col("pos") == 0, F.col("sha")))
    )
    named, _ = _name_blocks(occ, F.xxhash64("block") if hash_of is None else hash_of)
    level = stage(
        named.groupBy("rid")
        .agg(
            F.array_sort(F.collect_set(F.struct("pos", "name"))).alias("seq"),
            F.sum((F.col("pos") == 0).cast("long")).alias("copies"),
            F.max("sha").alias("sha"),
        )
        .select("rid", "copies", "sha", F.size("seq").alias("n_blocks"), "seq.name"),
        "block-sequences",
    )
    head = level.filter("n_blocks = 1")
    done = head.select("rid", "copies", "sha", "n_blocks", F.col("name")[0].alias("name"))
    open_rows = level.filter("n_blocks > 1")
    info = open_rows.select("rid", "copies", "sha", "n_blocks")
    open_rows = open_rows.select("rid", "name")
    finished = []
    while not is_empty(open_rows):
        pairs = open_rows.select("rid", F.size("name").alias("m"), F.col("name")).select(
            "rid",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(0), F.expr("(m - 1) div 2").cast("int")),
                    # An odd tail pairs with -1, which no name takes.
                    lambda i: F.struct(
                        F.get("name", i * 2).alias("a"),
                        F.coalesce(F.get("name", i * 2 + 1), F.lit(-1)).alias("b"),
                    ),
                )
            ).alias("pos", "pair"),
        ).select("rid", "pos", "pair.a", "pair.b")
        names = stage(_numbered(pairs.select("a", "b").distinct(), ["a", "b"]), "pair-names")
        level = stage(
            pairs.join(names, ["a", "b"])
            .groupBy("rid")
            .agg(F.array_sort(F.collect_set(F.struct("pos", "name"))).alias("seq"))
            .select("rid", "seq.name"),
            "pair-sequences",
        )
        finished.append(
            level.filter(F.size("name") == 1).select("rid", F.col("name")[0].alias("name"))
        )
        open_rows = level.filter(F.size("name") > 1)
    if finished:
        tops = finished[0]
        for more in finished[1:]:
            tops = tops.unionByName(more)
        done = done.unionByName(info.join(tops, "rid").select(done.columns))
    return done.select(
        "rid.doc_id",
        "copies",
        F.lower(F.hex("sha")).alias("text_sha256"),
        "n_blocks",
        "name",
    )


def exact_dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of rows with equal normalised texts the one with the smallest id stays.
    """
    named = stage(document_names(docs, block_chars), "document-names")
    groups = named.groupBy("n_blocks", "name").agg(
        F.min(F.struct("doc_id")).alias("least"), F.sum("copies").alias("group_size")
    )
    return (
        named.join(groups, ["n_blocks", "name"])
        .select(
            "doc_id",
            F.col("least.doc_id").alias("keep_id"),
            "group_size",
            "text_sha256",
            F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        )
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
