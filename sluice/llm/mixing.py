"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic). The cell weights are
raked: scaled to the source targets, then the language targets, then the topic
targets, for ``rounds`` rounds (:func:`marginal_gap` tells how far the marginals then are
from their targets). A cell's sampling
probability is its raked weight over its tokens, scaled so that the largest is
1. With ``keep`` the targets are milder: every marginal moves from its share of the
data towards its target by one common step, the largest at which the given share of
all tokens stays in expectation; no probability is cut. A document is kept when a uniform number derived from its id lies below the
probability of its cell.

Targets default to tempered shares: each marginal share to the power ``alpha``,
normalised. With alpha 1 nothing is dropped, with 0 all values weigh alike.

Scale: :func:`sampling_decisions` reads the texts once, into a narrow staged table of
ids, cells and token counts, from which the cells are summed (with map-side
aggregation) and to which the rates are joined (one row per cell).
:func:`sample_to_targets`, which passes whole documents on, reads them twice instead of
writing them once more. All raking runs on the cell table, never on documents, and a
source that holds a third of all rows is one cell sum per map task.

Defined cases: a null source or language is a value of its own ("(null)");
a cell without tokens has probability 0 unless no cell has tokens, when all is
kept; null ids draw as the empty
string; repeated rows draw the same number; extra columns pass through; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import stage, text_or_empty

#: Power of the marginal shares that gives the default targets.
ALPHA = 0.7
ROUNDS = 12
DIMS = ("source", "lang", "topic")
NULL_VALUE = "(null)"

#: Topic rules, first match wins: name and a pattern that the text must contain.
#: Plain ASCII patterns that mean the same in Java and RE2 regular expressions.
TOPICS = (
    ("legal", r"(?i)(licen[sc]e|copyright|warranty)"),
    ("contact", r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[a-z]"),
    ("web", r"https?://"),
    ("numeric", r"[0-9]{6}"),
)


def topic_of(text: Column) -> Column:
    """Topic of a text by the first rule whose pattern it contains, else "prose"."""
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def token_count(text: Column) -> Column:
    """Words separated by ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def with_cells(docs: DataFrame) -> DataFrame:
    """The documents with ``_source, _lang, _topic, _tokens``."""
    text = text_or_empty()
    return (
        docs.withColumn("_source", F.coalesce(F.col("source").cast("string"), F.lit(NULL_VALUE)))
        .withColumn("_lang", F.coalesce(F.col("lang").cast("string"), F.lit(NULL_VALUE)))
        .withColumn("_topic", topic_of(text))
        .withColumn("_tokens", token_count(text))
    )


def tempered_targets(cells: DataFrame, dim: str, alpha: float = ALPHA) -> DataFrame:
    """``dim, target``: marginal shares to the power ``alpha``, summing to one."""
    raised = cells.groupBy(dim).agg(F.pow(F.sum("tokens"), F.lit(alpha)).alias("raised"))
    total = raised.agg(F.sum("raised")).scalar()
    return raised.select(dim, (F.col("raised") / total).alias("target"))


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS
) -> DataFrame:
    """Cells with ``weight``: raked so that every marginal meets its target.

    ``cells`` has one row per (source, lang, topic) with ``tokens``; a target
    table has one row per value. Cells without tokens weigh nothing.
    """
    out = cells.filter("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for dim, target in targets.items():
        out = out.join(target.withColumnRenamed("target", f"t_{dim}"), dim)
    out = stage(out, "mix-cells")
    for i in range(rounds):
        for dim in targets:
            share = F.sum("weight").over(Window.partitionBy(dim))
            out = out.withColumn("weight", F.col("weight") * F.col(f"t_{dim}") / share)
        if (i + 1) % 4 == 0 and i + 1 < rounds:
            # Short plans: lineage is cut every few rounds.
            out = stage(out, "mix-round")
    return out


def _step_to_keep(rated: DataFrame, keep: float) -> tuple[float, float, float] | None:
    """``step, even, most``: how far (0 to 1) from the shares of the data to the targets
    the mix can go while the share ``keep`` of all tokens stays in expectation; the rate
    that gives each cell its share; the largest rate of the mix. ``None`` without tokens.
    """
    tokens, weight, most = (
        rated.filter("tokens > 0").agg(F.sum("tokens"), F.sum("weight"), F.max("rate")).first()
    )
    if not tokens or not weight:
        return None
    even = weight / tokens
    # The kept share is even over the largest rate, which is linear in the step.
    step = min(1.0, (1 / keep - 1) * even / (most - even)) if most > even * (1 + 1e-12) else 1.0
    return step, even, even + step * (most - even)


def cell_probabilities(
    docs: DataFrame, alpha: float = ALPHA, rounds: int = ROUNDS,
    targets: dict[str, DataFrame] | None = None, keep: float | None = None,
) -> DataFrame:
    """``source, lang, topic, n_docs, tokens, weight, probability`` per cell."""
    return _probabilities(with_cells(docs), alpha, rounds, targets, keep)


def _probabilities(
    placed: DataFrame, alpha: float, rounds: int, targets: dict[str, DataFrame] | None, keep: float | None
) -> DataFrame:
    """The cell table of documents that have their cells (:func:`with_cells`)."""
    cells = stage(
        placed.groupBy(*[F.col(f"_{d}").alias(d) for d in DIMS])
        .agg(F.count("*").alias("n_docs"), F.sum("_tokens").alias("tokens")),
        "mix-sums",
    )
    if targets is None:
        live = cells.filter("tokens > 0")
        targets = {d: tempered_targets(live, d, alpha) for d in DIMS}
    raked = stage(rake(cells, targets, rounds).select(*DIMS, "weight"), "mix-weights")
    rated = cells.join(raked, list(DIMS), "left").withColumn(
        "rate", F.coalesce(F.col("weight") / F.col("tokens"), F.lit(0.0))
    )
    if keep is None:
        most = rated.agg(F.max("rate")).scalar()
        probability = F.when(most > 0, F.col("rate") / most).otherwise(F.lit(1.0))
    else:
        rated = stage(rated, "mix-rated")
        milder = _step_to_keep(rated, keep)
        probability = F.lit(1.0)
        if milder is not None:
            step, even, most = milder
            # Even and raked weights in one mix: its marginals are shares and targets in
            # the same mix. Cells without tokens weigh nothing; they stay.
            mixed = F.lit(even * (1 - step)) + F.col("rate") * F.lit(step)
            probability = F.when(
                F.col("tokens") > 0, F.least(F.lit(1.0), mixed / F.lit(most))
            ).otherwise(F.lit(1.0))
    return rated.select(
        *DIMS,
        "n_docs",
        "tokens",
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        probability.alias("probability"),
    )


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from the id: the first 52 bits of its MD5."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def marginal_gap(cells: DataFrame, targets: dict[str, DataFrame]) -> float:
    """Largest difference of a marginal of raked cells from its target, relative to it."""
    total = cells.agg(F.sum("weight")).scalar()
    gap = 0.0
    for dim, target in targets.items():
        got = cells.groupBy(dim).agg((F.sum("weight") / total).alias("got")).join(target, dim)
        gap = max(gap, got.agg(F.max(F.abs(F.col("got") / F.col("target") - 1))).first()[0] or 0.0)
    return gap


def sampling_decisions(
    docs: DataFrame, id_col: str = "doc_id", alpha: float = ALPHA, rounds: int = ROUNDS,
    targets: dict[str, DataFrame] | None = None, keep: float | None = None,
) -> DataFrame:
    """``<id_col>, source, lang, topic, tokens, probability, sampled`` of every document;
    the texts are read once, and no other column is passed on."""
    placed = stage(
        with_cells(docs.select(F.col(id_col).alias("doc_id"), "text", "source", "lang")).select(
            "doc_id", *[f"_{d}" for d in DIMS], "_tokens"
        ),
        "mix-placed",
    )
    rates = stage(_probabilities(placed, alpha, rounds, targets, keep), "mix-rates").select(
        *[F.col(d).alias(f"_{d}") for d in DIMS], "probability"
    )
    return placed.join(rates, [f"_{d}" for d in DIMS]).select(
        F.col("doc_id").alias(id_col),
        *[F.col(f"_{d}").alias(d) for d in DIMS],
        F.col("_tokens").alias("tokens"),
        "probability",
        (uniform(F.col("doc_id")) < F.col("probability")).alias("sampled"),
    )


def sample_to_targets(
    docs: DataFrame, alpha: float = ALPHA, rounds: int = ROUNDS,
    targets: dict[str, DataFrame] | None = None, keep: float | None = None,
) -> DataFrame:
    """Every document with ``_probability`` and ``_sampled``."""
    rates = stage(cell_probabilities(docs, alpha, rounds, targets, keep), "mix-rates").select(
        *[F.col(d).alias(f"_{d}") for d in DIMS], F.col("probability").alias("_probability")
    )
    return (
        with_cells(docs)
        .join(rates, [f"_{d}" for d in DIMS])
        .withColumn("_sampled", uniform(F.col("doc_id")) < F.col("_probability"))
    )
