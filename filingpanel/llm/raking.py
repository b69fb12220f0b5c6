"""Mixing sources to target weights by iterative proportional fitting, and sampling by calibrated probabilities.

Documents fall into cells by source, language and topic; a cell's weight starts as its tokens. Each round
scales the weights to one margin after the other until all three margins have their target shares. A
document's probability is its cell's raked share of the token budget over the cell's tokens, at most 1, and
a hash of its id decides against it, so the same documents are drawn in every run and on every cluster.

The raking works on cells alone, which are as many as differing combinations, and stays distributed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingpanel.session import staged

#: Rounds at most, and how near (relatively) all margins must come to their targets to stop before.
ROUNDS, CLOSE = 30, 1e-4

#: Share of all tokens that the sample should hold.
BUDGET = 0.7

#: Targets without an explicit table: observed shares to this power, so large groups shrink.
TEMPER = 0.7

SEED = 97

#: Cells of one written file: rounds over few of them do not write many tiny files.
CELLS_A_FILE = 250_000

MARGINS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    """A topic by the looks of a text: tables, shouting, figures, lists or prose. Null and empty are prose."""
    size = F.greatest(F.length(text), F.lit(1))

    def share(pattern: str) -> Column:
        return (size - F.length(F.regexp_replace(text, pattern, ""))) / size

    found = F.when(share(r"\|") >= 0.01, "table").when(share("!") >= 0.02, "shouting")
    return F.coalesce(found.when(share("[0-9]") >= 0.03, "figures").when(share("[#&%$*]") >= 0.05, "signs").otherwise("prose"), F.lit("prose"))


def tokens_of(text: Column) -> Column:
    """Words between white space; null and empty have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _key(column: Column) -> Column:
    """A margin's value as a key that also tells null from every text."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, close: float = CLOSE) -> DataFrame:
    """``cells`` (a column for each margin, and ``weight``) with weights scaled to the target shares.

    ``targets`` has, by margin, a table of its values and their ``share``; shares are taken relative to
    the values that occur. A value without a share gets weight 0. Margins that contradict each other, or
    empty cells that a target needs, leave the last round's weights, nearest to the last margin. Cells
    without weight stay at 0. Written after every round: a lost executor costs a re-read.
    """
    known = cells.agg(F.sum("weight").alias("total"), F.count("*").alias("n")).first()
    total, files = known["total"] or 0.0, max(4, known["n"] // CELLS_A_FILE)
    wanted = {}
    for margin, table in targets.items():
        there = table.join(cells.where("weight > 0").select(margin).distinct(), margin, "left_semi")
        scale = there.agg(F.sum("share")).first()[0] or 1.0
        wanted[margin] = staged(there.select(margin, (F.col("share") / scale * total).alias("target")).coalesce(files), f"target-{margin}")
    for _ in range(rounds):
        far = F.lit(0.0)
        for margin, table in wanted.items():
            sums = cells.groupBy(margin).agg(F.sum("weight").alias("had")).join(table, margin, "left")
            factor = F.when(F.col("had") > 0, F.coalesce("target", F.lit(0.0)) / F.col("had")).otherwise(F.lit(0.0))
            factors = sums.select(margin, factor.alias("factor"))
            # A margin's first factors of a round tell how far it was off.
            cells = cells.join(factors, margin)
            off = F.when(F.col("weight") > 0, F.abs(F.col("factor") - 1)).otherwise(F.lit(0.0))
            cells = cells.withColumn("off", F.greatest(F.coalesce(F.col("off"), F.lit(0.0)) if "off" in cells.columns else F.lit(0.0), off))
            cells = cells.withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
        cells = staged(cells.coalesce(files), "raked")
        far = cells.agg(F.max("off")).first()[0] or 0.0
        cells = cells.drop("off")
        if far <= close:
            break
    return cells


def tempered_targets(cells: DataFrame, margins: tuple[str, ...] = MARGINS, power: float = TEMPER) -> dict[str, DataFrame]:
    """Target shares for each margin: its observed weight to a power below 1."""
    return {m: cells.groupBy(m).agg(F.pow(F.sum("weight"), F.lit(power)).alias("share")).where("share > 0") for m in margins}


def calibrated(docs: DataFrame, topic: Column | None = None, budget: float = BUDGET, targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``docs`` with a struct ``mix``: ``topic, tokens, probability, kept``.

    Reads ``doc_id, text, source, lang``; ``topic`` may be any column and comes from the text by default.
    A null source, language or topic is a value of its own. Texts without words have no tokens and
    probability 1: they cost nothing of the budget. Documents are drawn by a hash of their id, rows with
    a null id by a hash of their text, so repeated rows share one fate. Other columns stay as they are.

    Cells are summed before the shuffle; the documents meet their cell's probability in a join on the
    three margins, whose hot keys adaptive execution splits.
    """
    text = F.col("text").cast("string")
    measured = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        _key(F.col("source")).alias("source"),
        _key(F.col("lang")).alias("lang"),
        _key(topic if topic is not None else topic_of(text)).alias("topic"),
        tokens_of(text).alias("tokens"),
    )
    margins = list(MARGINS)
    cells = staged(measured.groupBy(*margins).agg(F.sum("tokens").cast("double").alias("weight")), "cells")
    raked = rake(cells, targets if targets is not None else tempered_targets(cells))
    rate = F.lit(budget) * F.col("raked") / F.col("weight")
    rated = raked.withColumnRenamed("weight", "raked").join(cells, margins)
    chance = F.when(F.col("weight") > 0, F.least(F.lit(1.0), F.round(rate, 9))).otherwise(F.lit(1.0))
    chances = staged(rated.select(*margins, chance.alias("probability")), "chances")
    joined = measured.join(chances, margins, "left")
    place = F.coalesce(F.xxhash64(F.col("row.doc_id"), F.lit(SEED)), F.lit(0))
    place = F.when(F.col("row.doc_id").isNull(), F.xxhash64(F.col("row.text"), F.lit(SEED))).otherwise(place)
    drawn = F.pmod(place, F.lit(1 << 30)) / F.lit(float(1 << 30))
    value = F.expr("substring(topic, 2)") if topic is None else F.when(F.col("topic") != "null", F.expr("substring(topic, 2)"))
    probability = F.when(F.col("tokens") > 0, F.col("probability")).otherwise(F.lit(1.0))
    mix = F.struct(value.alias("topic"), F.col("tokens"), probability.alias("probability"), (drawn < probability).alias("kept"))
    return joined.select("row", mix.alias("mix"))


def sampled(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, all columns as they are."""
    found = calibrated(docs, **options).where("mix.kept")
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
