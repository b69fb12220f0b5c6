"""Missing quarters in a series, and bounded previews of long lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingpanel.functions.periods import label_from_index, quarter_index


def find_gaps(df: DataFrame, period: str, group: Sequence[str] = (), expand: bool = False) -> DataFrame:
    """``(*group, missing_quarter, entries, missing)`` where the next row is not the next quarter.

    Rows are compared with their successor in date order within the group. A hole of several
    quarters is one entry, named after its first quarter and with its length in ``missing``; a
    repeated quarter is an entry too (with no missing quarter); the end of a series is none, and
    undated rows are left out. ``expand=True`` lists every missing quarter of a hole instead.

    Rows are first reduced to one per group and quarter, with their number, so the window sees
    at most as many rows per group as the calendar has quarters, however many rows a group has.
    """
    quarters = (
        df.where(F.col(period).isNotNull())
        .groupBy(*group, quarter_index(period).alias("_q"))
        .agg(F.count("*").alias("_n"))
    )
    following = F.lead("_q").over(Window.partitionBy(*group).orderBy("_q"))
    stepped = quarters.withColumn("_hole", F.coalesce(following - F.col("_q") - 1, F.lit(0)))
    if expand:
        index = F.explode(F.sequence(F.col("_q") + 1, F.col("_q") + F.col("_hole")))
        holes = stepped.where(F.col("_hole") > 0).select(*group, index.alias("_m"))
        return holes.select(*group, label_from_index("_m").alias("missing_quarter"))
    entries = F.col("_n") - 1 + F.when(F.col("_hole") > 0, 1).otherwise(0)
    return stepped.where(entries > 0).select(
        *group,
        label_from_index(F.col("_q") + 1).alias("missing_quarter"),
        entries.cast("bigint").alias("entries"),
        F.col("_hole").cast("int").alias("missing"),
    )


def preview_gaps(gaps: DataFrame, group: Sequence[str], first: int = 10) -> DataFrame:
    """``(*group, preview, more)``: the first entries joined by ', ' and how many follow.

    A group has at most one row per calendar quarter here, so collecting them is bounded.
    """
    repeated = F.array_repeat(F.col("missing_quarter"), F.least("entries", F.lit(first)).cast("int"))
    ordered = F.array_sort(F.collect_list(F.struct("missing_quarter", repeated.alias("labels"))))
    labels = F.flatten(F.transform(ordered, lambda e: e["labels"]))
    return gaps.groupBy(*group).agg(
        F.array_join(F.slice(labels, 1, first), ", ").alias("preview"),
        F.greatest(F.sum("entries") - first, F.lit(0)).alias("more"),
    )


def preview_first(
    df: DataFrame, group: Sequence[str], item: Column, order: Sequence[Column], first: int
) -> DataFrame:
    """``(*group, preview, more)`` for groups of any size.

    The rank limit is applied before the shuffle, so at most ``first`` rows per group and input
    partition travel; the totals are counted apart, with map-side partial sums.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    top = df.select(*group, item.alias("_item"), rank.alias("_rank")).where(F.col("_rank") <= first)
    ordered = F.array_sort(F.collect_list(F.struct("_rank", F.col("_item").cast("string").alias("item"))))
    listed = top.groupBy(*group).agg(
        F.array_join(F.transform(ordered, lambda e: e["item"]), ", ").alias("preview")
    )
    totals = df.groupBy(*group).agg(F.greatest(F.count("*") - first, F.lit(0)).alias("more"))
    return listed.join(totals, list(group))
