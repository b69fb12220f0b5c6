"""Merging the schedule members of one archive into one row per filer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingpanel.session import staged


# Rows that one key may become where rows of repeated keys are multiplied.
MULTIPLIED_AT_MOST = 10_000


def merge_schedules(
    members: Sequence[DataFrame],
    key: str,
    coalesce: bool = False,
    multiply: bool = False,
    at_most: int = MULTIPLIED_AT_MOST,
) -> DataFrame:
    """Full outer merge of wide members; of a column in several members the first member's wins.

    First wins per column, not per value: a filer that only a later member has gets NULL there.
    ``coalesce=True`` fills those from the later members instead. The rows are brought together once for any number of
    members, by key and place; keys that a member repeats are counted and numbered before (two more passes).

    Rows that repeat a key align with the other members' rows of the same place, in the order of their
    values; the rest stay rows of their own. ``multiply=True`` combines each with each instead, as a join
    does, and raises an error first if a key would become more than ``at_most`` rows.
    """
    if multiply:
        return _multiplied(members, key, coalesce, at_most)
    owned: dict[str, list[str]] = {}  # column -> what it is called while the members are stacked
    parts = []
    for ordinal, member in enumerate(members):
        chosen = []
        for column in member.columns:
            if column != key and (coalesce or column not in owned):
                name = f"_{ordinal}_{len(chosen)}"
                owned.setdefault(column, []).append(name)
                chosen.append(F.col(f"`{column}`").alias(name))
        parts.append(member.select(F.col(f"`{key}`").alias("_key"), F.lit(ordinal).alias("_member"), *chosen))
    stacked = union_sources(parts)
    names = [name for group in owned.values() for name in group]
    merged = _numbered(stacked, names).groupBy("_key", "_place").agg(
        F.count("*").alias("_rows"), *[F.max(name).alias(name) for name in names]
    )
    columns = [F.coalesce(*group).alias(column) for column, group in owned.items()]
    return merged.select(F.col("_key").alias(key), *columns)


def _numbered(stacked: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows with their ``_place`` among those of the same key and member, in the order of their values.

    Only keys that a member repeats are numbered at all. Their rows are dealt into ranges of key, member and values and
    written, so that a range knows its own counts; those of the ranges before are added. A key with a third
    of all rows, null included, lies in many ranges, and no task gets it whole.
    """
    group = ["_key", "_member"]
    counts = staged(stacked.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1").select("_key").distinct(), "repeated")
    if not counts.limit(1).count():
        return stacked.withColumn("_place", F.lit(1).cast("bigint"))
    repeated = counts.select(F.col("_key").alias("_repeated"))
    same = F.col("_key").eqNullSafe(F.col("_repeated"))
    single = stacked.join(repeated, same, "left_anti").withColumn("_place", F.lit(1).cast("bigint"))
    rows = stacked.join(repeated, same, "left_semi").withColumn("_tie", F.monotonically_increasing_id())
    order = [*group, *names, "_tie"]  # equal rows are told apart, so that ranges can part them
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = staged(ranged.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranged")
    sizes = ranged.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        F.col("_key").alias("_k"), F.col("_member").alias("_m"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    turn = F.row_number().over(Window.partitionBy(*group, "_range").orderBy("_at"))
    met = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_member") == F.col("_m")) & (F.col("_range") == F.col("_r"))
    placed = ranged.withColumn("_turn", turn).join(before, met).withColumn("_place", F.col("_before") + F.col("_turn"))
    return single.unionByName(placed.select(*single.columns))


def _multiplied(members: Sequence[DataFrame], key: str, coalesce: bool, at_most: int) -> DataFrame:
    counts = [m.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.count("*").cast("double").alias("n")) for m in members]
    products = union_sources(counts).groupBy("_key").agg(F.exp(F.sum(F.log("n"))).alias("n"))
    worst = products.agg(F.max("n")).first()[0]
    if worst is not None and worst > at_most + 0.5:
        raise ValueError(f"a repeated key would become {worst:.0f} rows, more than {at_most}")

    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        shared = [c for c in right.columns if c in left.columns and c != key]
        if not coalesce:
            # Dropped before the join, so the losing columns are never read or shuffled.
            return _splittable_full_join(left, right.drop(*shared), key)
        renamed = right.withColumnsRenamed({c: f"_later_{i}" for i, c in enumerate(shared)})
        filled = {c: F.coalesce(F.col(f"`{c}`"), F.col(f"_later_{i}")) for i, c in enumerate(shared)}
        joined = _splittable_full_join(left, renamed, key).withColumns(filled)
        return joined.drop(*[f"_later_{i}" for i in range(len(shared))])

    return reduce(step, members)


def _splittable_full_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Matches and the rest of either side apart: adaptive execution can split each of these."""
    both = left.join(right, key)
    only_left = left.join(right.select(key), key, "left_anti")
    only_right = right.join(left.select(key), key, "left_anti")
    return union_sources([both, only_left, only_right])


def merge_unique_schedules(members: Sequence[DataFrame], key: str) -> DataFrame:
    """As ``merge_schedules`` for members in which every key occurs once: one shuffle for any number.

    Each column is taken from the first member that has it, the members are stacked, and one
    aggregation brings a key's parts together. A repeated key raises an error instead of
    silently losing rows.
    """
    owned: list[str] = []
    parts = []
    for ordinal, member in enumerate(members):
        own = [c for c in member.columns if c != key and c not in owned]
        owned.extend(own)
        parts.append(member.select(key, *own, F.lit(1).alias(f"_member_{ordinal}")))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    repeated = reduce(lambda a, b: a | b, [F.count(f"_member_{i}") > 1 for i in range(len(parts))])
    checked = F.when(repeated, F.raise_error(F.lit("a schedule member repeats a filer id"))).otherwise(F.lit(False))
    return (
        stacked.groupBy(key)
        .agg(*[F.max(f"`{c}`").alias(c) for c in owned], checked.alias("_repeated"))
        .where(~F.col("_repeated"))
        .drop("_repeated")
    )


def first_member_columns(columns: DataFrame, keys: Sequence[str], member: str = "member_ordinal") -> DataFrame:
    """For every column (``keys``) the first member that has it, from a table of column headers."""
    return columns.groupBy(*keys).agg(F.min(member).alias(member))


def keep_first_member(
    cells: DataFrame, columns: DataFrame, keys: Sequence[str], member: str = "member_ordinal"
) -> DataFrame:
    """Long form of the merge: only values of the first member that has the column.

    Shuffles do not depend on the number of members. The semi-join side has one row per column
    and archive; filers that only later members have stay in the roster, with no value here.
    """
    winners = first_member_columns(columns, keys, member)
    return cells.join(winners, [*keys, member], "left_semi")


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def without_processed(incoming: DataFrame, processed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose keys were not processed yet (anti-join)."""
    return incoming.join(processed.select(*keys), list(keys), "left_anti")


def column_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of the first table without those of the second, counting duplicates."""
    return left.exceptAll(right)
