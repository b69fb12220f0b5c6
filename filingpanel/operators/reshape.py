"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from filingpanel.constants import ID_COLUMN, PERIOD_COLUMN

ROW_KEYS = ("entity_type", "quarter", "period", "filer_id", "occurrence")


def to_long(df: DataFrame, ids: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """``(*ids, variable, num_value, str_value)`` with one row per value present.

    Numbers and texts are unpivoted apart, so numbers never pass through text.
    """
    numeric = [v for v in variables if isinstance(df.schema[v].dataType, NumericType)]
    texts = [v for v in variables if v not in numeric]
    ids = list(ids)
    parts = []
    if numeric:
        source = df.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in numeric])
        long = source.unpivot(ids, numeric, "variable", "num_value")
        long = long.where(F.col("num_value").isNotNull() & ~F.isnan("num_value"))
        parts.append(long.withColumn("str_value", F.lit(None).cast("string")))
    if texts:
        source = df.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in texts])
        long = source.unpivot(ids, texts, "variable", "str_value").where(F.col("str_value").isNotNull())
        parts.append(long.select(*ids, "variable", F.lit(None).cast("double").alias("num_value"), "str_value"))
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


# Stands for a null filer id while rows are grouped and joined on it.
_NO_ID = 1 - 2**63


def pivot_values(facts: DataFrame, keys: Sequence[str], dtypes: Mapping[str, str]) -> DataFrame:
    """One row per key with a column per variable of ``dtypes`` (``double`` or ``string``).

    Explicit variables spare the job that would look them up. Rows are brought together by key
    up front: a key holds at most one value per variable, so combining map-side would not shrink
    anything, and the pivot then needs no further shuffle.

    Numbers are pivoted by position, at a cost per value that does not depend on the number of
    variables. Spark can do so for fixed-width types only; texts, which are few, take one
    condition per variable, and the two halves meet without another shuffle.
    """
    numbers = [v for v, kind in dtypes.items() if kind != "string"]
    texts = [v for v, kind in dtypes.items() if kind == "string"]
    nullable = [k for k in keys if facts.schema[k].dataType.typeName() == "long"]
    filled = facts.withColumns({k: F.coalesce(k, F.lit(_NO_ID)) for k in nullable})

    def together(rows: DataFrame) -> GroupedData:
        return rows.repartition(*keys).groupBy(*keys)

    # Every key stays on this side, whether it has numbers or not; variables not listed are ignored.
    wide = together(filled.select(*keys, "variable", "num_value"))
    wide = wide.pivot("variable", numbers or [""]).agg(F.first("num_value", ignorenulls=True))
    if texts:
        picked = [
            F.first(F.when(F.col("variable") == v, F.col("str_value")), ignorenulls=True).alias(v) for v in texts
        ]
        strings = filled.where(F.col("variable").isin(*texts)).select(*keys, "variable", "str_value")
        wide = wide.join(together(strings).agg(*picked), list(keys), "left")
    # As SQL text: one call for hundreds of columns instead of one each.
    restored = [f"if({k} = {_NO_ID}L, null, {k}) AS {k}" if k in nullable else k for k in keys]
    return wide.selectExpr(*restored, *[_quoted(v) for v in dtypes])


def to_wide(
    facts: DataFrame, filers: DataFrame, dtypes: Mapping[str, str], keys: Sequence[str] = ROW_KEYS
) -> DataFrame:
    """The wide panel: every filer of the roster, also those without any value.

    Roster rows take part in the pivot as rows of no variable, which keeps filers without
    values (and null ids) with one shuffle and no join.
    """
    roster = filers.select(
        *keys,
        F.lit(None).cast("string").alias("variable"),
        F.lit(None).cast("double").alias("num_value"),
        F.lit(None).cast("string").alias("str_value"),
    )
    cells = facts.select(*keys, "variable", "num_value", "str_value")
    return pivot_values(cells.unionByName(roster), keys, dtypes)


def with_lead_columns(wide: DataFrame, order: Sequence[str] = (PERIOD_COLUMN, ID_COLUMN), rest: str = "original") -> DataFrame:
    """Name the lead columns as in the published panel and put them first."""
    named = wide.withColumnsRenamed({"filer_id": ID_COLUMN, "period": PERIOD_COLUMN})
    others = [c for c in named.columns if c not in (*order, "entity_type", "quarter", "occurrence")]
    if rest == "sorted":
        others = sorted(others)
    return named.selectExpr(*order, *[_quoted(c) for c in others])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
