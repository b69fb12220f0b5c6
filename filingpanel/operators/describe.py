"""Variable descriptions as column metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def descriptions_for(df: DataFrame, dictionary: DataFrame) -> dict[str, str]:
    """Descriptions of the columns of ``df``; the driver sees at most one row per column."""
    names = sorted({c.upper() for c in df.columns})
    rows = (
        dictionary.where(F.col("Variable").isin(*names) & (F.length("Description") > 0))
        .select("Variable", "Description")
        .collect()
    )
    return {r["Variable"]: r["Description"] for r in rows}


def describe_columns(df: DataFrame, descriptions: Mapping[str, str]) -> DataFrame:
    """Attach descriptions as metadata, by upper-cased name. Metadata already present wins.

    The key ``comment`` repeats the text because SQL catalogs show that one.
    """

    def described(name: str):
        column = F.col(f"`{name}`")
        text = descriptions.get(name.upper(), "")
        if not text:
            return column
        return column.alias(name, metadata={"description": text, "comment": text, **df.schema[name].metadata})

    return df.select(*[described(c) for c in df.columns])


def column_descriptions(df: DataFrame) -> dict[str, str]:
    """Column name to attached description, for the columns that have one."""
    return {f.name: f.metadata["description"] for f in df.schema.fields if "description" in f.metadata}
