"""The variable dictionary: one cleaned, current definition per variable."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingpanel.constants import DICTIONARY_PREFIXES
from filingpanel.functions.text import clean_text, parse_date

# Words that identify a column's role, tried in this order for every column.
_ROLE_WORDS = (
    ("mnemonic", ("mnemonic",)),
    ("item_code", ("item", "code")),
    ("item_name", ("item", "name")),
    ("end_date", ("end", "date")),
    ("form", ("reporting", "form")),
)
# Exact names tried where no column has the words.
_ROLE_NAMES = {
    "mnemonic": ("Mnemonic", "Variable", "MDRM", "Code"),
    "item_code": ("Item Code", "ItemCode", "Code"),
    "item_name": ("Item Name", "ItemName", "Description", "Item_Name"),
}
# The date type of the usual data-frame readers ends here; a later end date reads as "open".
_LAST_DATE = "2262-04-11"
_FIRST_DATE = "1677-09-22"


@dataclass(frozen=True)
class DictionaryRoles:
    """Which column of a dictionary export holds what."""

    mnemonic: str
    item_name: str
    item_code: str | None = None
    end_date: str | None = None
    form: str | None = None
    start_date: str | None = None


def resolve_roles(columns: Sequence[str]) -> DictionaryRoles:
    """Find the roles of the columns from the words in their names; the last match wins."""
    found: dict[str, str] = {}
    for column in columns:
        lowered = column.lower()
        roles = [role for role, words in _ROLE_WORDS if all(word in lowered for word in words)]
        if roles:
            found[roles[0]] = column
        elif "start" in lowered and "date" in lowered:
            found["start_date"] = column
    for role, names in _ROLE_NAMES.items():
        if role not in found:
            found.update({role: name for name in reversed(names) if name in columns})
    if "mnemonic" not in found or "item_name" not in found:
        raise ValueError(f"no mnemonic or item name among {list(columns)}")
    return DictionaryRoles(**found)


def has_prefix(mnemonic: Column, prefixes: Sequence[str] = DICTIONARY_PREFIXES) -> Column:
    """Whether a mnemonic is exactly one of the prefixes."""
    return mnemonic.isin(*prefixes)


def variable_key(mnemonic: Column, item_code: Column | None = None) -> Column:
    """The variable's name: mnemonic and item code in upper case.

    A missing item code takes part as the text NAN, as it does in exports keyed elsewhere.
    """
    if item_code is None:
        return F.upper(mnemonic)
    return F.upper(F.concat(mnemonic, F.coalesce(item_code.cast("string"), F.lit("nan"))))


def joined_forms(form: Column) -> Column:
    """Aggregate: the distinct forms, sorted and joined by commas; '' where there is none."""
    return F.array_join(F.array_sort(F.collect_set(form.cast("string"))), ",")


def latest_value(value: Column, end_date: Column, *tie_break: Column) -> Column:
    """Aggregate: the value of the row that ends last, where an open end counts as last.

    ``min_by`` on a struct combines map-side, so a key with many rows is reduced before the
    shuffle; nothing is sorted. Nulls order first within a struct, which puts open ends first.
    ``tie_break`` columns are compared ascending.
    """
    order = F.struct(
        (-F.unix_date(end_date)).alias("end"),
        *[c.alias(f"tie{i}") for i, c in enumerate(tie_break)],
    )
    return F.min_by(value, order)


def keep_latest(
    df: DataFrame, key: str, end_date: str, columns: Sequence[str], tie_break: Sequence[Column] = ()
) -> DataFrame:
    """One row per key: ``columns`` of the row that ends last (open ends first)."""
    latest = latest_value(F.struct(*columns, end_date), F.col(end_date), *tie_break)
    return df.groupBy(key).agg(latest.alias("_row")).select(key, "_row.*")


def build_dictionary(
    raw: DataFrame,
    roles: DictionaryRoles | None = None,
    prefixes: Sequence[str] = DICTIONARY_PREFIXES,
) -> DataFrame:
    """``(Variable, Description, ReportingForms)`` from the rows of a dictionary export.

    Forms of all definitions and the current definition come out of one aggregation, so there
    is one shuffle, on the variable. Ties on the end date go to the later start date, then to
    the description that sorts first, a missing one like an empty one. Descriptions are cleaned
    after the reduction.
    """
    roles = roles or resolve_roles(raw.columns)
    optional = {
        name: F.col(f"`{column}`") if column else F.lit(None).cast("string")
        for name, column in (("form", roles.form), ("end", roles.end_date), ("start", roles.start_date))
    }
    code = F.col(f"`{roles.item_code}`") if roles.item_code else None
    mnemonic = F.col(f"`{roles.mnemonic}`")
    end = parse_date(optional["end"])
    rows = raw.where(has_prefix(mnemonic, prefixes)).select(
        variable_key(mnemonic, code).alias("Variable"),
        F.col(f"`{roles.item_name}`").alias("description"),
        optional["form"].alias("form"),
        F.when(end.between(F.lit(_FIRST_DATE).cast("date"), F.lit(_LAST_DATE).cast("date")), end).alias("end"),
        parse_date(optional["start"]).alias("start"),
    )
    current = latest_value(
        F.col("description"),
        F.col("end"),
        -F.unix_date("start"),
        F.coalesce("description", F.lit("")),
    )
    merged = rows.groupBy("Variable").agg(
        current.alias("description"), joined_forms(F.col("form")).alias("ReportingForms")
    )
    cleaned = merged.select("Variable", clean_text(F.col("description")).alias("Description"), "ReportingForms")
    return drop_empty(cleaned, "Description")


def drop_empty(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither null nor empty."""
    return df.where(F.length(column) > 0)


def prefix_counts(dictionary: DataFrame, prefixes: Sequence[str] = DICTIONARY_PREFIXES) -> DataFrame:
    """Variables per prefix; prefixes without any do not appear."""
    listed = F.array(*[F.lit(p) for p in prefixes])
    matching = F.filter(listed, lambda prefix: F.col("Variable").startswith(prefix))
    return (
        dictionary.select(F.explode(matching).alias("prefix"), (F.length("ReportingForms") > 0).alias("has_forms"))
        .groupBy("prefix")
        .agg(F.count("*").alias("variables"), F.count_if("has_forms").alias("with_forms"))
    )


def lookup(df: DataFrame, dictionary: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Add dictionary columns by key, '' where the key is unknown.

    The dictionary grows with the archives, so it carries no broadcast hint: the planner
    broadcasts it where its measured size allows and otherwise splits skewed keys of ``df``.
    """
    small = dictionary.select(F.col("Variable").alias("_variable"), *columns)
    joined = df.join(small, F.upper(df[key]) == small["_variable"], "left")
    return joined.select(df["*"], *[F.coalesce(small[c], F.lit("")).alias(c) for c in columns])
