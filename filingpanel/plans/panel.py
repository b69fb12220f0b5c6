"""The filing panel as three tables, and the steps both archive kinds share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingpanel.constants import ID_COLUMN, PERIOD_COLUMN
from filingpanel.operators.describe import describe_columns, descriptions_for
from filingpanel.operators.reshape import to_wide, with_lead_columns
from filingpanel.session import remove, staged
from filingpanel.sources.cells import HEADER_ROW, HEADERS, NOT_DECODED, PROBLEMS, ROWS, SKIPPED, WHOLE_FILE

PANEL_KEYS = ("entity_type", "quarter")


@dataclass(frozen=True)
class Panel:
    """Long panel.

    ``facts(entity_type, quarter, period, filer_id, occurrence, variable, num_value, str_value)``:
    one row per value present. ``filers(entity_type, quarter, period, filer_id, occurrence,
    entity_code)``: every filer row. ``catalog(entity_type, quarter, member_ordinal, variable,
    dtype, ordinal, n_values)``: every column, filled or not. ``status(entity_type, quarter,
    state, records, columns, message)``: the outcome per quarter. ``inputs(source, path, quarter,
    state, records, message, recorded)``: the outcome per input file.

    ``values`` are the rows that ``expand`` turns into facts, one for each filer row and member.
    ``folders`` hold the intermediate tables; ``release`` removes them once the panel is written.
    """

    facts: DataFrame
    filers: DataFrame
    catalog: DataFrame
    status: DataFrame
    inputs: DataFrame | None = None
    values: DataFrame | None = None
    expand: Callable[[DataFrame], DataFrame] | None = None
    folders: tuple[str, ...] = ()

    def release(self) -> None:
        """Remove the intermediate tables; the panel's tables cannot be read afterwards."""
        remove(self.status.sparkSession, self.folders)


def staged_rows(decoded: DataFrame, name: str) -> DataFrame:
    """Decoded rows, written once and partitioned by kind: headers and errors are read without the values."""
    kind = F.when(F.col("error").isNotNull(), PROBLEMS).when(F.col("row_no") == HEADER_ROW, HEADERS).otherwise(ROWS)
    return staged(decoded.withColumn("kind", kind), name, ("kind",))


def outcomes(listing: DataFrame, members: DataFrame, excluded: DataFrame, source: str) -> DataFrame:
    """The state of every listed input file.

    ``listing`` has ``path, quarter`` and ``state``, null where the file was opened. Of those, a file is
    ``error`` if it could not be read or none of its members could, ``empty`` without rows, ``duplicate`` if
    another file stands for its quarter, and ``processed`` otherwise.
    """
    own = members.groupBy("path").agg(
        F.max("quarter").alias("found"),
        F.sum("rows").alias("rows"),
        F.min("message").alias("message"),
        F.max(F.when(F.col("member_ordinal") == WHOLE_FILE, F.col("message"))).alias("whole"),
    )
    used = members.where("rows > 0").join(excluded, ["path", "member_ordinal"], "left_anti")
    used = used.groupBy("path").agg(F.sum("rows").alias("records"))
    joined = listing.join(own, "path", "left").join(used, "path", "left")
    not_read = F.col("whole").isin(*NOT_DECODED)
    opened = (
        F.when(not_read, F.col("whole"))
        .when(F.col("records").isNotNull(), "processed")
        .when(F.col("whole").isNotNull(), "error")
        .when(F.coalesce("rows", F.lit(0)) > 0, "duplicate")
        .when(F.col("message").isNotNull() & (F.col("message") != "empty"), "error")
        .otherwise("empty")
    )
    return joined.select(
        F.lit(source).alias("source"),
        "path",
        F.coalesce("quarter", "found").alias("quarter"),
        F.coalesce("state", opened).alias("state"),
        F.coalesce("records", F.lit(0)).alias("records"),
        F.when(~F.coalesce(not_read, F.lit(False)), F.col("message")).alias("message"),
        F.current_timestamp().alias("recorded"),
    )


def latest_inputs(inputs: DataFrame) -> DataFrame:
    """The present state of each input file, from the log of all runs.

    Of several files that were processed for a quarter, the one whose run came last stands for it.
    """
    order = F.struct("recorded", "state")
    columns = [c for c in inputs.columns if c not in ("source", "path")]
    last = inputs.where(F.col("state") != SKIPPED).groupBy("source", "path").agg(F.max_by(F.struct(*columns), order).alias("_last"))
    rows = last.select("source", "path", "_last.*")
    done = F.col("state") == "processed"
    winners = rows.where(done).groupBy("source", "quarter").agg(F.max_by("path", F.struct("recorded", "path")).alias("_winner"))
    marked = rows.join(winners, ["source", "quarter"], "left")
    state = F.when(done & (F.col("path") != F.col("_winner")), "duplicate").otherwise(F.col("state"))
    return marked.withColumn("state", state).drop("_winner")


def check_duplicate_rule(rule: str) -> None:
    if rule not in ("first", "last"):
        raise ValueError(f"unknown rule for several files of a quarter: {rule!r}")


def member_table(dated: DataFrame) -> DataFrame:
    """One row per member file: its quarter, number of rows, and whether it was unreadable.

    Written once: it decides several joins, and the written table's true size lets the planner
    broadcast it or not. The values are not read for it.
    """
    members = dated.groupBy("path", "member_ordinal", "source_name", "quarter").agg(
        F.count_if(F.col("row_no") > HEADER_ROW).alias("rows"),
        (F.count("error") > 0).alias("failed"),
        F.min("error").alias("message"),
    )
    return staged(members, "members")


def excluded_members(members: DataFrame, on_duplicate: str, earlier: DataFrame | None = None) -> DataFrame:
    """``(path, member_ordinal)`` of members that take no part in the panel.

    Those are unreadable, empty or undated members, all members of an unreadable file, and files other than the one that stands for
    its quarter: the first (or last) by path among those with rows. Usually there are few, so
    leaving them out is an anti-join with a tiny table instead of a semi-join with a large one.

    ``earlier`` (``quarter, path``) are files that already stand for a quarter: only one before it by
    path takes its place.
    """
    pick = F.min if on_duplicate == "first" else F.max
    broken = members.where((F.col("member_ordinal") == WHOLE_FILE) & F.col("failed"))
    marked = members.join(broken.select("path", F.lit(True).alias("_broken")).distinct(), "path", "left")
    usable = (
        ~F.col("failed") & F.col("_broken").isNull() & (F.col("rows") > 0) & F.col("quarter").isNotNull()
    )
    if earlier is not None:
        marked = marked.join(earlier.select("quarter", F.col("path").alias("_stands")), "quarter", "left")
        usable = usable & (F.col("_stands").isNull() | (F.col("path") <= F.col("_stands")))
    chosen = marked.where(usable).groupBy("quarter").agg(pick("path").alias("_chosen"))
    other_file = ~F.col("path").eqNullSafe(F.col("_chosen"))
    excluded = marked.join(chosen, "quarter", "left").where(~usable | other_file)
    return staged(excluded.select("path", "member_ordinal"), "excluded")


def without_members(df: DataFrame, excluded: DataFrame) -> DataFrame:
    return df.join(excluded, ["path", "member_ordinal"], "left_anti")


def with_occurrence(rows: DataFrame) -> DataFrame:
    """Tell rows with the same filer id within a member apart.

    ``occurrence`` is 1 for a filer's first row, so that members align on it, and a larger number
    for every further one, as it is for rows without an id. Only ids that do repeat are joined
    back, so one that repeats endlessly is no burden on a single task.
    """
    key = ["path", "member_ordinal", "filer_id"]
    firsts = rows.groupBy(*key).agg(F.min("row_no").alias("_first"), F.count("*").alias("_n"))
    repeated = staged(firsts.where((F.col("_n") > 1) & F.col("filer_id").isNotNull()).drop("_n"), "repeated")
    is_first = F.col("filer_id").isNotNull() & (F.coalesce("_first", "row_no") == F.col("row_no"))
    occurrence = F.when(is_first, F.lit(1).cast("bigint")).otherwise(F.col("row_no") + 2)
    return rows.join(repeated, key, "left").withColumn("occurrence", occurrence).drop("_first")


def headers_of(dated: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, variable, ordinal, kind)`` of the header rows."""
    exploded = dated.where(F.col("kind") == HEADERS).select(*keys, F.explode("cells").alias("_c"))
    return exploded.select(*keys, "_c.variable", "_c.ordinal", F.col("_c.raw").alias("kind"))


def member_errors(dated: DataFrame, entity_type: Column) -> DataFrame:
    """Unreadable members as rows for the status."""
    failed = dated.where((F.col("kind") == PROBLEMS) & ~F.col("error").isin(*NOT_DECODED))
    return failed.dropDuplicates(["path", "member_ordinal", "source_name"]).select(
        entity_type.alias("entity_type"), "quarter", F.concat_ws(": ", "source_name", "error").alias("message")
    )


def quarter_status(filers: DataFrame, catalog: DataFrame, errors: DataFrame) -> DataFrame:
    """Outcome per entity type and quarter, and per unreadable or undated file."""
    keys = list(PANEL_KEYS)
    records = filers.groupBy(*keys).agg(F.count("*").alias("records"))
    columns = catalog.groupBy(*keys).agg((F.count("*") + 2).alias("columns"))
    processed = records.join(columns, keys, "left").select(
        *keys,
        F.lit("processed").alias("state"),
        "records",
        F.coalesce("columns", F.lit(2)).alias("columns"),
        F.lit(None).cast("string").alias("message"),
    )
    failed = errors.select(
        *keys,
        F.lit("error").alias("state"),
        F.lit(0).cast("bigint").alias("records"),
        F.lit(0).cast("bigint").alias("columns"),
        "message",
    )
    return processed.unionByName(failed)


_INSIDE = "variable "


def wide_panel(
    panel: Panel,
    entity_type: str,
    quarter: str | None = None,
    dictionary: DataFrame | None = None,
    order: Sequence[str] = (PERIOD_COLUMN, ID_COLUMN),
    rest: str = "original",
) -> DataFrame:
    """The published wide form of one entity type (or one of its quarters), columns described.

    The driver reads the column list only: one row per variable of the entity type. A variable
    that is text in any of the quarters becomes text.
    """
    condition: Column = F.col("entity_type") == entity_type
    if quarter is not None:
        condition = condition & (F.col("quarter") == quarter)
    listed = (
        panel.catalog.where(condition)
        .groupBy("variable")
        .agg(F.max("dtype").alias("dtype"), F.min(F.struct("member_ordinal", "ordinal")).alias("place"))
        .orderBy("place", "variable")
        .collect()
    )
    # Under names that no key can have; the lead columns take the place of variables called like them.
    leads = {name.upper() for name in order}
    dtypes = {_INSIDE + r["variable"]: r["dtype"] for r in listed if r["variable"].upper() not in leads}
    facts = panel.facts.where(condition).withColumn("variable", F.concat(F.lit(_INSIDE), "variable"))
    if "string" in dtypes.values():
        text = [v for v, kind in dtypes.items() if kind == "string"]
        as_text = F.when(
            F.col("variable").isin(*text), F.coalesce("str_value", F.col("num_value").cast("string"))
        ).otherwise(F.col("str_value"))
        facts = facts.withColumn("str_value", as_text)
    wide = with_lead_columns(to_wide(facts, panel.filers.where(condition), dtypes), order, rest)
    wide = wide.toDF(*[c.removeprefix(_INSIDE) for c in wide.columns])
    return wide if dictionary is None else describe_columns(wide, descriptions_for(wide, dictionary))
