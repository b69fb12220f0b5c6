import datetime as dt
import itertools

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from filingpanel.operators import (
    columns,
    coverage,
    describe,
    dictionary,
    entities,
    gaps,
    inference,
    inventory,
    merge,
    prune,
    reshape,
    status,
)

D = dt.date


# --- entity types ---


def test_split_uses_fixed_codes(spark, rows):
    df = spark.createDataFrame([(float(c),) for c in (1, 2, 10, 11, 13, 17)] + [(None,)], "code double")
    assert rows(entities.split_entities(df, "code")) == [
        (1.0, "FFIEC_031_041"), (10.0, "FFIEC_002"), (11.0, "FFIEC_002"), (13.0, "FRB_2886b"), (17.0, "FRB_2886b")
    ]


def test_cutoff_and_ranges(spark, rows):
    data = [("FFIEC_031_041", D(2010, 12, 31)), ("FFIEC_031_041", D(2011, 3, 31)), ("FFIEC_002", D(2011, 3, 31)), ("FFIEC_031_041", None)]
    df = spark.createDataFrame(data, "entity_type string, period date")
    assert entities.apply_cutoff(df).count() == 3
    assert entities.in_period_range(df, "period", D(2011, 1, 1)).count() == 2
    assert entities.in_period_range(df, "period", D(2011, 1, 1), keep_undated=True).count() == 3
    assert entities.in_period_range(df, "period", D(2010, 12, 31), D(2010, 12, 31)).count() == 1
    assert entities.in_period_range(df, "period").count() == 3


# --- columns ---


@pytest.mark.parametrize(
    "names, priority, first",
    [
        (["RSSD9331", "IDRSSD", "RSSD9001"], "RSSD9001", "RSSD9331"),
        (["x", "IDRSSD", "RSSD_ID"], "IDRSSD", "IDRSSD"),
        (["x", "RSSD_ID"], "RSSD_ID", "RSSD_ID"),
        (["RSSDDATE", "rssd9999", "my_rssd"], "my_rssd", "RSSDDATE"),
        (["rssd9001"], "rssd9001", "rssd9001"),
        (["a", "b"], None, None),
    ],
)
def test_filer_column(names, priority, first):
    assert columns.find_filer_column(names) == priority
    assert columns.find_filer_column(names, "first") == first


def test_filer_id_is_copied_or_renamed(spark):
    df = spark.createDataFrame([(1, 2.0)], "IDRSSD int, a double")
    assert columns.attach_filer_id(df).columns == ["IDRSSD", "a", "RSSD_ID"]
    assert columns.attach_filer_id(df, "first").columns == ["RSSD_ID", "a"]
    with pytest.raises(ValueError):
        columns.attach_filer_id(df.select("a"), "first")


def test_order_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "b int, ID int, a int, P int")
    assert columns.order_columns(df, ["P", "ID"]).columns == ["P", "ID", "b", "a"]
    assert columns.order_columns(df, ["ID", "P"], "sorted").columns == ["ID", "P", "a", "b"]
    assert columns.upper_columns(df).columns == ["B", "ID", "A", "P"]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, 2)], "x double, y int")
    assert [tuple(r) for r in prune.profile_columns(df, ["x", "y"]).orderBy("variable").collect()] == [
        ("x", 0, True), ("y", 2, False)
    ]


# --- dictionary ---


def test_roles():
    names = ["Mnemonic", "Item Code", "Start Date", "End Date", "Item Name", "Confidentiality", "Reporting Form"]
    roles = dictionary.resolve_roles(names)
    assert (roles.mnemonic, roles.item_code, roles.item_name) == ("Mnemonic", "Item Code", "Item Name")
    assert (roles.end_date, roles.form, roles.start_date) == ("End Date", "Reporting Form", "Start Date")
    assert dictionary.resolve_roles(["mnemonic A", "MNEMONIC B", "item name"]).mnemonic == "MNEMONIC B"
    fallback = dictionary.resolve_roles(["Variable", "Code", "Description"])
    assert (fallback.mnemonic, fallback.item_code, fallback.item_name) == ("Variable", "Code", "Description")
    with pytest.raises(ValueError):
        dictionary.resolve_roles(["Mnemonic", "x"])


RAW = "Mnemonic string, `Item Code` string, `Item Name` string, `End Date` string, `Reporting Form` string"


def test_build_dictionary(spark, rows):
    raw = spark.createDataFrame(
        [
            ("RCON", "2170", "Total assets", "12/31/9999 12:00:00 AM", "FFIEC 041"),
            ("RCON", "2170", "Old assets", "3/31/2001", "FFIEC 031"),
            ("RCON", "2170", "Old assets", "3/31/2001", "FFIEC 031"),
            ("RCFD", "a1", "&lt;b&gt;x&lt;/b&gt;&nbsp;y", "2001-03-31", None),
            ("RCFD", "a1", "older", "2000-03-31", "F"),
            ("RIAD", "1", "", None, "F"),
            ("RIAD", "2", "zeta", None, "F"),
            ("RIAD", "2", "alpha", "unknown", "F"),
            ("BHCK", "1", "dropped", None, "F"),
            ("rcon", "1", "dropped", None, "F"),
            ("RCOA", None, "no code", None, None),
        ],
        RAW,
    )
    assert rows(dictionary.build_dictionary(raw)) == [
        ("RCFDA1", "x y", "F"),
        ("RCOANAN", "no code", ""),
        ("RCON2170", "Total assets", "FFIEC 031,FFIEC 041"),
        ("RIAD2", "alpha", "F"),
    ]


def test_build_dictionary_without_optional_columns(spark, rows):
    raw = spark.createDataFrame([("RCON", "a"), ("RCON", "b")], "Mnemonic string, `Item Name` string")
    assert rows(dictionary.build_dictionary(raw)) == [("RCON", "a", "")]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["RCON", "RIAD", "XXXX"]), st.sampled_from(["1", "2", "3"]), st.sampled_from(["a", "b", ""]),
            st.sampled_from(["2001-01-01", "2002-01-01", None]), st.sampled_from(["F1", "F2", None]),
        ),
        max_size=30,
    )
)
def test_dictionary_like_a_small_model(spark, data):
    got = {r[0]: (r[1], r[2]) for r in dictionary.build_dictionary(spark.createDataFrame(data, RAW)).collect()}
    keep = [r for r in data if r[0] != "XXXX"]
    expected = {}
    for key in {m + c for m, c, *_ in keep}:
        group = [r for r in keep if r[0] + r[1] == key]
        latest = max(r[3] or "9999" for r in group)
        description = min(r[2] for r in group if (r[3] or "9999") == latest)
        if description:
            expected[key] = (description, ",".join(sorted({r[4] for r in group if r[4]})))
    assert got == expected


def test_lookup_gives_empty_text(spark, rows):
    known = spark.createDataFrame([("RCON1", "one", "F")], "Variable string, Description string, ReportingForms string")
    df = spark.createDataFrame([("rcon1",), ("RCON2",)], "variable string")
    assert rows(dictionary.lookup(df, known, "variable", ["Description"])) == [("RCON2", ""), ("rcon1", "one")]


def test_prefix_counts(spark, rows):
    known = spark.createDataFrame(
        [("RCON1", "F"), ("RCON2", ""), ("RIAD1", "F")], "Variable string, ReportingForms string"
    )
    assert rows(dictionary.prefix_counts(known)) == [("RCON", 2, 1), ("RIAD", 1, 1)]


# --- pruning and descriptions ---

DICTIONARY = "Variable string, Description string, ReportingForms string"


def test_prune_wide(spark):
    known = spark.createDataFrame([("ONFORM", "on", "FFIEC 002,X"), ("OFFFORM", "off", "Y")], DICTIONARY)
    df = spark.createDataFrame(
        [(1, None, None, None, 5.0, float("nan"))],
        "RSSD9001 int, onform double, OFFFORM double, idrssd int, filled double, nans double",
    )
    assert prune.prune_columns(df, ["FFIEC 002"], known).columns == ["RSSD9001", "onform", "idrssd", "filled"]
    assert prune.prune_columns(df, ["FFIEC 002"]).columns == ["RSSD9001", "idrssd", "filled"]


def test_prune_catalog(spark, rows):
    known = spark.createDataFrame([("ON", "on", "FFIEC 002"), ("OTHER", "off", "FFIEC 031")], DICTIONARY)
    catalog = spark.createDataFrame(
        [("FFIEC_002", v, n) for v, n in (("ON", 0), ("OTHER", 0), ("RSSD9331", 0), ("DATA", 3), ("EMPTY", 0))],
        "entity_type string, variable string, n_values bigint",
    )
    assert [r[1] for r in rows(prune.prune_catalog(catalog, known))] == ["DATA", "ON", "RSSD9331"]
    assert [r[1] for r in rows(prune.prune_catalog(catalog))] == ["DATA", "RSSD9331"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.integers(0, 3))] * 4), min_size=1, max_size=6))
def test_pruning_never_drops_data(spark, data):
    df = spark.createDataFrame(data, "a int, b int, c int, d int")
    filled = {c for i, c in enumerate("abcd") if any(r[i] is not None for r in data)}
    assert set(prune.prune_columns(df, [], None, ()).columns) == filled


def test_descriptions_survive_parquet(spark, tmp_path):
    known = spark.createDataFrame([("RCON2170", "Total assets", ""), ("B", "", "")], DICTIONARY)
    df = spark.createDataFrame([(1, 2, 3)], "rcon2170 int, B int, c int")
    df = df.withMetadata("c", {"description": "own"})
    described = describe.describe_columns(df, {**describe.descriptions_for(df, known), "C": "later"})
    assert describe.column_descriptions(described) == {"rcon2170": "Total assets", "c": "own"}
    described.write.parquet(str(tmp_path / "d"))
    assert describe.column_descriptions(spark.read.parquet(str(tmp_path / "d")))["rcon2170"] == "Total assets"


# --- merging ---


def members(spark):
    a = spark.createDataFrame([(1, 10, "a"), (2, None, "b")], "id int, x int, y string")
    b = spark.createDataFrame([(2, 20, 5), (3, 30, 6)], "id int, x int, z int")
    c = spark.createDataFrame([(4, 7, 8)], "id int, z int, w int")
    return [a, b, c]


def test_first_member_wins_without_coalescing(spark, rows):
    expected = [(1, 10, "a", None, None), (2, None, "b", 5, None), (3, None, None, 6, None), (4, None, None, None, 8)]
    assert rows(merge.merge_schedules(members(spark), "id"), "id", "x", "y", "z", "w") == expected
    assert rows(merge.merge_unique_schedules(members(spark), "id"), "id", "x", "y", "z", "w") == expected
    filled = rows(merge.merge_schedules(members(spark), "id", coalesce=True), "id", "x", "z")
    assert filled == [(1, 10, None), (2, 20, 5), (3, 30, 6), (4, None, 7)]


def test_repeated_ids(spark):
    a = spark.createDataFrame([(1, 1), (1, 2)], "id int, x int")
    b = spark.createDataFrame([(1, 3), (1, 4)], "id int, y int")
    assert sorted(map(tuple, merge.merge_schedules([a, b], "id").collect())) == [(1, 1, 3), (1, 2, 4)]
    assert merge.merge_schedules([a, b], "id", multiply=True).count() == 4
    with pytest.raises(ValueError, match="4 rows, more than 3"):
        merge.merge_schedules([a, b], "id", multiply=True, at_most=3)
    with pytest.raises(PySparkException, match="repeats a filer id"):
        merge.merge_unique_schedules([a, b], "id").collect()


def test_merging_takes_one_shuffle(spark):
    merged = merge.merge_schedules(members(spark), "id")
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@settings(max_examples=6, deadline=None)
@given(st.data())
def test_merge_like_pandas(spark, data):
    frames = []
    for _ in range(3):
        ids = data.draw(st.lists(st.integers(1, 6), unique=True, min_size=1))
        names = data.draw(st.lists(st.sampled_from("abcd"), unique=True, min_size=1))
        values = [[i] + [data.draw(st.one_of(st.none(), st.integers(0, 9))) for _ in names] for i in ids]
        frames.append((values, names))
    model = None
    for values, names in frames:
        pdf = pd.DataFrame(values, columns=["id", *names], dtype="object")
        if model is None:
            model = pdf
            continue
        model = model.merge(pdf.drop(columns=[n for n in names if n in model.columns]), on="id", how="outer")
    order = sorted(model.columns)
    expected = sorted(
        [tuple(None if pd.isna(v) else v for v in r) for r in model[order].itertuples(index=False)], key=repr
    )
    sparks = [spark.createDataFrame(v, "id int, " + ", ".join(f"{n} int" for n in names)) for v, names in frames]
    for merged in (
        merge.merge_schedules(sparks, "id"),
        merge.merge_schedules(sparks, "id", multiply=True),
        merge.merge_unique_schedules(sparks, "id"),
    ):
        assert sorted([tuple(r) for r in merged.select(*order).collect()], key=repr) == expected


def test_anti_union_difference(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(1, "x")], "k int, v string")
    assert rows(merge.without_processed(a, b, ["k"])) == [(2,)]
    assert rows(merge.union_sources([a, b])) == sorted([(1, None), (1, None), (2, None), (1, "x")], key=repr)
    assert rows(merge.column_difference(a, b.select("k"))) == [(1,), (2,)]


# --- numeric inference and reshaping ---


def test_inference_is_all_or_nothing(spark, rows):
    cells = spark.createDataFrame(
        [(0, "a", "1"), (0, "a", "x"), (0, "b", "1"), (0, "b", None), (0, "c", None), (1, "a", "2")],
        "member int, variable string, raw string",
    )
    keys = ["member", "variable"]
    verdicts = inference.numeric_verdicts(cells, keys)
    assert rows(verdicts, "member", "variable", "is_numeric") == [
        (0, "a", False), (0, "b", True), (0, "c", True), (1, "a", True)
    ]
    assert rows(inference.typed_values(cells, verdicts, keys)) == sorted(
        [(0, "a", None, "1"), (0, "a", None, "x"), (0, "b", 1.0, None), (0, "b", None, None), (0, "c", None, None), (1, "a", 2.0, None)],
        key=repr,
    )


def test_long_wide_round_trip(spark, rows):
    data = [("2020Q1", 1, 1.5, "x", None), ("2020Q1", 2, None, None, None), ("2020Q2", 1, 2.5, None, None)]
    wide = spark.createDataFrame(data, "quarter string, filer_id int, num double, txt string, none double")
    long = reshape.to_long(wide, ["quarter", "filer_id"], ["num", "txt", "none"])
    assert long.count() == 3
    back = reshape.to_wide(
        long, wide.select("quarter", "filer_id"), {"num": "double", "txt": "string", "none": "double"}, ["quarter", "filer_id"]
    )
    assert rows(back) == sorted(data, key=repr)


def test_wide_form_shuffles_every_value_once(spark):
    facts = spark.createDataFrame(
        [(1, "a", 1.0, None), (2, "t", None, "x"), (None, "a", 3.0, None)],
        "filer_id bigint, variable string, num_value double, str_value string",
    )

    def plan(dtypes):
        wide = reshape.to_wide(facts, facts.select("filer_id"), dtypes, ["filer_id"])
        return wide, wide._jdf.queryExecution().executedPlan().toString()

    many = {f"v{i}": "double" for i in range(300)}
    _, numeric = plan({"a": "double", **many})
    assert numeric.count("Exchange hashpartitioning") == 1 and "pivotfirst" in numeric, numeric
    wide, mixed = plan({"a": "double", "t": "string"})
    assert mixed.count("Exchange hashpartitioning") == 2 and "pivotfirst" in mixed, mixed
    assert sorted(map(tuple, wide.collect()), key=repr) == sorted([(1, 1.0, None), (2, None, "x"), (None, 3.0, None)], key=repr)
    only_text, _ = plan({"t": "string"})
    assert sorted(map(tuple, only_text.collect()), key=repr) == sorted([(1, None), (2, "x"), (None, None)], key=repr)


# --- coverage ---


def summary(spark):
    filers = spark.createDataFrame(
        [("A", "2020Q1", D(2020, 3, 31), f) for f in (1, 1, 2, None)] + [("B", "2020Q1", D(2020, 3, 31), 9), ("A", "2020Q2", D(2020, 6, 30), 1)],
        "entity_type string, quarter string, period date, filer_id bigint",
    )
    catalog = spark.createDataFrame(
        [("A", "2020Q1", "RSSD9001", 4), ("A", "2020Q1", "X", 0), ("A", "2020Q1", "RSSD_ID", 4), ("A", "2020Q2", "X", 1)],
        "entity_type string, quarter string, variable string, n_values bigint",
    )
    return coverage.coverage_summary(filers, catalog)


def test_summary(spark, rows):
    counts = ("entity_type", "quarter", "num_rows", "num_banks", "num_variables", "num_non_null_vars", "num_null_columns")
    assert rows(summary(spark), *counts) == [
        ("A", "2020Q1", 4, 2, 2, 1, 1), ("A", "2020Q2", 1, 1, 1, 1, 0), ("B", "2020Q1", 1, 1, 0, 0, 0)
    ]


def test_pivot(spark):
    pivoted = coverage.pivot_quarters(summary(spark), ["A", "B", "C"])
    assert [tuple(r) for r in pivoted.collect()] == [
        ("2020Q1", D(2020, 3, 31), 2, 2, 1, 0, None, None), ("2020Q2", D(2020, 6, 30), 1, 1, None, None, None, None)
    ]
    doubled = summary(spark).unionByName(summary(spark))
    with pytest.raises(PySparkException, match="more than one row"):
        coverage.pivot_quarters(doubled, ["A"]).collect()


def test_statistics(spark, rows):
    sized = summary(spark).withColumn("file_size_mb", F.lit(0.5))
    stats = coverage.entity_statistics(sized)
    assert rows(stats, "entity_type", "quarters", "avg_filers", "avg_variables", "total_mb") == [
        ("A", 2, 1.5, 1.5, 1.0), ("B", 1, 1.0, 0.0, 0.5)
    ]
    overall = coverage.overall_statistics(sized).head()
    assert (overall.quarters, overall.num_banks_min, overall.num_banks_max, overall.total_mb) == (3, 1, 2, 1.5)
    assert coverage.with_quarter_parts(sized).agg(F.max("year"), F.max("quarter_num")).head() == (2020, 2)


def test_run_statistics(spark, rows):
    data = [("A", "q1", "processed", 10, 5), ("A", "q2", "processed", 20, 8), ("A", "q3", "skipped", 0, 0), ("B", "q1", "error", 0, 0)]
    df = spark.createDataFrame(data, "entity_type string, quarter string, state string, records bigint, columns bigint")
    assert rows(status.run_statistics(df)) == [("A", 2, 1, 0, 30, 6), ("B", 0, 0, 1, 0, None)]


# --- gaps ---

SERIES = {
    "contiguous": ["2019Q3", "2019Q4", "2020Q1"],
    "hole": ["2019Q3", "2020Q1"],
    "long": ["2019Q1", "2020Q1", "2020Q2"],
    "twice": ["2020Q1", "2020Q1", "2020Q2"],
    "single": ["2020Q1"],
}


def filed(spark, series):
    data = []
    for name, labels in series.items():
        for label in labels:
            data.append((name, D(int(label[:4]), int(label[5]) * 3, 1) if label else None))
    return spark.createDataFrame(data, "s string, period date")


def test_gaps(spark, rows):
    df = filed(spark, {**SERIES, "undated": ["2020Q1", None, "2020Q2"]})
    assert rows(gaps.find_gaps(df, "period", ["s"])) == [
        ("hole", "2019Q4", 1, 1), ("long", "2019Q2", 1, 3), ("twice", "2020Q2", 1, 0)
    ]
    assert rows(gaps.find_gaps(df, "period", ["s"], expand=True)) == [
        ("hole", "2019Q4"), ("long", "2019Q2"), ("long", "2019Q3"), ("long", "2019Q4")
    ]
    assert rows(gaps.find_gaps(filed(spark, {"hole": SERIES["hole"]}), "period")) == [("2019Q4", 1, 1)]


def test_gap_preview(spark, rows):
    many = {"many": [f"{y}Q{q}" for y in range(2000, 2006) for q in (1, 3)], "few": ["2000Q1", "2000Q1", "2000Q3"]}
    found = gaps.preview_gaps(gaps.find_gaps(filed(spark, many), "period", ["s"]), ["s"])
    assert rows(found) == [
        ("few", "2000Q2, 2000Q2", 0),
        ("many", ", ".join(f"{y}Q{q}" for y in range(2000, 2005) for q in (2, 4)), 1),
    ]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(8000, 8030), min_size=1, max_size=25))
def test_gaps_like_a_loop(spark, indexes):
    df = spark.createDataFrame([(D(i // 4, i % 4 * 3 + 1, 1),) for i in indexes], "period date")
    expected = [a + 1 for a, b in itertools.pairwise(sorted(indexes)) if b != a + 1]
    found = gaps.find_gaps(df, "period").collect()
    got = sorted(r.missing_quarter for r in found for _ in range(r.entries))
    assert got == sorted(f"{i // 4}Q{i % 4 + 1}" for i in expected)


def test_previews_of_any_size(spark, rows):
    df = spark.createDataFrame([("a", i) for i in range(12)] + [("b", 1)], "g string, v int")
    assert rows(gaps.preview_first(df, ["g"], F.col("v"), [F.col("v").desc()], 3)) == [("a", "11, 10, 9", 9), ("b", "1", 0)]


def test_inventory(spark, rows):
    files = spark.createDataFrame(
        [("/d/FFIEC_002/a.parquet", 1048576), ("/d/x/b.parquet", 524288), ("/d/x/c.parquet", 524288)], "path string, length bigint"
    )
    grouped = inventory.size_by(files, inventory.folder_of(F.col("path"), ["FFIEC_002"]))
    assert rows(grouped) == [("FFIEC_002", 1, 1.0), ("Other", 2, 1.0)]


def test_merge_splits_a_key_with_a_third_of_all_rows(spark):
    """Null and repeated keys are numbered over many ranges, and each place is a group of its own."""
    first = [(None, i % 50) for i in range(400)] + [(7, 1)] * 300 + [(k, k) for k in range(100, 500)]
    second = [(None, i) for i in range(5)] + [(7, 2)] * 350 + [(k, -k) for k in range(300, 600)]
    a = spark.createDataFrame(first, "id long, x long").repartition(6)
    b = spark.createDataFrame(second, "id long, y long").repartition(3)
    found = sorted((tuple(r) for r in merge.merge_schedules([a, b], "id").collect()), key=repr)

    expected = []
    for key in {k for k, _ in first + second}:
        xs, ys = (sorted(v for k, v in rows if k == key) for rows in (first, second))
        places = max(len(xs), len(ys))
        expected += zip([key] * places, xs + [None] * (places - len(xs)), ys + [None] * (places - len(ys)))
    assert found == sorted(expected, key=repr)
    plan = merge.merge_schedules([a, b], "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in plan and "_place" in plan[plan.index("hashpartitioning(_key") :][:60]


def test_period_ranges_prune_quarters(spark, tmp_path, rows):
    folder = str(tmp_path / "facts")
    days = [dt.date(y, m, 1) for y in (2001, 2002, 2003) for m in range(1, 13)] + [None]
    made = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id long, period date")
    quarter = F.when(F.col("period").isNotNull(), F.concat(F.year("period"), F.lit("Q"), F.quarter("period")))
    made.withColumn("quarter", quarter).write.partitionBy("quarter").parquet(folder)
    df = spark.read.parquet(folder)
    for start, end in ((dt.date(2001, 5, 1), dt.date(2002, 8, 31)), (None, dt.date(2001, 3, 31)), (dt.date(2003, 12, 1), None), (None, None)):
        for undated in (False, True):
            pruned = entities.in_period_range(df, "period", start, end, undated, "quarter")
            assert rows(pruned, "id") == rows(entities.in_period_range(df, "period", start, end, undated), "id")
            if start or end:
                plan = pruned._jdf.queryExecution().executedPlan().toString()
                assert "PartitionFilters: [" in plan and "quarter" in plan.split("PartitionFilters: [")[1].split("]")[0]
                assert len(pruned.inputFiles()) <= len(df.inputFiles())
