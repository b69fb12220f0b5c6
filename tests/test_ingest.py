import datetime as dt
import io
import zipfile
import zlib

import pyarrow.parquet as pq
import pytest
from archives import delimited, xport, zipped
from pyspark.sql import functions as F

from filingpanel.constants import ENTITY_CODES
from filingpanel.functions.periods import MONTH_START
from filingpanel.operators.describe import column_descriptions, describe_columns
from filingpanel.plans.bulk import bulk_panel, undated_files
from filingpanel.plans.dictionary import store_dictionary
from filingpanel.plans.historical import historical_panel
from filingpanel.plans.panel import wide_panel
from filingpanel.operators.status import run_statistics
from filingpanel.plans.report import coverage_report
from filingpanel.plans.update import export_wide, update_bulk, update_historical
from filingpanel.sinks import described
from filingpanel.sinks.panel import (
    write_panel,
    write_partitioned,
    write_summary,
    write_wide,
)
from filingpanel.sources import files, slices
from filingpanel.sources.delimited import read_delimited
from filingpanel.sources.dictionary import read_dictionary, read_dictionary_csv
from filingpanel.sources.panel import list_wide_files, read_panel, summarize_wide_files
from filingpanel.streaming.incremental import ingest_new_bulk, ingest_new_historical

D = dt.date
BULK_NAME = "FFIEC CDR Call Bulk All Schedules 03312011.zip"
FORMS = "Variable string, Description string, ReportingForms string"


def put(folder, **named):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in named.items():
        (folder / name).write_bytes(content)
    return str(folder)


def save(folder, contents: dict[str, bytes]):
    return put(folder, **contents)


@pytest.fixture
def bulk_folder(tmp_path):
    first = delimited(
        ["IDRSSD", "rcon1", "RCON2", "TEXT", "EMPTY"],
        [["ids are below", "a description", "x", "y", ""], [1, 10, "NA", "5", ""], [2, "2.5", "", "x5", ""], ["", 1, 1, 1, ""]],
    )
    second = delimited(["RSSD9001", "RCON1", "RCON3"], [[2, 99, 7], [3, 98, "1e2"]])
    latin = delimited(["IDRSSD", "NAME"], [[1, "café"]], "latin-1")
    contents = {
        BULK_NAME: zipped(
            {
                "Schedule RC.txt": first,
                "readme.pdf": b"no",
                "empty.txt": b"",
                "noid.txt": delimited(["a", "b"], [[1, 2]]),
                "Schedule RI.txt": second,
                "names.csv": latin,
                "headeronly.txt": delimited(["IDRSSD", "RCON3"], []),
            }
        ),
        "Call_20240630.txt": delimited(["IDRSSD", "RCON1"], [[7, "é"], [8, ""]]).replace(b"\xc3\xa9", b"3\xff"),
        "nodate.txt": delimited(["IDRSSD", "RCON1"], [[7, 1]]),
        "FFIEC_20231231.zip": b"not a zip",
        "ignored_20240630.xlsx": b"x",
    }
    return save(tmp_path / "bulk dir", contents)


def values(panel, quarter):
    found = panel.facts.where(F.col("quarter") == quarter).collect()
    return sorted(
        [(r.filer_id, r.variable, r.num_value if r.str_value is None else r.str_value) for r in found], key=repr
    )


def test_bulk_panel(spark, bulk_folder, rows):
    known = spark.createDataFrame([("EMPTY", "e", "FFIEC 041")], FORMS)
    panel = bulk_panel(spark, bulk_folder, known)
    # RCON1 stays with the first member, so filer 3 has none; TEXT is text as a whole.
    assert values(panel, "2011Q1") == sorted(
        [(1, "RCON1", 10.0), (2, "RCON1", 2.5), (1, "TEXT", "5"), (2, "TEXT", "x5"), (2, "RCON3", 7.0), (3, "RCON3", 100.0), (1, "NAME", "café")],
        key=repr,
    )
    assert values(panel, "2024Q2") == [(7, "RCON1", 3.0)]
    assert rows(panel.filers, "quarter", "period", "filer_id") == [
        ("2011Q1", D(2011, 3, 31), 1), ("2011Q1", D(2011, 3, 31), 2), ("2011Q1", D(2011, 3, 31), 3),
        ("2024Q2", D(2024, 6, 30), 7), ("2024Q2", D(2024, 6, 30), 8),
    ]
    assert rows(panel.catalog, "quarter", "variable", "dtype", "n_values") == [
        ("2011Q1", "EMPTY", "double", 0), ("2011Q1", "NAME", "string", 1), ("2011Q1", "RCON1", "double", 2),
        ("2011Q1", "RCON3", "double", 2), ("2011Q1", "TEXT", "string", 2), ("2024Q2", "RCON1", "double", 1),
    ]
    without = bulk_panel(spark, bulk_folder)
    assert rows(without.catalog.where("n_values = 0"), "variable") == []
    states = rows(panel.status, "quarter", "state", "records")
    assert ("2011Q1", "processed", 3) in states and ("2023Q4", "error", 0) in states
    assert [r[1] for r in rows(undated_files(spark, bulk_folder))] == ["nodate.txt"]


def test_bulk_wide_form(spark, bulk_folder):
    known = spark.createDataFrame([("RCON1", "One", "FFIEC 041"), ("TEXT", "Text", "")], FORMS)
    panel = bulk_panel(spark, bulk_folder, known, period_style=MONTH_START)
    wide = wide_panel(panel, "FFIEC_031_041", "2011Q1", known, ("RSSD_ID", "REPORTING_PERIOD"), "sorted")
    assert wide.columns == ["RSSD_ID", "REPORTING_PERIOD", "NAME", "RCON1", "RCON3", "TEXT"]
    assert column_descriptions(wide) == {"RCON1": "One", "TEXT": "Text"}
    day = D(2011, 3, 1)
    assert sorted(map(tuple, wide.collect())) == [
        (1, day, "café", 10.0, None, "5"), (2, day, None, 2.5, 7.0, "x5"), (3, day, None, None, 100.0, None)
    ]


def test_bulk_ranges_never_open_other_files(spark, bulk_folder, rows):
    assert rows(bulk_panel(spark, bulk_folder, start=D(2024, 1, 1)).filers, "quarter") == [("2024Q2",)] * 2
    assert rows(bulk_panel(spark, bulk_folder, end=D(2011, 3, 31)).status, "state") == [("error",)] * 2 + [("processed",)]
    skipped = bulk_panel(spark, bulk_folder, skip_quarters=["2011Q1", "2023Q4"])
    assert rows(skipped.status, "quarter") == [("2024Q2",)]


def test_a_late_error_rejects_the_whole_member(spark, tmp_path, rows):
    good = delimited(["IDRSSD", "A"], [[i, i] for i in range(3000)])
    folder = save(tmp_path, {"x_20240331.zip": zipped({"bad.txt": good + b"1\t2\t3\t4\n", "ok.txt": delimited(["IDRSSD", "B"], [[1, 2]])})})
    panel = bulk_panel(spark, folder)
    assert rows(panel.facts, "filer_id", "variable", "num_value") == [(1, "B", 2.0)]
    assert rows(panel.status, "state") == [("error",), ("processed",)]


def test_a_damaged_archive_is_rejected_as_a_whole(spark, tmp_path, rows):
    import zipfile

    path = tmp_path / "in" / "x_20240331.zip"
    path.parent.mkdir()
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("a.txt", delimited(["IDRSSD", "A"], [[1, 1]]))
        archive.writestr("b.txt", delimited(["IDRSSD", "MARK"], [[1, 2]]))
    path.write_bytes(path.read_bytes().replace(b"MARK\n1\t2", b"MARK\n1\t3"))
    panel = bulk_panel(spark, str(path.parent))
    assert panel.facts.count() == 0 and panel.filers.count() == 0
    assert rows(panel.status, "state", "message")[0][1].startswith("x_20240331.zip: BadZipFile")


@pytest.mark.parametrize("block", [64, 1000, 1 << 22])
def test_files_beyond_a_row_decode_like_others(spark, bulk_folder, tmp_path, monkeypatch, block):
    """All kinds of members, broken archives and loose files; read whole and in blocks of many sizes."""
    from filingpanel.sources import blocks

    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(blocks, "TAIL_BYTES", 30)
    monkeypatch.setattr(blocks.file_blocks, "__defaults__", (block,))
    long = delimited(["IDRSSD", "A", "B"], [[i, f'"x\ny{i}"', "é"] for i in range(900)])
    whole = zipped({f"m{k}.txt": delimited(["IDRSSD", f"V{k}"], [[k, k]]) for k in range(40)} | {"long.txt": long, "l1.csv": long.decode().encode("latin-1")})
    folder = put(
        tmp_path / "more",
        **{
            "a +b%20 03312012.txt": long + b"9999\t1\t2",
            "mark 06302012.txt": b"\xef\xbb\xbf" + delimited(["IDRSSD", "A"], [[1, 2]]),
            "open 09302012.txt": delimited(["IDRSSD", "A"], [[1, '"never closed'], [2, 3]]),
            "[x]{y} 12312012.zip": whole,
            "cut 03312013.zip": whole[: len(whole) // 2],
            "wrong 06302013.zip": whole.replace(zlib.crc32(long).to_bytes(4, "little"), b"1234"),
            "none 09302013.zip": zipped({"readme.pdf": b""}),
        },
    )
    for name in (bulk_folder, folder):
        rows_, errors = [], []
        for most in (1, files.MOST_BYTES):
            decoded = read_delimited(spark, name, most_bytes=most).collect()
            failed = {r.path for r in decoded if r.error is not None and r.member_ordinal == -1}
            errors.append(sorted({(r.path, r.member_ordinal, r.source_name, r.error.split(":")[0]) for r in decoded if r.error is not None and not (r.path in failed and r.member_ordinal >= 0)}))
            rows_.append(sorted(repr((r.path, r.source_name, r.member_ordinal, r.period, r.filer_id, r.cells)) for r in decoded if r.error is None and r.path not in failed))
        assert rows_[0] == rows_[1] and len(rows_[0]) > 3
        assert errors[0] == errors[1] and len(errors[0]) >= 2


def test_members_are_unpacked_in_pieces():
    import random

    from filingpanel.sources.blocks import MemberStream

    data = random.Random(1).randbytes(5000) * 3
    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", method) as archive:
            archive.writestr("a b.txt", data)
            info = archive.infolist()[0]
        raw = buffer.getvalue()
        for size in (1, 7, 4096, 10**6):
            parts = iter([raw[k : k + size] for k in range(0, len(raw), size)])
            stream = MemberStream(parts, method, info.compress_size, info.CRC)
            assert b"".join(iter(lambda: stream.read(333), b"")) == data
        with pytest.raises(zipfile.BadZipFile):
            MemberStream(iter([raw]), method, info.compress_size, info.CRC + 1).read()
        with pytest.raises(EOFError):
            MemberStream(iter([raw[:200]]), method, info.compress_size, info.CRC).read()


def test_quotes_are_followed_line_by_line():
    import random

    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(['"', '"', "\t", "\t", "\n", "x", "y"]) for _ in range(40)) + "\n"
        ends, state = [], False
        for line in text.encode().splitlines(keepends=True):
            state = slices.stays_quoted(line, state)
            ends.append(not state)
        expected = [end for _, end in slices._rows_with_ends(text.encode())]
        at, own = 0, []
        for line, end in zip(text.splitlines(keepends=True), ends):
            at += len(line)
            if end:
                own.append(at)
        assert own == [e for e in expected if e < len(text) or ends[-1]]


def test_a_quote_that_is_never_closed_costs_linear_time():
    import time

    def seconds(n: int) -> float:
        data = b'1\t"open\n' + b"2\tx\n" * n
        started = time.process_time()
        assert b"".join(slices.text_slices(io.BytesIO(data), 1 << 16)) == data
        return time.process_time() - started

    seconds(10_000)
    assert seconds(1_600_000) < 40 * max(0.02, seconds(100_000))


def test_slices_end_at_rows():
    import io

    rows_ = [f'{i}\t"a\n{i}"\tx"y\t{"z" * (i % 7)}' for i in range(400)] + ["1\t2", "", "3\r", '4\t"open\n']
    data = "\n".join(rows_).encode()
    for size in (7, 64, 1000, 10**6):
        pieces = list(slices.text_slices(io.BytesIO(data), size))
        assert b"".join(pieces) == data
        assert all(p.decode().startswith(tuple("0123456789\n")) for p in pieces)
        assert sum(p.count(b'"a\n') for p in pieces) == 400
    plain = b"\n".join(b"%d\tx" % i for i in range(100))
    assert b"".join(slices.text_slices(io.BytesIO(plain), 50)) == plain
    assert slices.header_end(b'\n \n"a\nb"\tc\n1\t2') == 11


def test_many_slices_give_the_same_panel(spark, bulk_folder, historical_folder, rows, monkeypatch):
    """Tiny slices cut in the driver's process, so that the tasks' own setting does not matter."""
    from filingpanel.sources import cells, delimited, xport

    for module, source, paths in (
        (delimited, lambda f: delimited._cut, bulk_folder), (xport, lambda f: None, historical_folder)
    ):
        listed = files.read_files(spark, paths, module.PATTERN).collect()
        whole, tiny = [], []
        for size, out in ((slices.SLICE_BYTES, whole), (40, tiny)):
            monkeypatch.setattr(slices, "SLICE_BYTES", size)
            monkeypatch.setattr(slices.text_slices, "__defaults__", (size,))
            for f in listed:
                try:
                    with files.open_file(bytes(f.content)) as stream:
                        if module is delimited:
                            pieces = list(delimited._cut_file(f.path, f.file_name, stream))
                        else:
                            pieces = list(xport._cut_file(f.path, f.file_name, bytes(f.content), None, None))
                except cells.DECODE_ERRORS:
                    continue
                for p in pieces:
                    for piece in p.to_pylist():
                        piece["period"] = None
                        parse = delimited._parse_slice(piece) if module is delimited else xport._parse_slice(piece, True)
                        for batch in parse:
                            out += [(r["path"], r["source_name"], r["filer_id"], r["cells"], r["error"]) for r in batch.to_pylist()]
        assert len(tiny) >= len(whole) > 0
        unique = lambda found: sorted({repr(r) for r in found})
        assert unique(tiny) == unique(whole)


def test_repeated_ids_and_chunks_keep_every_row(spark, tmp_path, rows):
    data = [[i % 1500, i] for i in range(3200)]
    folder = save(tmp_path, {"x_20240331.txt": delimited(["IDRSSD", "A"], data)})
    panel = bulk_panel(spark, folder)
    assert panel.facts.count() == 3200 and panel.filers.count() == 3200
    assert panel.facts.agg(F.sum("num_value")).head()[0] == sum(range(3200))
    assert panel.filers.where("occurrence = 1").count() == 1500
    assert wide_panel(panel, "FFIEC_031_041").count() == 3200


def model_of(members: list[bytes]):
    """The merged wide table of an archive, with an ordinary data frame library."""
    import io

    import pandas as pd

    merged = None
    for content in members:
        frame = pd.read_csv(io.BytesIO(content), sep="\t", dtype=str).rename(columns={"IDRSSD": "RSSD_ID"})
        frame["RSSD_ID"] = pd.to_numeric(frame["RSSD_ID"], errors="coerce")
        frame = frame.dropna(subset=["RSSD_ID"]).astype({"RSSD_ID": int})
        for column in frame.columns.drop("RSSD_ID"):
            numbers = pd.to_numeric(frame[column], errors="coerce")
            if numbers.notna().equals(frame[column].notna()):
                frame[column] = numbers.astype(float)
        if merged is not None:
            frame = merged.merge(frame.drop(columns=[c for c in frame if c in merged and c != "RSSD_ID"]), on="RSSD_ID", how="outer")
        merged = frame
    return merged


def test_random_archives_like_a_data_frame_model(spark, tmp_path):
    import random

    import pandas as pd

    pick = random.Random(5)
    contents, expected = {}, {}
    choices = ["1", "2.5", "1e3", "", "NA", "-7", "text", '"quoted\ttab"', "12%", " 8 "]
    for quarter, stamp in (("2012Q1", "03312012"), ("2012Q2", "06302012"), ("2013Q4", "12312013")):
        members = []
        for _ in range(5):
            names = pick.sample([f"V{i:02d}" for i in range(20)], 8)
            ids = pick.sample(range(1, 60), 30)
            some = {n: choices if pick.random() < 0.3 else choices[:6] for n in names}
            members.append(delimited(["IDRSSD", *names], [["bad id", *names]] + [[i, *[pick.choice(some[n]) for n in names]] for i in ids]))
        contents[f"Bulk {stamp}.zip"] = zipped({f"m{i}.txt": m for i, m in enumerate(members)})
        expected[quarter] = model_of(members)
    panel = bulk_panel(spark, save(tmp_path / "in", contents))
    for quarter, model in expected.items():
        wide = wide_panel(panel, "FFIEC_031_041", quarter, rest="sorted").drop("REPORTING_PERIOD").toPandas()
        filled = [c for c in sorted(model.columns.drop("RSSD_ID")) if model[c].notna().any()]
        assert list(wide.columns) == ["RSSD_ID", *filled]
        left = wide.sort_values("RSSD_ID").reset_index(drop=True)
        right = model[["RSSD_ID", *filled]].sort_values("RSSD_ID").reset_index(drop=True)
        for column in filled:
            pd.testing.assert_series_equal(left[column], right[column], check_dtype=False)
        assert left["RSSD_ID"].tolist() == right["RSSD_ID"].tolist()


def test_two_files_of_a_quarter(spark, tmp_path, rows):
    files_ = {
        "a_20240331.txt": b"",
        "b_20240331.txt": delimited(["IDRSSD", "A"], [[1, 1]]),
        "c_20240331.txt": delimited(["IDRSSD", "A"], [[1, 2]]),
    }
    folder = save(tmp_path, files_)
    assert rows(bulk_panel(spark, folder).facts, "num_value") == [(1.0,)]
    assert rows(bulk_panel(spark, folder, on_duplicate="last").facts, "num_value") == [(2.0,)]
    with pytest.raises(ValueError):
        bulk_panel(spark, folder, on_duplicate="any")


# --- historical quarters ---


def quarter_file(offset=0.0, **extra):
    return xport(
        {
            "RSSD9001": [101.0, 102.0, 103.0, 104.0, 105.0, 106.0, None],
            "RSSD9331": [1.0, 10.0, 11.0, 13.0, 17.0, 2.0, 1.0],
            "rcon2170": [1.5 + offset, 0.0, -250.0, None, 1e6, 9.0, 3.0],
            "RCONOFF": [None] * 4 + [4.0, None, None],
            "RCONON": [None] * 7,
            "NAME": ["Bänk", b"caf\xe9", "", "d", "e", "f", "g"],
            **extra,
        }
    )


@pytest.fixture
def historical_folder(tmp_path):
    return save(
        tmp_path / "raw",
        {
            "call1012.zip": zipped({"doc.txt": b"x", "CALL1012.XPT": quarter_file()}),
            "call1103.xpt": quarter_file(1.0),
            "call1106.xpt": xport({"RSSD9001": [1.0], "A": [1.0]}),
            "call1109.zip": zipped({"a.txt": b""}),
            "call1112.xpt": b"broken",
            "call1104.xpt": quarter_file(),
        },
    )


KNOWN = [("RCONON", "On form", "FFIEC 002,FFIEC 041"), ("RCON2170", "Total assets", "FFIEC 041")]


def test_historical_panel(spark, historical_folder, rows):
    panel = historical_panel(spark, historical_folder, spark.createDataFrame(KNOWN, FORMS))
    counts = panel.filers.groupBy("quarter", "entity_type").count()
    assert rows(counts) == sorted(
        [("2010Q4", "FFIEC_031_041", 2), ("2010Q4", "FFIEC_002", 2), ("2010Q4", "FRB_2886b", 2), ("2011Q1", "FFIEC_002", 2), ("2011Q1", "FRB_2886b", 2)],
        key=repr,
    )
    found = panel.facts.where("variable in ('RCON2170', 'NAME')")
    got = {(r.quarter, r.filer_id, r.variable): r.num_value if r.str_value is None else r.str_value for r in found.collect()}
    assert got["2010Q4", 101, "RCON2170"] == 1.5 and got["2010Q4", 102, "RCON2170"] == 0.0
    assert got["2010Q4", 103, "RCON2170"] == -250.0 and got["2010Q4", None, "RCON2170"] == 3.0
    assert ("2010Q4", 104, "RCON2170") not in got and got["2011Q1", 105, "RCON2170"] == 1e6
    assert got["2010Q4", 101, "NAME"] == "Bänk" and got["2010Q4", 102, "NAME"] == "café" and got["2010Q4", 103, "NAME"] == ""
    kept = rows(panel.catalog.where("quarter = '2010Q4'"), "entity_type", "variable", "dtype", "n_values")
    assert ("FFIEC_002", "RCONON", "double", 0) in kept and ("FRB_2886b", "RCONOFF", "double", 1) in kept
    assert not [k for k in kept if k[:2] in (("FRB_2886b", "RCONON"), ("FFIEC_002", "RCONOFF"))]
    assert ("FFIEC_002", "NAME", "string", 2) in kept and ("FFIEC_002", "RSSD9331", "double", 2) in kept
    messages = [r.message for r in panel.status.where("state = 'error'").collect()]
    assert len(messages) == 3 and any("RSSD9331" in m for m in messages), messages


def test_historical_options(spark, historical_folder, rows):
    late = historical_panel(spark, historical_folder, start=D(2011, 1, 1), end=D(2011, 3, 31))
    assert rows(late.filers.select("quarter").distinct()) == [("2011Q1",)]
    assert late.status.where("state = 'error'").count() == 0  # the archive without transport file has a quarter out of range
    skipped = historical_panel(spark, historical_folder, skip_quarters=["2010Q4"], blank_is_data=False)
    assert rows(skipped.filers.select("quarter").distinct()) == [("2011Q1",)]
    assert skipped.facts.where("filer_id = 103 and variable = 'NAME'").count() == 0


def test_historical_wide_form(spark, historical_folder):
    panel = historical_panel(spark, historical_folder, spark.createDataFrame(KNOWN, FORMS))
    wide = wide_panel(panel, "FFIEC_002", "2011Q1", spark.createDataFrame(KNOWN, FORMS))
    assert wide.columns == ["REPORTING_PERIOD", "RSSD_ID", "RSSD9001", "RSSD9331", "RCON2170", "RCONON", "NAME"]
    assert column_descriptions(wide) == {"RCON2170": "Total assets", "RCONON": "On form"}
    assert sorted(map(tuple, wide.collect())) == [
        (D(2011, 3, 31), 102, 102.0, 10.0, 0.0, None, "café"), (D(2011, 3, 31), 103, 103.0, 11.0, -250.0, None, "")
    ]


# --- panels on disk, reports, streams ---


def test_write_read_report(spark, historical_folder, bulk_folder, tmp_path, rows):
    out = str(tmp_path / "panel")
    write_panel(historical_panel(spark, historical_folder), out)
    write_panel(bulk_panel(spark, bulk_folder), out)
    panel = read_panel(spark, out)
    assert panel.facts.where("quarter = '2010Q4'").count() > 0 and panel.facts.where("quarter = '2024Q2'").count() == 1
    plan = panel.facts.where("quarter = '2010Q4'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quarter" in plan
    report = coverage_report(spark, out)
    assert rows(report.summary, "entity_type", "quarter", "num_banks", "num_variables") == [
        ("FFIEC_002", "2010Q4", 2, 4), ("FFIEC_002", "2011Q1", 2, 4),
        ("FFIEC_031_041", "2010Q4", 1, 4), ("FFIEC_031_041", "2011Q1", 3, 4), ("FFIEC_031_041", "2024Q2", 2, 1),
        ("FRB_2886b", "2010Q4", 2, 5), ("FRB_2886b", "2011Q1", 2, 5),
    ]
    assert report.summary.where("file_size_mb > 0 and file_path is not null").count() == 7
    assert rows(report.gap_preview) == [("FFIEC_031_041", "2011Q2", 0)]
    assert rows(report.entities, "entity_type", "quarters") == [("FFIEC_002", 2), ("FFIEC_031_041", 3), ("FRB_2886b", 2)]
    assert report.overall.head().quarters == 7
    assert [tuple(r)[:3] for r in report.quarters.select("quarter", "FFIEC_002_num_banks", "FRB_2886b_num_banks").collect()] == [
        ("2010Q4", 2, 2), ("2011Q1", 2, 2), ("2024Q2", None, None)
    ]
    early = coverage_report(spark, out, end=D(2010, 12, 31))
    assert early.summary.count() == 3
    write_summary(report.summary, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert {"year", "quarter_num", "file_size_mb"} <= set(back.columns) and back.count() == 7


def test_partitions_are_replaced_or_kept(spark, tmp_path, rows):
    folder = str(tmp_path / "p")
    schema = "entity_type string, quarter string, v int"
    write_partitioned(spark.createDataFrame([("A", "q1", 1), ("A", "q2", 2)], schema), folder)
    write_partitioned(spark.createDataFrame([("A", "q2", 3), ("B", "q1", 4)], schema), folder)
    stored = lambda: rows(spark.read.parquet(folder), "entity_type", "quarter", "v")
    assert stored() == [("A", "q1", 1), ("A", "q2", 3), ("B", "q1", 4)]
    more = spark.createDataFrame([("A", "q1", 8), ("A", "q3", 9)], schema)
    write_partitioned(more, folder, replace="all")
    assert stored() == [("A", "q1", 8), ("A", "q3", 9)]
    with pytest.raises(ValueError):
        write_partitioned(more, folder, replace="some")


def test_wide_files_of_other_origin(spark, tmp_path, rows):
    """Files whose column types differ between quarters, below entity folders and flat."""
    day = "timestamp'2020-03-31 00:00:00'"
    base = tmp_path / "processed"
    for entity in ("FFIEC_002", "FRB_2886b"):
        for quarter, kind in (("2020Q1", "double"), ("2020Q2", "string")):
            wide = spark.range(3).select(
                F.expr(day).alias("REPORTING_PERIOD"),
                F.expr("cast(nullif(id, 2) as double)").alias("RSSD_ID"),
                F.lit(None).cast(kind).alias("A"),
                F.lit(1).cast(kind).alias("B"),
            )
            wide.toPandas().to_parquet(str((base / entity).mkdir(parents=True, exist_ok=True) or base / entity / f"{quarter}.parquet"), coerce_timestamps="us")
    found = summarize_wide_files(spark, str(base), check_null_columns=True)
    columns = ("entity_type", "quarter", "num_banks", "num_variables", "num_non_null_vars", "num_null_columns", "file_path")
    assert rows(found, *columns) == [
        (e, q, 2, 2, 1, 1, f"{q}.parquet") for e in ("FFIEC_002", "FRB_2886b") for q in ("2020Q1", "2020Q2")
    ]
    assert rows(summarize_wide_files(spark, str(base)), "num_non_null_vars") == [(2,)] * 4
    flat = str(base / "FFIEC_002")
    assert rows(list_wide_files(spark, flat, ["none"]), "entity_type", "quarter") == [("All", "2020Q1"), ("All", "2020Q2")]
    assert found.where("file_size_mb > 0 and date is not null").count() == 4


def test_write_wide_keeps_descriptions(spark, historical_folder, tmp_path):
    known = spark.createDataFrame(KNOWN, FORMS)
    panel = historical_panel(spark, historical_folder, known)
    folder = str(tmp_path / "wide")
    write_wide(wide_panel(panel, "FFIEC_002", "2010Q4", known), folder)
    assert column_descriptions(spark.read.parquet(folder))["RCON2170"] == "Total assets"


def test_forced_quarter_that_lost_all_values(spark, tmp_path, rows):
    first, second, out = tmp_path / "first", tmp_path / "second", str(tmp_path / "panel")
    for folder, names, value in ((first, ("12312020", "03312021"), "5"), (second, ("12312020",), "")):
        folder.mkdir()
        for name in names:
            (folder / f"Bulk {name}.txt").write_text(f"IDRSSD\tRCON1\n1\t{value}\n2\t{value}\n")
    update_bulk(spark, str(first), out)
    update_bulk(spark, str(second), out, force=True)
    panel = read_panel(spark, out)
    assert rows(panel.facts.groupBy("quarter").count()) == [("2021Q1", 2)]
    assert rows(panel.filers.groupBy("quarter").count()) == [("2020Q4", 2), ("2021Q1", 2)]
    assert not (tmp_path / "panel" / "facts" / "entity_type=FFIEC_031_041" / "quarter=2020Q4").exists()


@pytest.mark.parametrize("file_bytes, one_file", [(1 << 20, True), (1, True), (1 << 20, False)])
def test_write_described(spark, tmp_path, file_bytes, one_file):
    wide = describe_columns(
        spark.range(25_000).selectExpr(
            "id AS RSSD_ID", "timestamp'2020-03-31 00:00:00' AS REPORTING_PERIOD", "IF(id % 7 = 0, NULL, id / 2) AS rcon1",
            "concat('caf\u00e9', id) AS TEXT", "CAST(NULL AS double) AS EMPTY", "current_date() AS D"
        ),
        {"RCON1": "Total assets \u2013 all", "TEXT": "", "D": "Day"},
    )
    path = tmp_path / "2020Q1.parquet"
    for _ in range(2):  # the second run replaces the first
        described.write_described(wide, str(path), one_file, file_bytes)
    files = [path] if path.is_file() else sorted(path.glob("*.parquet"))
    assert path.is_file() == (one_file and file_bytes > 1) and (len(files) > 1 or file_bytes > 1)
    for file in files:
        fields = pq.ParquetFile(file).schema_arrow
        assert {f.name: f.metadata.get(b"description").decode() for f in fields if f.metadata and b"description" in f.metadata} == {
            "rcon1": "Total assets \u2013 all", "D": "Day"
        }
    back = spark.read.parquet(str(path))
    assert back.dtypes == wide.dtypes and column_descriptions(back) == column_descriptions(wide)
    assert back.count() == 25_000 and back.exceptAll(wide).count() == 0
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["2020Q1.parquet"]


def test_write_described_without_rows(spark, tmp_path):
    path = tmp_path / "none.parquet"
    described.write_described(describe_columns(spark.range(0), {"ID": "Number"}), str(path), one_file=True)
    assert pq.ParquetFile(path).schema_arrow.field("id").metadata[b"description"] == b"Number"
    assert spark.read.parquet(str(path)).count() == 0


EXPORT = (
    "PUBLIC\n"
    "Mnemonic,Item Code,Start Date,End Date,Item Name,Confidentiality,Reporting Form\n"
    'RCON,2170,1/1/1980 12:00:00 AM,12/31/9999 12:00:00 AM,"Total assets, all",N,FFIEC 041\n'
    'RCON,0010,1/1/1980 12:00:00 AM,3/31/2001 12:00:00 AM,"A ""quoted"" &amp;\nbroken name",N,FFIEC 031\n'
    "RIAD,NA,,,,N,\n"
    "BHCK,2170,,,other,N,FR Y-9C\n"
)


@pytest.mark.parametrize("encoding, text", [("utf-8", "caf\xe9 €"), ("latin-1", "caf\xe9")])
def test_dictionary_export(spark, tmp_path, rows, encoding, text):
    export = tmp_path / "export.csv"
    export.write_bytes((EXPORT + f"RCFD,0001,,,{text},N,FFIEC 002\n").encode(encoding))
    raw = read_dictionary_csv(spark, str(export))
    assert raw.columns[:2] == ["Mnemonic", "Item Code"] and raw.count() == 5
    stored = store_dictionary(spark, str(export), str(tmp_path / "out"))
    assert rows(stored) == [
        ("RCFD0001", text, "FFIEC 002"), ("RCON0010", 'A "quoted" & broken name', "FFIEC 031"), ("RCON2170", "Total assets, all", "FFIEC 041")
    ]
    csv = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out" / "data_dictionary.csv"))
    assert [r.Variable for r in csv.collect()] == ["RCFD0001", "RCON0010", "RCON2170"]


def test_zipped_dictionary(spark, tmp_path, rows):
    members = {"a/readme.txt": b"x", "deep/MDRM.CSV": (EXPORT + "RCFD,0001,,,caf\xe9,N,\n").encode("latin-1"), "z.csv": b"no"}
    (tmp_path / "d.zip").write_bytes(zipped(members))
    stored = store_dictionary(spark, str(tmp_path / "d.zip"), str(tmp_path / "out"))
    assert rows(stored) == [
        ("RCFD0001", "caf\xe9", ""), ("RCON0010", 'A "quoted" & broken name', "FFIEC 031"), ("RCON2170", "Total assets, all", "FFIEC 041")
    ]


def test_updates_skip_what_is_done(spark, historical_folder, bulk_folder, tmp_path, rows):
    out = str(tmp_path / "panel")
    first = update_historical(spark, historical_folder, out, end=D(2010, 12, 31))
    assert rows(first.where("state = 'processed'"), "quarter", "entity_type") == [("2010Q4", e) for e in sorted(ENTITY_CODES)]
    second = update_historical(spark, historical_folder, out, spark.createDataFrame(KNOWN, FORMS))
    assert rows(run_statistics(second.where("entity_type is not null")), "entity_type", "processed", "skipped", "records") == [
        ("FFIEC_002", 1, 1, 2), ("FFIEC_031_041", 0, 1, 0), ("FRB_2886b", 1, 1, 2)
    ]
    update_bulk(spark, bulk_folder, out)
    again = update_bulk(spark, bulk_folder, out)
    assert rows(again.where("state != 'error'"), "quarter", "state") == [("2011Q1", "skipped"), ("2024Q2", "skipped")]
    counts = rows(read_panel(spark, out).filers.groupBy("entity_type", "quarter").count())
    assert ("FFIEC_031_041", "2011Q1", 3) in counts and len(counts) == 7
    forced = update_bulk(spark, bulk_folder, out, force=True)
    assert forced.where("state = 'processed'").count() == 2
    assert rows(read_panel(spark, out).filers.groupBy("entity_type", "quarter").count()) == counts

    wide = str(tmp_path / "wide")
    assert len(export_wide(spark, out, wide, spark.createDataFrame(KNOWN, FORMS))) == 7
    exported = spark.read.parquet(f"{wide}/FFIEC_002/2011Q1.parquet")
    assert exported.columns[:2] == ["REPORTING_PERIOD", "RSSD_ID"] and "RCONON" in exported.columns
    assert column_descriptions(exported)["RCON2170"] == "Total assets"
    assert spark.read.parquet(f"{wide}/FFIEC_031_041/2011Q1.parquet").columns == [
        "RSSD_ID", "REPORTING_PERIOD", "NAME", "RCON1", "RCON3", "TEXT"
    ]
    both = summarize_wide_files(spark, wide, check_null_columns=True)
    assert rows(both, "entity_type", "quarter", "num_banks", "num_variables", "num_null_columns") == [
        ("FFIEC_002", "2010Q4", 2, 4, 0), ("FFIEC_002", "2011Q1", 2, 5, 1),
        ("FFIEC_031_041", "2010Q4", 1, 4, 0), ("FFIEC_031_041", "2011Q1", 3, 4, 0), ("FFIEC_031_041", "2024Q2", 2, 1, 0),
        ("FRB_2886b", "2010Q4", 2, 5, 0), ("FRB_2886b", "2011Q1", 2, 5, 0),
    ]


def test_stored_dictionary_without_forms(spark, tmp_path, rows):
    path = str(tmp_path / "d")
    spark.createDataFrame([("A", "a")], "Variable string, Description string").write.parquet(path)
    assert rows(read_dictionary(spark, path)) == [("A", "a", "")]


def test_streams_process_each_archive_once(spark, tmp_path, rows):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    save(source, {"Call_20240331.txt": delimited(["IDRSSD", "A"], [[1, 1]])})
    ingest_new_bulk(spark, str(source), out, checkpoint).awaitTermination()
    save(source, {"Call_20240630.txt": delimited(["IDRSSD", "A"], [[1, 2], [2, 3]]), "undated.txt": b"IDRSSD\n1\n"})
    for _ in range(2):
        ingest_new_bulk(spark, str(source), out, checkpoint).awaitTermination()
    panel = read_panel(spark, out)
    assert rows(panel.facts, "quarter", "filer_id", "num_value") == [("2024Q1", 1, 1.0), ("2024Q2", 1, 2.0), ("2024Q2", 2, 3.0)]
    assert rows(panel.status, "quarter", "records") == [("2024Q1", 1), ("2024Q2", 2)]
    save(source, {"call1012.xpt": quarter_file()})
    ingest_new_historical(spark, str(source), out, str(tmp_path / "cp2")).awaitTermination()
    assert read_panel(spark, out).filers.select("entity_type").distinct().count() == len(ENTITY_CODES)


def test_listing_opens_nothing(spark, bulk_folder):
    listed = files.list_files(spark, bulk_folder)
    assert listed.count() == 5
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    assert listed.where(F.col("file_name") == BULK_NAME).count() == 1


def test_facts_are_exploded_after_the_exchange(spark, bulk_folder, tmp_path):
    """Values cross the network as arrays of a filer row; only filer rows are rebalanced."""
    panel = bulk_panel(spark, bulk_folder)
    plan = panel.expand(panel.values.hint("rebalance", "entity_type", "quarter"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RebalancePartitions")
    out = str(tmp_path / "panel")
    write_panel(panel, out)
    assert read_panel(spark, out).facts.count() == panel.facts.count()


def test_release_removes_what_was_staged(spark, bulk_folder):
    import os

    panel = bulk_panel(spark, bulk_folder)
    assert panel.folders and all(os.path.isdir(f) for f in panel.folders)
    panel.release()
    assert not any(os.path.exists(f) for f in panel.folders)


def test_skipped_quarters_are_not_decoded(spark, historical_folder, tmp_path):
    from filingpanel.sources.xport import read_xport

    decoded = read_xport(spark, historical_folder, skip_quarters=["2010Q4"])
    assert decoded.where("period = date'2010-12-31' and error is null").count() == 0
    out = str(tmp_path / "panel")
    update_historical(spark, historical_folder, out)
    update_historical(spark, historical_folder, out)
    states = {(r.path.rsplit("/", 1)[-1], r.state) for r in spark.read.parquet(out + "/inputs").collect()}
    assert {("call1012.zip", "processed"), ("call1012.zip", "skipped"), ("call1104.xpt", "undated"), ("call1112.xpt", "error")} <= states


def test_header_only_files_have_a_state(spark, tmp_path):
    contents = {"a_20240331.txt": delimited(["IDRSSD", "A"], []), "b_20240630.txt": delimited(["IDRSSD", "A"], [["x", 1]]), "c.txt": b"IDRSSD"}
    panel = bulk_panel(spark, save(tmp_path / "in", contents))
    assert {r.path.rsplit("/", 1)[-1]: r.state for r in panel.inputs.collect()} == {"a_20240331.txt": "empty", "b_20240630.txt": "empty", "c.txt": "undated"}


def test_workers_need_no_install(tmp_path):
    """A driver started elsewhere has the package on its own path only."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from filingpanel.session import build_session\n"
        "from filingpanel.sources.delimited import read_delimited\n"
        "spark = build_session('local[2]', 2, **{'spark.ui.enabled': 'false'})\n"
        "print('found', read_delimited(spark, sys.argv[1]).where('row_no >= 0').count())\n"
    )
    folder = save(tmp_path / "in", {"a_20240331.txt": delimited(["IDRSSD", "A"], [[1, 2], [2, 3]])})
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script, folder], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=180)
    assert "found 2" in done.stdout, done.stderr[-2000:]
