"""Steps whose tasks must not hold a file, an archive or a whole text."""

import io
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from filingpanel import pipeline_queries
from filingpanel.functions import text
from filingpanel.sinks import described
from filingpanel.sources import blocks, cells, delimited, files, panel, slices
from filingpanel.streaming import incremental


def _lines(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("n "), F.col("id") % 2, F.lit(".zip")).alias("name"), F.col("id").alias("place"), F.sha2(F.col("id").cast("string"), 256).alias("line")
    )


def test_archives_are_streams(spark, tmp_path):
    """Chunks in, pieces out: neither side of the packing task is a whole archive."""
    lines = _lines(spark, 30_000).withColumns({"number": (F.col("place") % 3 == 0).cast("int"), "member": F.when(F.col("place") % 3 == 0, "b.txt").otherwise("a.txt")})
    none = spark.createDataFrame([("n 0.zip", -1, None, 2, "none.txt"), ("n 1.zip", 7, None, 0, "a.txt")], lines.schema)
    folder = tmp_path / "archives"
    pipeline_queries.write_archives(lines.unionByName(none), str(folder))
    rows = lines.orderBy("place").collect()
    assert sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) == ["n 0.zip", "n 1.zip"]
    for name, members in (("n 0.zip", ["a.txt", "b.txt", "none.txt"]), ("n 1.zip", ["a.txt", "b.txt"])):
        with zipfile.ZipFile(folder / name) as archive:
            assert archive.namelist() == members and archive.testzip() is None
            for member in members:
                assert archive.read(member).decode() == "".join(r["line"] + "\n" for r in rows if (r["name"], r["member"]) == (name, member))
    assert 2 < pipeline_queries._chunks(lines, "name", "number", "member").count() < 1_000


def test_archive_pieces():
    content = random.Random(1).randbytes(8 << 20)
    batches = [pa.RecordBatch.from_pylist([{"name": "n", "number": 0, "member": "m", "part": 0, "turn": k, "data": content[k << 20 : (k + 1) << 20]}]) for k in range(8)]
    pieces = [batch.to_pylist()[0] for batch in pipeline_queries._archived(iter(batches))]
    assert [p["turn"] for p in pieces] == list(range(len(pieces))) and len(pieces) > 3
    with zipfile.ZipFile(io.BytesIO(b"".join(p["data"] + b"\n" for p in pieces))) as archive:
        assert archive.read("m") == b"".join(content[k << 20 : (k + 1) << 20] + b"\n" for k in range(8))


def test_named_files_are_sorted_as_chunks(spark, tmp_path):
    lines = _lines(spark, 30_000)
    repeated = lines.where("place < 5").withColumn("line", F.lit(""))
    pipeline_queries.write_named(lines.where("place >= 5").unionByName(repeated), str(tmp_path / "named"))
    rows = lines.orderBy("place").collect()
    for name in ("n 0.zip", "n 1.zip"):
        expected = "".join(("" if r["place"] < 5 else r["line"]) + "\n" for r in rows if r["name"] == name)
        assert (tmp_path / "named" / name).read_text() == expected
    assert pipeline_queries._chunks(lines, "name").count() < 300


def test_a_published_file_is_made_by_many_tasks(spark, tmp_path):
    path = tmp_path / "one.parquet"
    described.write_described(spark.range(0, 400, 1, 4).withColumn("task", F.spark_partition_id()), str(path), one_file=True)
    assert path.is_file()
    assert sorted(tuple(r) for r in spark.read.parquet(str(path)).groupBy("task").count().collect()) == [(k, 100) for k in range(4)]


def test_entities_alone_go_to_python(spark, capsys):
    values = ["x" * 50 + "&amp;" + "&notit; &#x41;&#65 & &&lt", "&", "", "a\U0001f600&unknown;\U0001f600&copy", "&" + "y" * 40, "no entity"]
    df = spark.createDataFrame([(v,) for v in values], "t string").select(text.clean_text(F.col("t")).alias("c"))
    import html

    assert [r["c"] for r in df.collect()] == [html.unescape(v).strip() for v in values]
    df.explain()
    assert "_unescape(regexp_extract_all" in capsys.readouterr().out


def test_a_row_finds_its_dataset_without_patterns(spark, tmp_path):
    assert "regexp" not in str(panel._dataset_of_row())
    paths = []
    for name in ("a b+c%41.parquet", "2020Q1.parquet", "é.parquet"):
        spark.range(3).repartition(2).write.parquet(str(tmp_path / name))
        paths.append(f"file:{tmp_path / name}")
    rows = spark.read.parquet(str(tmp_path / "*.parquet")).withColumn("d", panel._dataset_of_row())
    found = rows.groupBy("d").count().select(panel._plain(F.col("d")), "count").collect()
    assert sorted(tuple(r) for r in found) == sorted((p, 3) for p in paths)
    single = next((tmp_path / "2020Q1.parquet").glob("part-*.parquet")).rename(tmp_path / "single.parquet")
    found = spark.read.parquet(str(single)).select(panel._plain(panel._dataset_of_row())).distinct().collect()
    assert [r[0] for r in found] == [f"file:{single}"]


@pytest.mark.parametrize("content", [b"", b"abc", b"x" * 1000])
def test_a_held_file_reads_like_bytes(content):
    held, plain = files.open_file(pa.py_buffer(content)), io.BytesIO(content)
    assert isinstance(held, files._Held)
    for step in (("read", 2), ("seek", -22, 2), ("read", 5), ("seek", 1), ("tell",), ("read",), ("seek", 5000), ("read", 1), ("seek", -1, 1), ("tell",)):
        assert getattr(held, step[0])(*step[1:]) == getattr(plain, step[0])(*step[1:])


def test_archives_beyond_the_inline_size_go_in_blocks(spark, tmp_path):
    assert delimited.INLINE_BYTES < files.MOST_BYTES
    with zipfile.ZipFile(tmp_path / "Bulk 12312020.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a.txt", "IDRSSD\tRCON1\n1\t2\n3\t4\n")
    found = [
        sorted(tuple(r) for r in delimited.read_delimited(spark, str(tmp_path), most_bytes=most).select("row_no", "filer_id", "error").collect())
        for most in (1, delimited.INLINE_BYTES)
    ]
    assert found[0] == found[1] and [r[1] for r in found[0] if r[0] != -1] == [1, 3]


@pytest.fixture
def long_file(spark, tmp_path):
    """A loose file beyond ``LOOSE_BYTES``, in a session whose reader refuses to hold more than that of a file."""
    name, most = tmp_path / "in" / "a 12312020.txt", "spark.sql.sources.binaryFile.maxLength"
    name.parent.mkdir()
    with name.open("w") as file:
        file.write("IDRSSD\tRCON1\tRCON2\n" + "".join(f"{i}\t{i * 2}\t{'x' * 1000}\n" for i in range(17_000)))
    assert name.stat().st_size > 16 << 20
    spark.conf.set(most, str(16 << 20))
    yield name
    spark.conf.unset(most)


def test_no_task_holds_a_long_loose_file(spark, long_file):
    found = delimited.read_delimited(spark, str(long_file.parent)).where("row_no >= 0").groupBy("error").agg(F.count("filer_id"), F.sum("filer_id"), F.sum(F.size("cells")))
    assert [tuple(r) for r in found.collect()] == [(None, 17_000, sum(range(17_000)), 34_000)]


def test_blocks_end_with_the_line_that_fills_them(spark, tmp_path):
    data = "".join("y" * (k % 50) + "\n" for k in range(30_000))
    (tmp_path / "a b.txt").write_text(data + "end")
    (tmp_path / "c.txt").write_text("\n")
    listed = files.list_files(spark, str(tmp_path))
    found = blocks.line_blocks(listed, 1000).orderBy("path", "split", "place").collect()
    assert b"".join(r["data"] for r in found).decode() == data + "end\n\n"
    assert all(1000 <= len(r["data"]) <= 1050 for r in found[:-2])
    assert [r["place"] for r in found] == [*range(1, len(found)), 1]


def test_a_slice_becomes_values_some_rows_at_a_time(monkeypatch):
    body = b"".join(b"%d\t%d\tx\n" % (i, i) if i % 3 else b"none\t1\tx\n" for i in range(3000))
    piece = slices.slice_batch(path="p", source_name="s", member_ordinal=0, slice_no=1, first_row=5, encoding="utf-8", head=b"IDRSSD\tA\tB\n", body=body).to_pylist()[0] | {"period": None}
    whole = [r for batch in delimited._parse_slice(piece) for r in batch.to_pylist()]
    monkeypatch.setattr(cells, "BATCH_CELLS", 300)
    batches = list(delimited._parse_slice(piece))
    assert [r for batch in batches for r in batch.to_pylist()] == whole and len(whole) == 2000
    assert [r["row_no"] for r in whole] == list(range(5, 2005))
    assert max(batch.num_rows for batch in batches) == 100


def test_a_stream_does_not_hold_long_loose_files(spark, long_file, tmp_path):
    (long_file.parent / "b 12312020.txt").write_text("IDRSSD\tRCON1\n1\t2\n")
    (long_file.parent / "[c]{d}* 12312021.txt").write_text("IDRSSD\tRCON1\n3\t4\n")
    (long_file.parent / "notes.txt").write_text("IDRSSD\n")
    out = str(tmp_path / "out")
    incremental.ingest_new_bulk(spark, str(long_file.parent), out, str(tmp_path / "checkpoint")).awaitTermination()
    counts = panel.read_panel(spark, out).facts.groupBy("quarter", "variable").agg(F.count("*"), F.sum("num_value"))
    assert sorted(tuple(r) for r in counts.collect()) == [("2020Q4", "RCON1", 17_000, 2.0 * sum(range(17_000))), ("2020Q4", "RCON2", 17_000, None), ("2021Q4", "RCON1", 1, 4.0)]
    states = panel.read_inputs(spark, out).select(F.regexp_extract("path", "[^/]*$", 0), "state").collect()
    assert sorted(tuple(r) for r in states) == [("[c]{d}* 12312021.txt", "processed"), ("a 12312020.txt", "processed"), ("b 12312020.txt", "duplicate"), ("notes.txt", "undated")]


def test_a_stream_of_undated_files_alone(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "notes.txt").write_text("IDRSSD\n")
    incremental.ingest_new_bulk(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert [r["state"] for r in panel.read_inputs(spark, str(tmp_path / "out")).collect()] == ["undated"]
