"""Every query and stage on small tables: against SQL, and on tables that are empty, odd or have clashing columns."""

import hashlib

import __spark_entry__ as contract
import brute
import corpus_pipeline
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from filingpanel.llm import jaccard_join, queries, raking, secret_scan
from filingpanel.session import staged

SF_DIR = "/root/testdata/sf0.001"
OPERATORS = sorted(queries.QUERIES)
CLASHING = "k sub key node label salt place score row mix topic tokens weight probability kept part tail n rank secret_spans severity".split()


def save(folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(str(folder / f"{name}.parquet"))
    return str(folder)


def odd_tables(spark, folder, empty=False):
    text = " ".join(f"word{i} is here" for i in range(60))
    docs = [
        (1, text, "en", "s1", 5), (1, text, "en", "s1", 5), (2, text + " end", None, "s1", None), (3, None, "en", None, 0), (None, text, "fr", "s2", 1),
        (None, None, None, None, None), (4, "", "fr", "s2", 0), (5, " \n\t ", "fr", "s1", 3), (6, "x" * 200_000, "en", "s1", 200_000),
        (7, "password = abcdefghijkl0123 idiot " + text, "en", "s3", 1), (8, "🙂" * 300, "de", "s1", 300), (9, "Un deux trois. " * 20_000, "fr", "s1", 1),
    ]
    labels = [(1, 1, 0), (7, 0, 1), (7, 0, 0), (2, None, None), (None, 1, 1), (999, 0, 1), (4, 1, 0)]
    vectors = [(0, [0.5, -0.25], 1), (0, [0.5, -0.25], 1), (50, [0.0, 0.0], 0), (51, None, 0), (52, [None, 1.0], 0), (100, [float("inf"), 0.0], 0), (150, [], 0), (None, [1.0, 1.0], 1)]
    keep = 0 if empty else None
    tables = {
        "documents": spark.createDataFrame(docs[:keep] if empty else docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": spark.createDataFrame(labels[:keep] if empty else labels, "doc_id long, quality int, toxic int"),
        "embeddings": spark.createDataFrame(vectors[:keep] if empty else vectors, "vec_id long, embedding array<float>, label int"),
    }
    clashing = {c: F.lit("extra") for c in CLASHING}
    return save(folder, **{name: df.withColumns({c: v for c, v in clashing.items() if c not in df.columns}) for name, df in tables.items()})


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return odd_tables(spark, tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    return odd_tables(spark, tmp_path_factory.mktemp("none"), empty=True)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE_SQL[name]) == []


def test_queries_are_registered():
    assert {n.split("_")[0] for n in OPERATORS} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in OPERATORS if n.split("_")[0] not in ("op1", "op11", "op12", "op13")])
def test_one_row_for_each_document(spark, odd, name):
    rows = queries.QUERIES[name](spark, odd).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in rows) == sorted(
        (i is not None, i or 0) for i in (1, 1, 2, 3, None, None, 4, 5, 6, 7, 8, 9)
    )


def test_search_on_odd_vectors(spark, odd):
    rows = sorted(tuple(r) for r in queries.QUERIES["op1_norm_search"](spark, odd).collect())
    assert [r for r in rows if r[0] == 50] == [(50, 1, 0, 0), (50, 2, 0, 0)]
    assert {r[0] for r in rows} <= {0, 50}


COLUMNS = {
    "op1": "query_id rank vec_id score",
    "op2": "doc_id held_out lang_pred score",
    "op3": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op4": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op7": "doc_id n_shingles component_id",
    "op8": "doc_id n_bytes n_tokens over_limit",
    "op9": "doc_id source lang topic tokens probability kept",
    "op10": "doc_id severity p_toxic grade toxic",
    "op11": "vec_id component n deviation whitened explained identity_error exact_deviation",
    "op12": "lang rank phrase a l r n score",
    "op13": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, none, name):
    df = queries.QUERIES[name](spark, none)
    assert df.columns == COLUMNS[name.split("_")[0]].split()
    assert df.count() == 0


def test_pipeline_on_odd_and_empty_tables(spark, odd, none):
    assert corpus_pipeline.run(spark, none).count() == 0
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, odd)
        assert docs.columns == columns, name
    assert corpus_pipeline.run(spark, odd).columns == ["doc_id", "n_tokens", "ids", "decoded"]


def test_odd_rows_survive_each_stage(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, odd), name)
        left[name] = sorted((r["doc_id"] or 0, r["text"] or "") for r in docs.collect())
    assert [i for i, _ in left["toxicity"]] == [0, 0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert [i for i, _ in left["ngram_jaccard_join"]] == [i for i, _ in left["secret_scans"]] == [0, 0, 1, 3, 4, 5, 6, 8, 9]
    assert {r for r in left["secret_scans"] if not r[1].strip()} <= set(left["source_mixing"]) <= set(left["secret_scans"])


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}

    calm = stages["toxicity"](spark, docs, SF_DIR).cache()
    left = {r["doc_id"] for r in calm.collect()}
    gone = {r["doc_id"] for r in docs.collect()} - left
    toxic, clean = ({i for i, t in labels.items() if t == kind} for kind in (1, 0))
    assert len(toxic & gone) >= 0.8 * len(toxic) and len(clean & left) >= 0.98 * len(clean)

    single = stages["ngram_jaccard_join"](spark, calm, SF_DIR).cache()
    rule = jaccard_join.Rule()
    groups = brute.components([(r["doc_id"], r["text"]) for r in calm.collect()], rule.words, rule.num, rule.den)
    assert {r["doc_id"] for r in single.collect()} == {c for _, _, c in groups}

    safe = stages["secret_scans"](spark, single, SF_DIR).cache()
    args = secret_scan.CANDIDATE, secret_scan.ALLOWED, secret_scan.THRESHOLDS, secret_scan.OTHER_THRESHOLD
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in safe.collect():
        assert r["text"] == brute.redacted(texts[r["doc_id"]], brute.secrets(texts[r["doc_id"]], *args), secret_scan.REDACTED)
        assert r["n_chars"] == len(r["text"]) or r["text"] == texts[r["doc_id"]]

    mixed = stages["source_mixing"](spark, safe, SF_DIR).cache()
    drawn = {r[0] for r in raking.calibrated(safe).where("mix.kept").select("row.doc_id").collect()}
    assert {r["doc_id"] for r in mixed.collect()} == drawn

    encoded = stages["bpe_encoding"](spark, mixed, SF_DIR).collect()
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    for r in encoded:
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and hashlib.sha256(r["ids"]).digest() == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).digest()
        assert r["decoded"] == texts[r["doc_id"]]
    assert len(encoded) == len(texts)
