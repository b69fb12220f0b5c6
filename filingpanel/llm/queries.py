"""One query for each operator over the test tables, with production parameters; and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.llm import collocations, jaccard_join, language_id, norm_search, ordinal_toxicity, packing, quartile_digest, raking, secret_scan, suffix_dedup, token_counts, transducer, whitening
from filingpanel.llm.common import table
from filingpanel.llm.tokenizer_file import read_file

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizer files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


@registered(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT q.vec_id AS query_id, p.vec_id, list_inner_product(q.e, p.e)::BIGINT AS score
        FROM v q JOIN v p ON q.vec_id <> p.vec_id AND len(q.e) = len(p.e) WHERE q.vec_id % 50 = 0),
      r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS "rank", vec_id, score FROM s)
    SELECT * FROM r WHERE "rank" <= 5"""
)
def op1_norm_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(norm_search.usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    vectors = rows.select("vec_id", whole.alias("vector"))
    return norm_search.top_products(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@registered()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    profiles = language_id.learn_profiles(docs.where(~held_out).select("text", "lang"))
    found = language_id.predict_languages(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@registered()
def op3_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = transducer.encode(docs, read_file(tokenizer_path("word_bpe_49k.json")), decoded=True)
    return rows.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@registered()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@registered()
def op5_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.compare_with_next(table(spark, sf_dir, "documents"))


@registered()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secret_scan.written("secret_spans", 3).cast("binary"), 256).alias("base_sha256"),
        secret_scan.written("secret_spans").alias("spans"),
    )


@registered()
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_documents(table(spark, sf_dir, "documents"), jaccard_join.Rule(words=3, num=90, den=100))


@registered()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, read_file(tokenizer_path("byte_bpe_50k.json")))


@registered()
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return raking.calibrated(docs).select("row.doc_id", "row.source", "row.lang", "mix.*")


@registered()
def op10_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal_toxicity.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return ordinal_toxicity.grade_documents(docs, model)


@registered()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), "embedding", most=4)
    exact = F.col("deviation")
    fits = exact.between(F.lit(0), F.lit(whitening.LONG_MAX))
    return found.withColumns({"deviation": F.when(fits, exact.cast("long")), "exact_deviation": exact})


@registered(
    r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
      w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
      g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM w, (SELECT unnest([1, 2, 3]) AS k) AS ks),
      f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
      t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
      big AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM f WHERE f >= 10),
      parts AS (SELECT b.lang, b.phrase, b.f AS a, c.c, array_to_string(ws[1:c.c], ' ') AS p, array_to_string(ws[c.c + 1:k], ' ') AS q FROM big b, (SELECT unnest([1, 2]) AS c) c WHERE c.c < k),
      cuts AS (SELECT s.lang, s.phrase, a, c, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM parts s JOIN big x ON x.lang = s.lang AND x.phrase = s.p JOIN big y ON y.lang = s.lang AND y.phrase = s.q),
      best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
      around AS (SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, f FROM big WHERE k = 3),
      widest AS (SELECT lang, phrase, max(f) AS f FROM around GROUP BY lang, phrase),
      kept AS (SELECT b.* FROM best b LEFT JOIN widest x ON x.lang = b.lang AND x.phrase = b.phrase WHERE x.f IS NULL OR 100 * x.f < 50 * b.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank", phrase, a, l, r, n, score
    FROM kept JOIN t USING (lang) QUALIFY "rank" <= 2000"""
)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"), least=10, longest=3, keep=2000)


@registered()
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(table(spark, sf_dir, "documents"), read_file(tokenizer_path("byte_bpe_50k.json")), window=2048)
    # The identifiers themselves need no shuffle here; packing.packed carries them along.
    parts = parts.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.placed(parts, window=2048)
