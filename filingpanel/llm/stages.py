"""The stages of the corpus pipeline: documents in, documents out; the last one gives token identifiers.

Each takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``, whatever further columns they have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingpanel.llm import jaccard_join, ordinal_toxicity, raking, secret_scan, transducer
from filingpanel.llm.common import table
from filingpanel.llm.queries import tokenizer_path
from filingpanel.llm.tokenizer_file import read_file
from filingpanel.session import staged

#: Word n-grams and similarity of near duplicates.
NEAR = jaccard_join.Rule(words=5, num=80, den=100)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the model, learnt from the labels, finds toxic. Null and empty texts stay."""
    model = ordinal_toxicity.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return ordinal_toxicity.reject_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id, and of its rows the first text.

    Documents without words are no duplicates of each other, and rows with a null id stay.
    """
    found = jaccard_join.linked_documents(docs, NEAR)
    copies = staged(found.where("component_id <> doc_id").select("doc_id").distinct(), "copies")
    few = copies.count() <= jaccard_join.BROADCAST_IDS
    left = docs.join(F.broadcast(copies) if few else copies, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    repeated = staged(docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not repeated.limit(1).count():
        return left
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    place = F.row_number().over(Window.partitionBy("row.doc_id").orderBy("row.text"))
    first = left.select(row).withColumn("place", place).where("place = 1 OR row.doc_id IS NULL")
    return first.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark; ``n_chars`` follows where there were any."""
    found = secret_scan.scan(docs.drop("secret_spans"))
    hit = F.size("secret_spans") > 0
    new = {c: F.col(f"`{c}`") for c in docs.columns}
    new["text"] = F.when(hit, secret_scan.redacted("text", "secret_spans")).otherwise(F.col("text"))
    if "n_chars" in new:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(hit, F.length(new["text"]).cast(kind)).otherwise(F.col("n_chars"))
    return found.select(*[column.alias(name) for name, column in new.items()])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics come near their target shares of the tokens."""
    return raking.sampled(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` and the ``decoded`` text of every document."""
    rows = transducer.encode(docs, read_file(tokenizer_path("byte_bpe_50k.json")), decoded=True)
    return rows.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids", "decoded")
