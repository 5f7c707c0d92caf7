"""Documents to token ids: language, near duplicates, benchmark passages, secrets, encoding.

Each stage takes what the one before kept, written as Parquet in the shared work folder and read
again. All stages but the last return the columns of the documents they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from macroloom.llm import bpe, decontaminate, langid, neardup, secrets
from macroloom.llm.common import cannot_be_in, may_be_in, stored, table
from macroloom.llm.queries import BYTE_BPE, MULTI_BPE

#: A document stays if one language is likelier than all others together.
LEAST_SCORE = 0.5


def packed(docs: DataFrame) -> DataFrame:
    """Id and text, and beside them all but the text in one column, so that no result can have the name of another column."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from packed rows."""
    return rows.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language. Null, empty and letterless texts go."""
    model = langid.train(docs, MULTI_BPE)
    judged = langid.identify(packed(docs), model, keep=["text", "row"])
    return unpacked(judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near duplicates.

    Of rows that share an id, or have none, those of equal text are copies too, and one stays. Rows
    without an id are otherwise classes of their own.
    """
    gone = stored(neardup.near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct(), "pipeline-gone")
    rows = packed(docs)
    kept = cannot_be_in(rows, "doc_id", gone).union(may_be_in(rows, "doc_id", gone).join(gone, "doc_id", "left_anti"))
    shared = stored(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("shared")), "pipeline-shared")
    same = F.col("doc_id").eqNullSafe(F.col("shared"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy(F.xxhash64("row")))
    again = kept.join(shared, same, "left_semi").select("text", "row", nth.alias("nth")).where("nth = 1")
    return unpacked(kept.join(shared, same, "left_anti"), docs).union(unpacked(again, docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    found = decontaminate.find_passages(packed(docs), table(spark, sf_dir, "benchmark"), keep=["text", "row"])
    return unpacked(found.where("n_hit = 0"), docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; ``n_chars`` of changed texts follows."""
    words = secrets.dictionary(spark, MULTI_BPE)
    model = secrets.train(secrets.labelled_findings(spark), words)
    return secrets.mask_secrets(docs, secrets.find_secrets(docs, words, model), length_column="n_chars")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): token ids as little-endian unsigned 32-bit integers, and what they decode to."""
    out = bpe.encode_documents(docs, BYTE_BPE)
    return out.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("masked", masked),
    ("encoded", encoded),
]

#: The stages cannot be written as SQL; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
