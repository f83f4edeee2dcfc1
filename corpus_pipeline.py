"""A training corpus from ``documents``: language, copies, test items, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``.

Defined cases: a document without a letter has no language and goes; NULL texts go in the
first stage. Stages decide by row, not by id: one row of each group of near duplicates stays,
whether its id is NULL or is used again by a different text, and only the rows whose text
holds a test item go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.llm.common import crc_mod, stored
from linkmart.llm.decontam import contaminated
from linkmart.llm.langid import UNDETERMINED, label_documents
from linkmart.llm.packing import pack_documents
from linkmart.llm.pii import pseudonymise
from linkmart.llm.queries import PSEUDONYM_KEY, tokenizer_path
from linkmart.llm.simhash import simhash_components
from linkmart.session import scratch_dir

#: The largest share of a text's words that one language must have.
MIN_SHARE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which no language is found or none has ``MIN_SHARE`` of the words."""
    found = label_documents(spark, docs, crc_mod("id", 4) == 2, keep=True)
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_SHARE)).select("doc.*")


ROW = "__pipeline_row"


def with_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a name for each row: its text's digest and its id. Rows that share it are equal
    in both; ids may be NULL or used again for another text."""
    text, doc = F.coalesce(F.md5("text"), F.lit("-" * 32)), F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    return docs.withColumn(ROW, F.concat(text, doc))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group: that of the smallest id (a NULL id only where all are), then of
    the smallest text digest."""
    named = with_row(docs)
    groups = stored(spark, simhash_components(spark, named, id_col=ROW).select("id", "component"), "pipeline-groups")
    doc = F.when(F.length("id") > 32, F.substring("id", 34, 1 << 30)).cast(docs.schema["doc_id"].dataType)
    first = groups.groupBy("component").agg(F.min(F.struct(doc.isNull(), doc.alias("doc"), F.col("id"))).alias("x")).select(F.col("x.id").alias(ROW))
    kept = named.join(first, ROW, "left_semi")
    if not groups.groupBy("id").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([ROW])
    return kept.select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows whose text holds an item of ``benchmark``, copied or edited."""
    named = with_row(docs)
    found = contaminated(spark, named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=ROW)
    return named.join(found.select(F.col("id").alias(ROW)).distinct(), ROW, "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms; ``n_chars`` follows the text."""
    return pseudonymise(docs, PSEUDONYM_KEY).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return pack_documents(docs, tokenizer_path()).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: No SQL expresses the models, the alignment or the tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
