"""A training corpus from documents: toxicity, near duplicates, benchmark passages, secrets, packing.

Each stage works on everything its predecessor kept and reads that back from Parquet. All but the last
return the columns of documents; the last says where each document is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqframe.llm import decontaminate, near_dedup, packing, secrets, toxicity
from reqframe.llm.common import saved, table


#: Bytes of rows that a Python worker gets at once; with whole texts, Spark's 10,000 rows (64 MB) are held several times over in each task.
BATCH = "4m"


def _bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score stays under the threshold.

    Null and empty texts are scored like a sentence without words, repeated rows alike, whatever their id. Without usable
    labels nothing goes. An empty table gives no rows; other columns stay.
    """
    _bound_batches(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def _keyed(docs: DataFrame) -> tuple[DataFrame, str, DataFrame]:
    """Rows under a unique key, written once so that the key is stable; its name, which no column has; and their texts with it as doc_id."""
    key = "_row_key"
    while key in docs.columns:
        key += "_"
    rows = saved(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    return rows, key, rows.select(F.col(key).alias("doc_id"), "text")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the smallest doc_id, a row without one last.

    Repeated rows are copies like any other, ties go to the row that comes first. Null and empty texts, and others
    without words, belong to no group and are kept. An empty table gives no rows; other columns stay, whatever their names.
    """
    _bound_batches(spark)
    rows, key, texts = _keyed(docs)
    groups = near_dedup.near_groups(texts).select(F.col("doc_id").alias(key), "component_id")
    ids = rows.select(key, F.col("doc_id").cast("long").alias("doc_id"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", key)
    first = ids.join(groups, key).groupBy("component_id").agg(F.min(place).alias("first"))
    return rows.join(first.select(F.col("first").getField(key).alias(key)), key, "left_semi").drop(key).select(docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item.

    Each row is judged by its own text, repeated rows alike; null and empty texts hold nothing and stay. An empty table, or an
    empty benchmark, changes nothing; other columns stay, whatever their names.
    """
    _bound_batches(spark)
    rows, key, texts = _keyed(docs)
    bad = decontaminate.contaminated(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(key)).distinct()
    return rows.join(bad, key, "left_anti").drop(key).select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by the name of its rule.

    Null and empty texts stay as they are, and so do rows without an id and repeated ones; of overlapping secrets the leftmost
    is replaced. An empty table gives no rows; other columns stay, but for ``n_chars``, which follows the text.
    """
    _bound_batches(spark)
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, lane and batch of every document, null and empty texts as length 0.

    Rows without an id and repeated ones are packed like others. An empty table gives no rows; other columns are left out.
    """
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark_passages),
    ("secret scans", redact_secrets),
    ("packing", pack),
]

#: Learned scores, hash sketches and dynamic programming are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
