"""Helpers shared by the training-data operators: tables, scratch tables, link components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqframe.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(frame: DataFrame, tag: str) -> DataFrame:
    """``frame`` written once below the cluster's shared folder and read back.

    This cuts the lineage with a copy that survives the loss of any executor. The folders are
    ``<spark.checkpoint.dir>/reqframe-llm/<application>/<tag>-<random>``; they belong to the
    application and can be removed when it has ended.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/reqframe-llm/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    back = spark.read.schema(frame.schema).parquet(path)
    back.saved_at = path
    return back


def forget(frame: DataFrame) -> None:
    """Delete a table that ``saved`` wrote, once nothing reads it any more."""
    spark = frame.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(frame.saved_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def share(column: str, parts: int):
    """``crc32(id as text) mod parts``: the fold of a row."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected links ``(a, b)``: columns ``node``, ``component``.

    Alternates large-star and small-star steps (Kiveris et al. 2014), each of them an aggregate and
    a join on a node, until the links are stars around the smallest node of each component. A hub is
    never gathered: its links are joined with its minimum, so adaptive execution can split them.
    The result has every node that has a link to another node.
    """
    edges = saved(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = (
            both.join(lowest, F.col("a") == F.col("n"))
            .where("b > a and b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower.select(F.col("a").alias("n"), "m"), F.col("a") == F.col("n"))
        stars = saved(
            small.where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lower.select("a", F.col("m").alias("b")))
            .distinct(),
            "links",
        )
        forget(edges)
        edges = stars
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now


#: Bytes of text that each class may add to a training sample.
SAMPLE_BYTES = 24 << 20


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, usable, rows: int, most: int = SAMPLE_BYTES) -> DataFrame:
    """A bounded training sample ``text, label, weight``, one row an id.

    Of the labelled ids that ``usable`` lets through, each class gives up to ``rows``, those of the smallest hash, as long as
    their texts hold no more than ``most`` bytes together; ``weight`` restores the classes' shares. Ids are chosen from ids
    and lengths alone, and texts are read for the chosen ids. Null labels, texts and ids are left out; the
    largest label counts if an id has several, and the text of the smallest hash.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").where(usable).groupBy("doc_id").agg(F.max("label").alias("label"))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    picks = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    ids = F.broadcast(picks[0].unionByName(picks[1]))  # 2 * rows ids at most
    # equal ids are one row before anything is sent: places and lengths first
    place = docs.join(ids, "doc_id").select("doc_id", "label", F.xxhash64("text").alias("h"), F.octet_length("text").cast("long").alias("size"))
    one = place.groupBy("doc_id", "label").agg(F.min("h").alias("h"), F.min_by("size", "h").alias("size")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    held, chosen = {0: 0, 1: 0}, []
    for r in one:
        held[r["label"]] += r["size"]
        if held[r["label"]] <= most:
            chosen.append((r["doc_id"], r["h"], r["label"], max(1.0, counts.get(r["label"], 0) / rows)))
    spark = documents.sparkSession
    chosen = F.broadcast(spark.createDataFrame(chosen, "doc_id long, h long, label int, weight double"))
    found = docs.withColumn("h", F.xxhash64("text")).join(chosen, ["doc_id", "h"])
    return found.groupBy("doc_id", "label", "weight").agg(F.min("text").alias("text")).orderBy("doc_id").select("text", "label", "weight")
