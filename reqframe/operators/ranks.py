"""Sets ordered once, so that any page of them is read by its place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A row's number in its task is below this bit of monotonically_increasing_id.
_ROW = (1 << 33) - 1


class Ranked:
    """A set written in ranges of its order, with the counts of each range, all and by class.

    Rows of a range lie in one folder, so a page reads only the ranges it touches, however deep it is. The
    counts are one row a range and the only thing the driver sees. Rows that are equal in the order must be
    told apart by it, or their order is any.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema = spark.read.parquet(f"{path}/columns").schema
        counts = spark.read.parquet(f"{path}/counts").orderBy("_range")
        rows = counts.collect()
        self.ranges = [r["_range"] for r in rows]
        self.sizes = {c: [r[c] for r in rows] for c in counts.columns if c != "_range"}
        self.columns = [c for c in self.rows().columns if not c.startswith("_")]

    @staticmethod
    def write(
        df: DataFrame, order: Sequence[Column | str], path: str, classes: dict[str, Column] | None = None, ranges: int | None = None
    ) -> Ranked:
        """Order ``df`` below ``path``, a new folder. ``classes`` are conditions by which pages may be asked for."""
        spark = df.sparkSession
        n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        marked = df.withColumns({f"_is_{name}": F.coalesce(c, F.lit(False)) for name, c in (classes or {}).items()})
        ranged = marked.repartitionByRange(n, *order).sortWithinPartitions(*order)
        placed = ranged.withColumn("_range", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)))
        placed.write.partitionBy("_range").parquet(f"{path}/rows")
        # an empty set leaves no file to take the columns from
        placed.limit(0).write.parquet(f"{path}/columns")
        back = spark.read.schema(placed.schema).parquet(f"{path}/rows")
        counted = back.groupBy("_range").agg(F.count("*").alias("_all"), *(F.count_if(f"_is_{name}").alias(name) for name in classes or {}))
        counted.write.parquet(f"{path}/counts")
        return Ranked(spark, path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def total(self, of: str | None = None) -> int:
        return sum(self.sizes[of or "_all"])

    def _starts(self, of: str) -> dict[int, int]:
        starts, at = {}, 0
        for k, size in zip(self.ranges, self.sizes[of], strict=False):
            starts[k] = at
            at += size
        return starts

    def page(self, skip: int, limit: int, of: str | None = None) -> DataFrame:
        """Rows ``skip`` to ``skip + limit`` of all rows or of a class, with ``position`` (from 0) in the order."""
        name = of or "_all"
        starts = self._starts(name)
        sizes = dict(zip(self.ranges, self.sizes[name], strict=False))
        touched = {k: at for k, at in starts.items() if sizes[k] and at < skip + limit and at + sizes[k] > skip}
        inside = self.rows().where(F.col("_range").isin(list(touched)))
        if of is not None:
            # only ranges that hold a row of the page are ranked, each for itself
            rank = F.row_number().over(Window.partitionBy("_range").orderBy("_row")) - 1
            inside = inside.where(f"_is_{of}").withColumn("_row", rank.cast("bigint"))
        position = self._start(touched) + F.col("_row")
        return inside.withColumn("position", position).where((position >= skip) & (position < skip + limit)).select(*self.columns, "position")

    def listing(self) -> DataFrame:
        """All rows with their ``position``; no further sort."""
        return self.rows().withColumn("position", self._start(self._starts("_all")) + F.col("_row")).select(*self.columns, "position")

    def _start(self, starts: dict[int, int]) -> Column:
        if not starts:
            return F.lit(0).cast("bigint")
        pairs = [x for k, at in starts.items() for x in (F.lit(k), F.lit(at).cast("bigint"))]
        return F.element_at(F.create_map(*pairs), F.col("_range"))
