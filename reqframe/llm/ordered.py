"""Running sums over ordered groups of any size: a group may span many partitions."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqframe.llm.common import saved


def _local(key: str, sums: list[str]):
    """Sums from the start of the group or of the partition, whichever is later. Integers wrap."""

    def run(batches):
        at, carry = None, [np.uint64(0)] * len(sums)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            start = np.flatnonzero(np.diff(keys, prepend=keys[0]) != 0)
            start = np.concatenate([[0], start])
            size = np.diff(np.append(start, len(keys)))
            out = []
            for i, name in enumerate(sums):
                total = np.cumsum(batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                before = np.concatenate([np.zeros(1, np.uint64), total[start[1:] - 1]])
                total -= np.repeat(before, size)
                if keys[0] == at:
                    total[: size[0]] += carry[i]
                carry[i] = total[-1]
                out.append(pa.array(total.view(np.int64)))
            at = keys[-1]
            names = batch.schema.names
            columns = [out[sums.index(n)] if n in sums else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _carried(key: str, sums: list[str], carries):
    def run(batches):
        table = carries.value
        spans = np.array(sorted({k for _, k in table}), np.int64)
        for batch in batches:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            names = [n for n in batch.schema.names if n != "part"]
            columns = {n: batch.column(n) for n in names}
            if len(rows := np.flatnonzero(np.isin(keys, spans))):
                parts = batch.column("part").to_numpy(zero_copy_only=False)
                added = np.array([table.get((int(parts[i]), int(keys[i])), (0,) * len(sums)) for i in rows], np.uint64).reshape(-1, len(sums))
                for i, n in enumerate(sums):
                    total = columns[n].to_numpy(zero_copy_only=False).view(np.uint64).copy()
                    total[rows] += added[:, i]
                    columns[n] = pa.array(total.view(np.int64))
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return run


def running(frame: DataFrame, key: str, order: list[Column], sums: list[str], tag: str) -> DataFrame:
    """``frame`` with each column of ``sums`` (BIGINT) replaced by its running sum within ``key``, in ``order``.

    Rows are dealt by ranges of key and order, so a large group is spread; what earlier partitions hold of a
    group is added afterwards. At most two totals a partition boundary reach the driver. Sums wrap at 64 bits.
    """
    spark = frame.sparkSession
    columns = frame.columns
    ranged = frame.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col(key), *order)
    ranged = ranged.sortWithinPartitions(F.col(key), *order).select(*columns, F.spark_partition_id().cast("long").alias("part"))
    local = saved(ranged.mapInArrow(_local(key, sums), ranged.schema), tag)
    many = local.groupBy(key).agg(F.min("part").alias("one"), F.max("part").alias("two")).where("one < two").select(key)
    # a group's last row of a partition has the largest count, so that its sums are the partition's
    local_rows = local.join(F.broadcast(many), key)  # one group a partition boundary at most
    ends = local_rows.groupBy("part", key).agg(F.max("row").alias("row"), *(F.max_by(F.col(n), F.col("row")).alias(n) for n in sums if n != "row"))
    carries, before = {}, defaultdict(lambda: [0] * len(sums))
    for r in sorted(ends.collect(), key=lambda r: r["part"]):
        held = before[r[key]]
        carries[r["part"], r[key]] = tuple(held)
        before[r[key]] = [(x + r[n]) % 2**64 for x, n in zip(held, sums, strict=True)]
    out = T.StructType([local.schema[n] for n in columns])
    return local.mapInArrow(_carried(key, sums, spark.sparkContext.broadcast(carries)), out)
