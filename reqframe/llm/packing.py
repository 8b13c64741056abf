"""Packing: length buckets that minimise padding, and token-budget batches inside each of them.

Lengths are bytes of UTF-8, the tokens of a byte-level model, or any length expression given. The
global histogram of lengths goes through a dynamic programme that chooses at most ``BUCKETS`` upper
bounds with the least total padding when every row is padded to its bucket's bound. Lengths count
exactly up to 2,048 and in steps of at most 1/1024 of themselves above, so the histogram has a bounded
number of cells whatever the texts are; a cell's bound is the longest length found in it.

A batch of a bucket takes ``budget // bound`` rows (one, if a row alone exceeds the budget). A
bucket's rows are dealt in turn, by their numbers within the input's tasks, into lanes whose number follows from the
bucket's count, and batches form within lanes, so no bucket is ever gathered, whatever its rows are; each
lane leaves one batch short at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 12
BUDGET = 65_536
LANE_ROWS = 4_096


def cell(length: Column) -> Column:
    """The histogram cell of a length: all of it up to 2,048, else its leading 11 binary digits."""
    digits = F.length(F.bin(length))
    return length - F.pmod(length, F.pow(F.lit(2.0), F.greatest(digits - 11, F.lit(0))).cast("long"))


def boundaries(lengths: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding (divide and conquer).

    ``lengths``: ascending longest length of each cell; ``sums``: total length of its rows. The cost of
    a bucket over cells ``i..j`` is ``lengths[j] * rows - total length``. The best split point does not
    move left as the end moves right, so each layer takes O(cells log cells).
    """
    n = len(lengths)
    if not n:
        return []
    rows, total = np.concatenate([[0], np.cumsum(counts)]).astype(float), np.concatenate([[0], np.cumsum(sums)]).astype(float)
    best = lengths * rows[1:] - total[1:]  # one bucket over cells 0..j
    back = [np.zeros(n, np.int64)]
    for _ in range(1, min(buckets, n)):
        now, split = np.empty(n), np.zeros(n, np.int64)
        previous = np.concatenate([[0.0], best])  # previous[i]: cells before i
        work = [(0, n - 1, 0, n - 1)]
        while work:
            lo, hi, a, b = work.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(a, min(b, mid) + 1)
            cost = previous[i] + lengths[mid] * (rows[mid + 1] - rows[i]) - (total[mid + 1] - total[i])
            k = int(cost.argmin())
            now[mid], split[mid] = cost[k], i[k]
            work += [(lo, mid - 1, a, int(i[k])), (mid + 1, hi, int(i[k]), b)]
        if now[-1] >= best[-1]:
            break
        best, back = now, [*back, split]
    out, end = [], n - 1
    for split in reversed(back):
        if end < 0:
            break
        out.append(int(lengths[end]))
        end = int(split[end]) - 1
    return out[::-1]


def packed(documents: DataFrame, length: Column | None = None, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """``doc_id, length, bucket, bound, lane, batch, padding``, a row per row of ``documents``.

    ``bound`` is the bucket's padded length, ``padding`` what the row wastes of it, and ``(bucket, lane,
    batch)`` names its batch. Null and empty texts have length 0 and fill buckets like any row; rows
    longer than the budget are alone in their batch, never cut. A null doc_id and repeated rows are
    packed like others; ties in the order of a lane go by the rows' numbers. Other columns are ignored. An
    empty table gives no rows.
    """
    size = F.coalesce(F.octet_length(F.col("text").cast("string")) if length is None else length, F.lit(0)).cast("long")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("length"), F.monotonically_increasing_id().alias("h"))
    histogram = rows.groupBy(cell(F.col("length")).alias("cell")).agg(
        F.max("length").alias("top"), F.count("*").alias("n"), F.sum("length").alias("total")
    )
    cells = histogram.orderBy("top").toArrow()
    top, n, total = (cells.column(k).to_numpy() for k in ("top", "n", "total"))
    bounds = boundaries(top, n, total, buckets)
    count = np.add.reduceat(n, np.searchsorted(top, [-1, *bounds[:-1]], side="right")) if bounds else []
    plan = [(k, int(b), max(1, -(-int(c) // LANE_ROWS)), max(1, budget // max(b, 1))) for k, (b, c) in enumerate(zip(bounds, count, strict=True))]
    plan = plan or [(0, 0, 1, 1)]
    choice = F.lit(plan[-1][0])
    for k, b, _, _ in reversed(plan[:-1]):
        choice = F.when(F.col("length") <= b, k).otherwise(choice)
    pick = lambda i: F.element_at(F.array(*[F.lit(p[i]).cast("long") for p in plan]), F.col("bucket") + 1)
    dealt = rows.withColumn("bucket", choice).withColumn("bound", pick(1)).withColumn("lane", F.pmod("h", pick(2)))
    order = Window.partitionBy("bucket", "lane").orderBy("doc_id", "h")
    numbered = dealt.withColumn("batch", F.floor((F.row_number().over(order) - 1) / pick(3)))
    return numbered.select("doc_id", "length", "bucket", "bound", "lane", "batch", (F.col("bound") - F.col("length")).alias("padding"))
