"""Equi-joins whose plan is left to adaptive execution, which knows the sizes of what was shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqframe.session import broadcast_limit, plan_bytes


def join_on(left: DataFrame, right: DataFrame, key: str, how: str = "inner", right_unique: bool = False) -> DataFrame:
    """Join on one column with ``how`` in inner, left, left_semi, left_anti.

    Nothing is counted or sampled before the join. Catalyst's estimate of rows that are generated, or of texts that
    are parsed or built, can be far too low, so a side it calls small is not broadcast on its word: such a join is planned as a
    shuffled one. Adaptive execution splits partitions that a hot key makes large, with copies of
    the other side's.

    ``right_unique`` states that the right side has one row per key. A left join to several rows per key is made of an
    inner join and of the rows without a match, since only the kept side of an outer join can be split.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    if how in ("left_semi", "left_anti"):
        # combined before the shuffle, so a hot key of the right side is a row a task
        right, right_unique = right.select(key).distinct(), True
    if plan_bytes(right) <= broadcast_limit(left.sparkSession) and not _as_read(right):
        right = right.hint("merge")
    if how != "left" or right_unique:
        return left.join(right, key, how)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name != key]
    alone = left.join(right.select(key).distinct().hint("merge"), key, "left_anti").select(key, *[c for c in left.columns if c != key], *nothing)
    return left.join(right, key, "inner").unionByName(alone)


def _as_read(df: DataFrame) -> bool:
    """Whether rows are as files or the driver hold them, so that the estimate of their size can be believed."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    names = {line.strip(" :+-").split(" ")[0].split("(")[0] for line in plan.splitlines()}
    return names <= {"Relation", "LocalRelation", "Filter", "Project", "Aggregate", "SubqueryAlias", "ReusedSubquery"} and "json" not in plan
