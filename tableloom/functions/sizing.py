"""How large a plan's input and result are likely to be, by the optimizer's own estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame

PARTITION_BYTES = 128 << 20
"""Estimated bytes of input a partition of a shuffle should stand for."""
MOST_PARTITIONS = 100_000
UNKNOWN_BYTES = 1 << 60
"""Spark gives sources it knows nothing of a size beyond this."""


def _bytes(plan) -> int | None:
    size = int(str(plan.stats().sizeInBytes()))
    return size if size < UNKNOWN_BYTES else None


def _optimized(df: DataFrame):
    """The optimized plan, or None in sessions without a local one (Spark Connect)."""
    plan = getattr(df, "_jdf", None)
    return None if plan is None else plan.queryExecution().optimizedPlan()


def plan_bytes(df: DataFrame) -> int | None:
    """The optimizer's estimate of the result's bytes, None if it has none. No job runs.

    Files count with their size on disk. A join without statistics counts as the
    product of its sides, so the estimate errs on the large side.
    """
    plan = _optimized(df)
    return None if plan is None else _bytes(plan)


def input_bytes(df: DataFrame) -> int:
    """Estimated bytes of all tables the plan reads; sources of unknown size count nothing."""
    plan = _optimized(df)
    if plan is None:
        return 0
    leaves = plan.collectLeaves()
    return sum(_bytes(leaves.apply(i)) or 0 for i in range(leaves.length()))


def partitions_for(df: DataFrame, bytes_each: int = PARTITION_BYTES) -> int:
    """Partitions for a shuffle of ``df``: the session's number, more for large input."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MOST_PARTITIONS, -(-input_bytes(df) // bytes_each)))


def dealt_partitions_for(df: DataFrame, bytes_each: int) -> int:
    """As ``partitions_for``, of the session's number only what Spark's writers need not sort rows for.

    With more partitions than that, the task that reads a file holds its rows to
    sort them by partition: for one large file, all of it. Large input still gets
    more, and has more tasks that read it.
    """
    conf = df.sparkSession.conf
    unsorted = int(conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    least = max(1, min(int(conf.get("spark.sql.shuffle.partitions")), unsorted))
    return max(least, min(MOST_PARTITIONS, -(-input_bytes(df) // bytes_each)))


def would_broadcast(df: DataFrame) -> bool:
    """Whether Spark would send ``df`` whole to every task of a join, by its own estimate."""
    size = plan_bytes(df)
    if size is None:
        return False
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return size <= conf.autoBroadcastJoinThreshold()
