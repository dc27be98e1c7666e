"""Row numbers and prefix sums over any number of rows, without a single-task window.

Rows are range-partitioned and sorted, each partition numbers its own rows, and the
partitions' counts (one row per partition and group that lies in it) give the offsets.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.plans.scratch import Scratch


def rank_in_groups(df: DataFrame, groups: list[str], order: list[str], scratch: Scratch, rank: str = "rank") -> DataFrame:
    """Adds `rank`: 0, 1, 2 ... within `groups` by `order`, which must be unique in a group.

    A group of any size is spread over as many partitions as it fills. The offsets are
    at most (partitions + groups) rows. Nulls order first. An empty frame stays empty.
    """
    at, part = f"__at_{rank}", f"__part_{rank}"
    # Written first, as ranges are found by a sample of the rows, which would run what makes them twice.
    given = df if hasattr(df, "_frameloom_path") else scratch.keep(df)
    placed = scratch.keep(
        given.repartitionByRange(*groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn(at, F.monotonically_increasing_id())
        .withColumn(part, F.shiftright(F.col(at), 33))
    )
    if given is not df:
        scratch.drop(given)
    counts = placed.groupBy(part, *groups).agg(F.min(at).alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    names = {c: f"__key_{i}" for i, c in enumerate([part, *groups])}
    for c, as_ in names.items():
        offsets = offsets.withColumnRenamed(c, as_)
    on = reduce(and_, (F.col(c).eqNullSafe(F.col(as_)) for c, as_ in names.items()))
    return placed.join(offsets, on).withColumn(rank, F.col(at) - F.col("__first") + F.col("__offset")).drop(at, part, "__first", "__offset", *names.values())


def running_totals(df: DataFrame, order: list[str], value: str, scratch: Scratch, total: str = "before", groups: list[str] | None = None, greatest: bool = False) -> DataFrame:
    """Adds `total`: the sum of a value over all rows before within `groups`, by `order`, which must be unique there.

    With `greatest` its greatest value instead, the row itself included. Rows are summed within range
    partitions, which a row per partition and group links, so a group may be of any size. Null values don't count.
    """
    groups = groups or []
    part = f"__part_{total}"
    given = df if hasattr(df, "_frameloom_path") else scratch.keep(df)
    placed = scratch.keep(given.repartitionByRange(*groups, *order).withColumn(part, F.spark_partition_id()))
    if given is not df:
        scratch.drop(given)
    over = F.max if greatest else F.sum
    sums = placed.groupBy(part, *groups).agg(over(value).alias("__sum"))
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    names = {c: f"__key_{i}" for i, c in enumerate([part, *groups])}
    starts = sums.select(*(F.col(c).alias(as_) for c, as_ in names.items()), over("__sum").over(earlier).alias("__start"))
    inside = Window.partitionBy(part, *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if greatest else -1)
    on = reduce(and_, (F.col(c).eqNullSafe(F.col(as_)) for c, as_ in names.items()))
    joined = placed.withColumn(total, over(value).over(inside)).join(starts, on)
    whole = F.greatest(total, "__start") if greatest else F.coalesce(total, F.lit(0)) + F.coalesce("__start", F.lit(0))
    return joined.withColumn(total, whole).drop(part, "__start", *names.values())
