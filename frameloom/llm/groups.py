"""Problem 4: one group identifier for all records linked directly or indirectly.

Hash-to-min. Every vertex holds a cluster, at first itself and its neighbours. In each
round it sends the whole cluster to the cluster's least member and that member to all
others; what a vertex receives is its next cluster. In the end the least vertex of a
component holds the component and every other vertex holds only that least one.

A cluster is kept as one row (v, u) per member, never as an array, so the cluster of a
component that holds a third of all records is spread over all tasks. The least member
per vertex is combined on the map side; the join that brings it back is on rows whose
other side is unique, so a skewed partition of it is split (adaptive skew join); rows are
made unique by hashing (v, u), which no vertex dominates. Components that are whole take no
part in further rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.plans.scratch import Scratch


def hash_to_min(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(id, group_id) of every record with a link to another; group_id is the least id of its component.

    Links are undirected; null ends, links of a record with itself, repeated and turned
    links are without effect. An empty table gives an empty result; columns other than
    the two ends are ignored.
    """
    ends = links.select(F.col(a).cast("bigint").alias("v"), F.col(b).cast("bigint").alias("u")).where("v IS NOT NULL AND u IS NOT NULL AND v <> u")
    # Clusters are mutual, so a pair is kept once, the lesser record first, and read in both directions.
    pairs = scratch.keep(ends.select(F.least("v", "u").alias("v"), F.greatest("v", "u").alias("u")).distinct())
    done: list[DataFrame] = []
    for _ in range(most_rounds):
        clusters = pairs.select(F.explode(F.array(F.struct("v", "u"), F.struct(F.col("u").alias("v"), F.col("v").alias("u")))).alias("e")).select("e.*")
        least = clusters.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        least = scratch.keep(least)
        # A component is whole once all members of its least record hold that one only.
        single = least.where("m < v AND n = 1").groupBy("m").agg(F.count(F.lit(1)).alias("k"))
        whole = least.where("m = v").join(single.withColumnRenamed("m", "v"), "v").where("n = k").select(F.col("v").alias("m"), F.lit(True).alias("whole"))
        state = scratch.keep(least.join(whole, "m", "left").select("v", "m", F.coalesce("whole", F.lit(False)).alias("whole")))
        scratch.drop(least)
        done.append(state.where("whole").select(F.col("v").alias("id"), F.col("m").alias("group_id")))
        open_ = state.where("NOT whole").select("v", "m")
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done)
        to_least = clusters.join(open_, "v").where("u <> m").select("m", "u").unionByName(open_.where("m < v").select("m", F.col("v").alias("u")))
        before, pairs = pairs, scratch.keep(to_least.select(F.col("m").alias("v"), "u").distinct())
        scratch.drop(before)
    raise RuntimeError(f"no stable clusters after {most_rounds} rounds")
