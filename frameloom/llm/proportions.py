"""Problem 2: a sample that matches target category proportions.

Systematic unequal-probability sampling. Rows are ordered by category and, within it, by a
seeded hash; each has its category's inclusion probability, and a row is drawn where the
running sum of probabilities, plus one random start, passes a whole number. Prefix sums run
across range partitions by the partitions' counts. Floors of small categories are then
repaired: they draw their next rows, and the categories furthest above their share give up
their last ones.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.plans.ranks import rank_in_groups
from frameloom.plans.scratch import Scratch


def plan_sample(size: int, counts: list[int], shares: list[float], floor: int, start: float) -> list[tuple[float, float, int]]:
    """For each category (its running sum before, its inclusion probability, its final number of rows)."""
    share = sum(s for s in shares if s > 0) or 1.0
    weights = [max(s, 0.0) / share for s in shares]
    # What categories without enough rows lack goes to the others, so the sample keeps its size.
    want, open_, left = [0.0] * len(counts), [i for i, w in enumerate(weights) if w > 0 and counts[i]], float(size)
    while open_ and left > 0:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] / w * left >= counts[i]]
        if not full:
            for i in open_:
                want[i] = weights[i] / w * left
            break
        for i in full:
            want[i] = float(counts[i])
            left -= counts[i]
        open_ = [i for i in open_ if i not in full]
    out, before, drawn = [], start, []
    for n, k in zip(counts, want):
        p = k / n if n else 0.0
        out.append((before, p))
        after = before + n * p
        drawn.append(min(n, math.floor(after + 1e-9) - math.floor(before + 1e-9)))
        before = after
    while floor and sum(min(floor, n) for n, w in zip(counts, weights) if w > 0) > size:
        floor -= 1  # floors can't be more than the sample together
    final = list(drawn)
    for i, n in enumerate(counts):  # floors, as far as there are rows
        if weights[i] > 0:
            final[i] = max(final[i], min(floor, n))
    over = sum(final) - sum(drawn)
    while over > 0:  # given up by the categories furthest above their share that stay above the floor
        can = [i for i in range(len(counts)) if final[i] > min(floor, counts[i])]
        if not can:
            break
        i = max(can, key=lambda i: (final[i] - weights[i] * size, final[i], -i))
        final[i] -= 1
        over -= 1
    return [(b, p, f) for (b, p), f in zip(out, final)]


def proportional_sample(rows: DataFrame, targets: DataFrame, scratch: Scratch, category: str, key: list[str], size: int | float = 0.1, floor: int = 100, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(sample, report): `size` rows (an int), or that part of the eligible rows (a float).

    `targets`: category, share, further columns, which the report repeats; a control table
    that goes to the driver. Eligible are rows whose category has a positive share; rows of
    null category or another are never drawn. `key` orders ties of the hash; rows that
    agree in it are separate rows. report, a row per target category: share (of all),
    available, drawn, actual_share, lacking (rows short of share, 0 if none),
    below_floor (rows short of the floor). Floors that are more than `size` together are
    lowered alike until they aren't. An empty table gives an empty sample.
    """
    spark = rows.sparkSession
    listed = [r.asDict() for r in targets.orderBy("category").collect()]
    shares = [float(r["share"] or 0.0) for r in listed]
    names = spark.createDataFrame([(i, r["category"]) for i, r in enumerate(listed) if shares[i] > 0 and r["category"] is not None], "__c int, __name int")
    eligible = scratch.keep(rows.join(F.broadcast(names), rows[category] == F.col("__name")).drop("__name"))
    have = {r["__c"]: r["n"] for r in eligible.groupBy("__c").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [have.get(i, 0) for i in range(len(listed))]
    n = min(sum(counts), size if isinstance(size, int) else int(round(size * sum(counts))))
    plan = plan_sample(n, counts, shares, floor, random.Random(seed).random())
    table = spark.createDataFrame([(i, b, p, f) for i, (b, p, f) in enumerate(plan)], "__c int, __before double, __p double, __final bigint")
    keyed = eligible.withColumn("__rnd", F.xxhash64(F.lit(seed), *key))
    ranked = rank_in_groups(keyed, ["__c"], ["__rnd", *key], scratch, "__nth").join(F.broadcast(table), "__c")
    passed = lambda r: F.floor(F.col("__before") + r * F.col("__p") + 1e-9)
    nth = F.col("__nth")
    drawn, so_far = passed(nth + 1) > passed(nth), passed(nth) - passed(F.lit(0))  # of the category's rows before this one
    total = passed(F.lit(1) * F.col("__n")) - passed(F.lit(0))
    ranked = ranked.join(F.broadcast(spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "__c int, __n bigint")), "__c")
    # Fewer than drawn: the first drawn ones stay. More: all drawn ones and the first of the others.
    taken = F.when(drawn, so_far < F.col("__final")).otherwise((nth - so_far) < F.col("__final") - total)
    sample = ranked.where(taken).drop("__rnd", "__nth", "__before", "__p", "__final", "__n", "__c")
    whole, got = sum(s for s in shares if s > 0) or 1.0, sum(f for _, _, f in plan) or 1
    extra = [c for c in targets.columns if c not in ("category", "share")]
    kinds = {f.name: f.dataType.simpleString() for f in targets.schema}
    report = spark.createDataFrame(
        [
            (r["category"], *(r[c] for c in extra), s / whole, c, f, f / got, max(0.0, s / whole * n - f), max(0, floor - f) if s > 0 else 0)
            for r, s, c, (_, _, f) in zip(listed, shares, counts, plan)
        ],
        ", ".join(["category int", *(f"{c} {kinds[c]}" for c in extra), "share double, available bigint, drawn bigint, actual_share double, lacking double, below_floor bigint"]),
    )
    return sample, report
