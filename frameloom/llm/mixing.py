"""Problem 5: mixing sources to target weights.

Capped water-filling: every source's size is its weight's part of the total; sources that
would need more than their records times their most epochs are clamped there and what they
lack goes to the others in proportion to their weights, until no source is over its cap.
A source of m uses over n records uses every record m // n times, and m % n records, the
first by a seeded hash, once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.plans.ranks import rank_in_groups
from frameloom.plans.scratch import Scratch


def fill(total: int, weights: list[float], caps: list[int | None]) -> list[int]:
    """Whole sizes that add up to `total`, or to all caps if these are less.

    Sizes follow the weights but for sources at their cap (None: no limit). Sources of no
    weight get nothing. Fractions go to the largest remainders, ties to the earlier source.
    """
    size, open_, left = [0.0] * len(weights), [i for i, w in enumerate(weights) if w and w > 0], float(total)
    while open_ and left > 0:
        share = sum(weights[i] for i in open_)
        over = [i for i in open_ if caps[i] is not None and weights[i] / share * left >= caps[i]]
        if not over:
            for i in open_:
                size[i] = weights[i] / share * left
            break
        for i in over:
            size[i] = float(caps[i])
            left -= caps[i]
        open_ = [i for i in open_ if i not in over]
        left = max(left, 0.0)
    whole = [int(s + 1e-9) for s in size]
    room = [i for i in range(len(size)) if weights[i] and weights[i] > 0 and (caps[i] is None or whole[i] < caps[i])]
    missing = min(total, round(sum(size))) - sum(whole)
    for i in sorted(room, key=lambda i: (-(size[i] - whole[i]), i))[: max(0, missing)]:
        whole[i] += 1
    return whole


def mixture(records: DataFrame, targets: DataFrame, scratch: Scratch, total: int | float = 1.0, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(uses, report) of a mixture of `total` uses (an int) or of that multiple of all listed records (a float).

    `records`: source_kind, source_id, record_id, unique. `targets`: source_kind, source_id,
    target_share, max_repeats (null: no limit); shares needn't add up to 1; of a source
    listed twice the largest share and limit count; null, zero or negative shares and
    limits under one get nothing. A source of no records gets nothing and its share goes
    to the others. Records of sources that aren't listed aren't used.
    uses: source_kind, source_id, record_id, repeats (1 or more).
    report, a row per target: target_share (of all that are listed), available, max_repeats,
    used, actual_share, epochs, lacking (uses short of its target).
    targets is a control table, a row per source, and goes to the driver.
    """
    spark = records.sparkSession
    listed = targets.groupBy("source_kind", "source_id").agg(F.max("target_share").alias("share"), F.max(F.coalesce(F.col("max_repeats"), F.lit(2**31 - 1))).alias("most")).orderBy("source_kind", "source_id").collect()
    keys = spark.createDataFrame([(i, r.source_kind, r.source_id) for i, r in enumerate(listed)], "source int, kind_ string, id_ string")
    ours = scratch.keep(records.join(F.broadcast(keys), (F.col("source_kind") == F.col("kind_")) & (F.col("source_id") == F.col("id_"))).select("source", "record_id"))
    have = {r["source"]: r["n"] for r in ours.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = [have.get(i, 0) for i in range(len(listed))]
    weights = [max(r.share or 0.0, 0.0) for r in listed]
    limits = [max(int(r.most), 0) for r in listed]
    caps: list[int | None] = [0 if not a else None if m == 2**31 - 1 else a * m for a, m in zip(n, limits)]
    size = total if isinstance(total, int) else int(round(total * sum(n)))
    got = fill(size, weights, caps)

    plan = spark.createDataFrame([(i, g // a, g % a) for i, (g, a) in enumerate(zip(got, n)) if a and g], "source int, whole bigint, rest bigint")
    seeded = ours.withColumn("rnd", F.xxhash64(F.lit(seed), "source", "record_id"))
    ranked = rank_in_groups(seeded, ["source"], ["rnd", "record_id"], scratch, "nth")
    uses = (
        ranked.join(F.broadcast(plan), "source").join(F.broadcast(keys), "source")
        .withColumn("repeats", F.col("whole") + (F.col("nth") < F.col("rest")).cast("bigint")).where("repeats > 0")
        .select(F.col("kind_").alias("source_kind"), F.col("id_").alias("source_id"), "record_id", "repeats")
    )
    whole, used = sum(weights) or 1.0, sum(got) or 1
    report = spark.createDataFrame(
        [
            (r.source_kind, r.source_id, w / whole, a, None if m == 2**31 - 1 else m, g, g / used, g / a if a else None, max(0.0, w / whole * size - g))
            for r, w, a, m, g in zip(listed, weights, n, limits, got)
        ],
        "source_kind string, source_id string, target_share double, available bigint, max_repeats bigint, used bigint, actual_share double, epochs double, lacking double",
    )
    return uses, report
