"""Problem 9: filling fixed-capacity containers with items.

Bound-certified repacking. Items are dealt to buckets of bounded size by a hash; each bucket
is packed by best fit decreasing, and dual feasible functions of its sizes bound the number
of containers it needs from below. A bucket that meets its bound is certified and
keeps its containers, but for the emptiest, which may still be joined with others'. Of a
bucket that doesn't, only full containers stay. What is left is dealt anew, so that
buckets with gaps exchange items, and packed again, until all fits one bucket or a round
settles nothing more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.plans.ranks import running_totals
from frameloom.plans.scratch import Scratch

LEAST_GAIN = 0.99
PLACED = "id bigint, piece bigint, size bigint, bucket bigint, bin bigint, start bigint, ordinal bigint, stays boolean"


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """No packing of counts[i] items of sizes[i] (1 .. capacity) has fewer containers.

    The greatest bound of these dual feasible functions: sizes themselves; for each t up to
    half a container, sizes over capacity - t as whole containers and those under t as
    nothing; and for k = 1 .. 30 the steps floor((k+1) x) / k of the filled part x.
    """
    if not len(sizes):
        return 0
    by = np.zeros(capacity + 2, np.int64)
    np.add.at(by, sizes, counts)
    number, volume = np.cumsum(by), np.cumsum(by * np.arange(capacity + 2))
    t = np.arange(1, capacity // 2 + 1)
    large = number[capacity] - number[capacity - t]
    middle = volume[capacity - t] - volume[t - 1]
    best = max(-(-int(volume[capacity]) // capacity), int((large + -(-middle // capacity)).max()) if len(t) else 0)
    for k in range(1, 31):
        whole = (sizes * (k + 1)) % capacity == 0
        # in parts of a container times capacity * k
        value = np.where(whole, sizes * k, (sizes * (k + 1)) // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each item its bin, start and ordinal there; of each bin its free space. Ties keep the given order."""
    order = np.argsort(-sizes, kind="stable")
    bins, start, ordinal = (np.zeros(len(sizes), np.int64) for _ in range(3))
    free: list[int] = []
    filled: list[int] = []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: a bin with r free
    for i, s in zip(order.tolist(), sizes[order].tolist()):
        fits = some >> s
        if fits:
            space = s + (fits & -fits).bit_length() - 1
            stack = by_space[space]
            b = stack.pop()
            if not stack:
                some &= ~(1 << space)
        else:
            b, space = len(free), capacity
            free.append(capacity)
            filled.append(0)
        bins[i], start[i], ordinal[i] = b, capacity - space, filled[b]
        filled[b] += 1
        free[b] = left = space - s
        if left:
            by_space[left].append(b)
            some |= 1 << left
    return bins, start, ordinal, np.array(free, np.int64)


def _pack_bucket(rows: pa.Table, capacity: int, final: bool) -> pa.Table:
    rows = rows.sort_by([("size", "descending"), ("id", "ascending"), ("piece", "ascending")])
    size = rows.column("size").to_numpy()
    bins, start, ordinal, free = best_fit_decreasing(size, capacity)
    values, counts = np.unique(size, return_counts=True)
    certified = len(free) <= lower_bound(values, counts, capacity)
    stays = np.ones(len(free), bool)
    if not final:
        if not certified:
            stays = free == 0
        if len(free) and free.max() > 0:
            stays[int(free.argmax())] = False
        number = np.cumsum(stays) - 1  # of those that stay
        bins_out = np.where(stays[bins], number[bins], -1)
    else:
        bins_out = bins
    return pa.table({"id": rows.column("id"), "piece": rows.column("piece"), "size": pa.array(size), "bucket": rows.column("bucket"), "bin": pa.array(bins_out), "start": pa.array(start), "ordinal": pa.array(ordinal), "stays": pa.array(stays[bins])})


def _packer(capacity: int, final: bool):
    return lambda rows: _pack_bucket(rows, capacity, final)


def pack(items: DataFrame, scratch: Scratch, capacity: int = 2048, per_bucket: int = 20_000) -> DataFrame:
    """The container and place of every item, and of every piece of items over capacity.

    `items`: id (unique), size. Result: id, piece (0, 1 ...), begin (of the piece in its item),
    size, container (0, 1 ...), start (in the container), ordinal. Items over capacity are
    cut into full pieces and a rest; no other item is cut. Items of no size are put at the
    start of some container, spread by a hash. Null sizes count as 0; rows of null id are
    left out; an empty table gives an empty result; other columns are ignored.
    """
    # Written, as sizes may be costly to find and are read twice.
    given = scratch.keep(items.where("id IS NOT NULL").select(F.col("id").cast("bigint").alias("id"), F.coalesce(F.col("size").cast("bigint"), F.lit(0)).alias("size")))
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("size") - 1) / capacity).cast("bigint"))
    cut = given.where("size > 0").select("id", F.explode(pieces).alias("piece"), F.col("size").alias("whole"))
    pool = scratch.keep(cut.select("id", "piece", F.least(F.lit(capacity), F.col("whole") - F.col("piece") * capacity).cast("bigint").alias("size")))
    done: list[DataFrame] = []
    n, r, final = pool.count(), 0, False
    while n:
        buckets = -(-n // per_bucket)
        final = final or (r > 0 and buckets == 1)
        dealt = pool.withColumn("bucket", F.pmod(F.xxhash64(F.lit(r), "id", "piece"), F.lit(buckets).cast("bigint")))
        packed = scratch.keep(dealt.groupBy("bucket").applyInArrow(_packer(capacity, final), PLACED))
        done.append(packed.where("stays").withColumn("round", F.lit(r)))
        if final:
            break
        before, pool = pool, scratch.keep(packed.where("NOT stays").select("id", "piece", "size"))
        scratch.drop(before)
        was, n = n, pool.count()
        final = n > LEAST_GAIN * was  # exchanging more settles next to nothing
        r += 1
    columns = ["id", "piece", "size", "container", "start", "ordinal"]
    empty = given.where("size <= 0").select("id", F.lit(0).cast("bigint").alias("piece"), F.lit(0).cast("bigint").alias("size"))
    if done:
        placed = done[0]
        for d in done[1:]:
            placed = placed.unionByName(d)
        bins = scratch.keep(placed.groupBy("round", "bucket").agg((F.max("bin") + 1).alias("bins")))  # a row per per_bucket items
        offsets = running_totals(bins, ["round", "bucket"], "bins", scratch, "offset").drop("bins")
        total = max(1, bins.agg(F.sum("bins")).first()[0] or 1)
        filled = placed.join(offsets, ["round", "bucket"]).withColumn("container", F.col("offset") + F.col("bin")).select(*columns)
    else:
        total, filled = 1, pool.select("id", "piece", "size", *(F.lit(0).cast("bigint").alias(c) for c in columns[3:]))
    zero = empty.select("*", F.pmod(F.xxhash64("id"), F.lit(total).cast("bigint")).alias("container"), F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("ordinal"))
    return filled.unionByName(zero).withColumn("begin", F.col("piece") * capacity)


def packing_report(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: items, tokens, containers, lower_bound (of any packing), fill (of all containers)."""
    sizes = packed.where("size > 0").groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    s, n = (np.array([r[k] for r in sizes], np.int64) for k in ("size", "n"))
    bound = lower_bound(s, n, capacity)
    whole = packed.agg(F.countDistinct("id").alias("items"), F.sum("size").alias("tokens"), F.countDistinct(F.when(F.col("size") > 0, F.col("container"))).alias("containers"))
    return whole.select("items", F.coalesce("tokens", F.lit(0)).alias("tokens"), "containers", F.lit(bound).cast("bigint").alias("lower_bound"), (F.col("tokens") / (F.col("containers") * capacity)).alias("fill"))
