"""Problem 3: choosing a varied subset.

Tournament-pivoted rank-revealing QR. Every record is a feature row: the bits of its
picture hash, a sketch of its clip and its shape. A block of rows nominates those a
pivoted QR takes, that is, each time the row with the most that the rows taken so far don't
span; nominees of two blocks are pivoted again, and so on up a tree. When the rows taken span
everything that is left, the rest is deflated: look-alikes of what was taken and clips
at their limit are set aside and the pivoting begins anew, until the wanted number is there.

Every dataset gets a quota (water-filling on the square root of its different views, one at
least), so none takes more than it deserves, and is cut into cells of about `per_cell` picks by a hash
of the clip; a tournament runs per cell and nominates half as many again as the cell's part. Blocks
hold about `block` rows whatever the size of a cell, so a dataset or clip of a third of all records
only has more blocks. Nominees of all cells and datasets are then deflated against each
other: for each word of the hash those of one word meet in order of their pick, and what is near one that
stays is set aside, so that no two that are left are look-alikes. Quotas are filled anew up to what each dataset has
left, in order of the picks; what was set aside is only taken where all datasets run dry.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm.mixing import fill
from frameloom.operators.similarity import words
from frameloom.plans.ranks import rank_in_groups
from frameloom.plans.scratch import Scratch, spread

ROWS = "id bigint, cell bigint, leaf bigint, quota int, hash bigint, clip bigint, shape double, pick int, residual double"
CLIP_DIMS, FAN_IN, LOOK_ALIKE = 16, 16, 4


def _mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64 bits of each number."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def features(hash_: np.ndarray, known: np.ndarray, clip: np.ndarray, shape: np.ndarray) -> np.ndarray:
    bits = (hash_[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    signs = (bits.astype(np.float32) * 2 - 1) * known[:, None]
    sketch = ((_mix(clip.view(np.uint64))[:, None] >> np.arange(CLIP_DIMS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1
    return np.concatenate([signs, sketch, np.clip(shape, -4, 4)[:, None].astype(np.float32)], axis=1)


def pivots(hash_: np.ndarray, known: np.ndarray, clip: np.ndarray, shape: np.ndarray, wanted: int, clip_share: float = 0.1) -> tuple[list[int], list[float]]:
    """Rows in the order a pivoted QR with deflation takes them, and what of each was new. Ties: the first row."""
    rows = features(hash_, known, clip, shape)
    n, wanted = len(rows), min(wanted, len(rows))
    limit = max(1, math.ceil(wanted * clip_share))
    taken, new, used = [], [], np.zeros(n, bool)
    aside = np.zeros(n, bool)  # look-alikes, and rows of clips at their limit
    of_clip: dict[int, int] = {}
    while len(taken) < wanted:
        open_ = ~used & ~aside
        if not open_.any():
            aside[:] = False
            limit = n
            open_ = ~used
        left = rows.copy()
        norm = np.einsum("ij,ij->i", left, left)
        least, fresh = 1e-3 * max(float(norm.max()), 1e-9), True
        while len(taken) < wanted:
            i = int(np.where(open_, norm, -1.0).argmax())
            if not open_[i] or norm[i] <= least and not fresh:
                break
            fresh = False
            remains = math.sqrt(max(float(norm[i]), 1e-12))
            direction = left[i] / remains
            left -= np.outer(left @ direction, direction)
            norm = np.einsum("ij,ij->i", left, left)
            taken.append(i)
            new.append(remains)
            used[i] = True
            open_[i] = False
            c = int(clip[i])
            of_clip[c] = of_clip.get(c, 0) + 1
            out = clip == c if of_clip[c] >= limit else np.zeros(n, bool)
            if known[i]:
                out |= known & (np.bitwise_count(hash_ ^ hash_[i]) <= LOOK_ALIKE)
            aside |= out & ~used
            open_ &= ~out
        else:
            break
    return taken, new


def _take(t: pa.Table, wanted: int) -> pa.Table:
    known = ~t.column("hash").is_null().to_numpy(zero_copy_only=False)
    h = t.column("hash").fill_null(0).to_numpy().view(np.uint64)
    at, new = pivots(h, known, t.column("clip").to_numpy(), t.column("shape").to_numpy(), wanted)
    t = t.take(pa.array(at, pa.int64()))
    t = t.set_column(t.schema.get_field_index("pick"), "pick", pa.array(np.arange(len(at)), pa.int32()))
    return t.set_column(t.schema.get_field_index("residual"), "residual", pa.array(new, pa.float64()))


def _round(rows: pa.Table) -> pa.Table:
    """Nominees of a group of blocks: each block's, then pairwise up the tree."""
    rows = rows.sort_by([("leaf", "ascending"), ("id", "ascending")]).combine_chunks()
    wanted = rows.column("quota")[0].as_py()
    leaf = rows.column("leaf").to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
    blocks = [rows.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]
    if len(blocks) == 1:
        return _take(blocks[0], wanted)
    while len(blocks) > 1:
        blocks = [_take(pa.concat_tables(blocks[i : i + 2]).combine_chunks(), wanted) if i + 1 < len(blocks) else blocks[i] for i in range(0, len(blocks), 2)]
    return blocks[0]


def quotas(k: int, views: list[int]) -> list[int]:
    """k picks over datasets of so many different views: by their square root, one each at least."""
    k = min(k, sum(views))
    if k <= len(views):
        return fill(k, [math.sqrt(v) for v in views], [1] * len(views))
    more = fill(k - len(views), [math.sqrt(v) for v in views], [v - 1 for v in views])
    return [1 + m for m in more]


def _apart(batches: Iterator[pa.RecordBatch], chunk: int = 2048) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (w, order), with a hash, those that aren't near one of their w that stays. Held are the hashes of one w that stay."""
    group: int | None = None
    stay: list[np.ndarray] = []
    for b in batches:
        w, h = b.column("w").to_numpy(), b.column("hash").to_numpy().view(np.uint64)
        ok = np.ones(len(w), bool)
        cuts = [0, *(np.flatnonzero(np.diff(w)) + 1).tolist(), len(w)] if len(w) else [0]
        for x, y in zip(cuts[:-1], cuts[1:]):
            if group != int(w[x]):
                group, stay = int(w[x]), []
            for at in range(x, y, chunk):
                part = h[at : min(at + chunk, y)]
                mine = np.ones(len(part), bool)
                for s in stay:
                    open_ = np.flatnonzero(mine)
                    mine[open_[(np.bitwise_count(part[open_, None] ^ s[None, :]) <= LOOK_ALIKE).any(axis=1)]] = False
                open_ = np.flatnonzero(mine)
                near = np.bitwise_count(part[open_, None] ^ part[None, open_]) <= LOOK_ALIKE
                for i in np.flatnonzero(near.sum(axis=1) > 1).tolist():
                    if mine[open_[i]]:
                        later = open_[i + 1 :][near[i, i + 1 :]]
                        mine[later] = False
                ok[at : at + len(part)] = mine
                if mine.any():
                    stay.append(part[mine])
                    if len(stay) > 1 and len(stay[-2]) < chunk:
                        stay[-2:] = [np.concatenate(stay[-2:])]
        if ok.any():
            yield b.filter(pa.array(ok))


def look_alikes_apart(nominees: DataFrame) -> DataFrame:
    """(id) of nominees (id, hash, pick, rnd) of which no two are look-alikes: in order of (pick, rnd, id), what is near one that stays goes.

    Two hashes within LOOK_ALIKE bits agree in a word, so a pass per word leaves no such pair, and no pair is ever a row.
    """
    rows = nominees.select("id", "hash", "pick", "rnd")
    for m in words(LOOK_ALIKE):
        w = F.col("hash").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint"))
        by = rows.withColumn("w", w).repartition(spread(rows.sparkSession), "w").sortWithinPartitions("w", "pick", "rnd", "id")
        rows = by.mapInArrow(_apart, "id bigint, hash bigint, pick int, rnd bigint, w bigint").drop("w")
    return rows.select("id")


def varied_subset(records: DataFrame, scratch: Scratch, k: int | float = 0.01, per_cell: int = 48, block: int = 4096, seed: int = 42) -> DataFrame:
    """A subset of k records (an int), or of that part of all different views (a float).

    `records`: id (unique), dataset, clip (null: none), hash (null: unknown), shape, least_boxes
    (null: no limit), boxes. Result: id, dataset, pick (order within its cell), residual
    (what was new in it). Records of fewer boxes than least_boxes can't be chosen. Records of
    one dataset and hash are one view, shown by its least id; a record of unknown hash is a
    view of its clip, or its own if it has none. Every dataset with a view is present if
    k allows, and so is every sort of view (the 16 kinds of the hash's four highest bits,
    and unknown). No two chosen records are look-alikes (hashes within LOOK_ALIKE bits) unless a dataset has
    nothing else or all run dry. Rows of null id or dataset are left out; an empty table gives an empty
    result; other columns are ignored. Datasets are counted on the driver, cells aren't.
    """
    spark = records.sparkSession
    able = records.where("id IS NOT NULL AND dataset IS NOT NULL AND (least_boxes IS NULL OR coalesce(boxes, 0) >= least_boxes)")
    clip = F.coalesce(F.xxhash64("dataset", F.when(F.col("clip").isNotNull(), F.col("clip"))), F.lit(0))
    clip = F.when(F.col("clip").isNotNull(), clip).otherwise(F.xxhash64(F.lit("none"), "id"))
    view = F.when(F.col("hash").isNull(), clip).otherwise(F.col("hash"))
    one = F.min(F.struct("id", clip.alias("clip"), F.coalesce(F.col("shape"), F.lit(0.0)).cast("double").alias("shape"))).alias("one")
    views = scratch.keep(able.groupBy("dataset", "hash", view.alias("view")).agg(one).select("one.id", "dataset", "hash", "one.clip", "one.shape"))
    counted = views.groupBy("dataset").agg(F.count(F.lit(1)).alias("n")).orderBy("dataset").collect()
    n = [r["n"] for r in counted]
    total = k if isinstance(k, int) else int(round(k * sum(n)))
    got = quotas(total, n) if n else []
    plan = spark.createDataFrame([(r["dataset"], i, g, max(1, -(-g // per_cell))) for i, (r, g) in enumerate(zip(counted, got)) if g], "dataset string, d int, got int, cells int")
    placed = views.join(F.broadcast(plan), "dataset").withColumn("cell", F.col("d").cast("bigint") * 2**32 + F.pmod(F.xxhash64(F.lit(seed), "clip"), F.col("cells")))
    cells = scratch.keep(placed.groupBy("d", "got", "cell").agg(F.count(F.lit(1)).alias("size")))
    roots = cells.groupBy("d").agg(F.sum(F.sqrt("size")).alias("roots"))
    part = F.ceil(F.lit(1.5) * F.col("got") * F.sqrt("size") / F.col("roots")) + 1
    table = scratch.keep(cells.join(F.broadcast(roots), "d").select("cell", F.least(part, F.col("size")).cast("int").alias("quota"), F.ceil(F.col("size") / F.lit(block)).cast("int").alias("leaves")))
    rows = placed.join(table, "cell").select(
        "id", "cell", F.pmod(F.xxhash64(F.lit(seed), F.lit("leaf"), "id"), F.col("leaves")).cast("bigint").alias("leaf"), "quota", "hash", "clip", "shape", F.lit(0).alias("pick"), F.lit(0.0).alias("residual")
    )
    kept = scratch.keep(rows.groupBy("cell", "leaf").applyInArrow(_round, ROWS))
    leaves = table.agg(F.max("leaves")).first()[0] or 1
    while leaves > 1:
        up = kept.withColumn("group", F.floor(F.col("leaf") / FAN_IN)).groupBy("cell", "group").applyInArrow(lambda t: _round(t.drop_columns(["group"])), ROWS)
        before, kept = kept, scratch.keep(up.withColumn("leaf", F.floor(F.col("leaf") / FAN_IN).cast("bigint")))
        scratch.drop(before)
        leaves = -(-leaves // FAN_IN)
    nominees = scratch.keep(kept.select("id", F.shiftright("cell", 32).cast("int").alias("d"), "hash", "pick", "residual", F.xxhash64(F.lit(seed), F.lit("order"), "id").alias("rnd")))
    apart = look_alikes_apart(nominees.where("hash IS NOT NULL")).unionByName(nominees.where("hash IS NULL").select("id")).withColumn("apart", F.lit(True))
    nominees = scratch.keep(nominees.join(apart, "id", "left").withColumn("aside", F.coalesce(~F.col("apart"), F.lit(True))).drop("apart"))
    # Quotas up to what is apart in each dataset, one at least, then up to all nominees.
    have = {r["d"]: r for r in nominees.groupBy("d").agg(F.count_if(~F.col("aside")).alias("a"), F.count(F.lit(1)).alias("n")).collect()}
    ds = sorted(have)
    free = [max(1, have[d]["a"]) for d in ds]
    last = quotas(min(total, sum(free)), free)
    lack = min(total, sum(have[d]["n"] for d in ds)) - sum(last)
    more = fill(lack, [math.sqrt(have[d]["n"]) for d in ds], [have[d]["n"] - q for d, q in zip(ds, last)]) if lack > 0 else [0] * len(ds)
    final = spark.createDataFrame([(d, counted[d]["dataset"], q + m) for d, q, m in zip(ds, last, more)], "d int, dataset string, final bigint")
    ranked = rank_in_groups(nominees, ["d"], ["aside", "pick", "rnd", "id"], scratch, "nth")
    chosen = scratch.keep(ranked.join(F.broadcast(final), "d").where("nth < final").select("id", "dataset", "hash", "aside", "pick", "residual"))
    sort = F.coalesce(F.shiftrightunsigned("hash", 60).cast("int"), F.lit(16))
    there = {r[0] for r in chosen.select(sort.alias("s")).distinct().collect()}  # at most 17
    result = chosen.select("id", "dataset", "pick", "residual")
    lacking = views.withColumn("s", sort).where(~F.col("s").isin(*there, -1)).groupBy("s").agg(F.min(F.struct("id", "dataset")).alias("one")).select("one.id", "one.dataset") if there else None
    extra = lacking.collect() if lacking is not None else []
    if extra:  # in place of the last picks
        out = [r["id"] for r in chosen.orderBy(F.col("aside").desc(), F.col("pick").desc(), F.col("id").desc()).limit(len(extra)).collect()]
        added = spark.createDataFrame([(r["id"], r["dataset"], 0, 0.0) for r in extra], "id bigint, dataset string, pick int, residual double")
        result = result.where(~F.col("id").isin(out)).unionByName(added)
    return result
