"""Joins on the distance of 64-bit picture hashes.

Two hashes that differ in at most T bits agree in one of T + 1 words; rows are partitioned
by (position, word) and compared within a partition on whole arrays, each pair at its first
word in common. Words that too many values share get a second word in their key, taken from
the other bits, so that groups shrink as data grow; what is still crowded is cut into cells
on both sides. Different hash values are compared, not rows; rows come back by a join on the value.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.geometry import hamming
from frameloom.plans.ranks import rank_in_groups
from frameloom.plans.scratch import Scratch, spread

BLOCK = 2048
AT_ONCE = 2_000_000  # pairs
LEAST_WORDS = 4  # of at most 16 bits


def _cut(bits: list[int], parts: int) -> list[int]:
    """Masks that deal the given bits to so many words, in turn, as bits next to each other are often alike."""
    return [sum(1 << b for b in bits[i::parts]) for i in range(parts)]


def words(threshold: int) -> list[int]:
    """Masks of words that cover all 64 bits, more of them than `threshold`."""
    return _cut(list(range(64)), max(threshold + 1, LEAST_WORDS))


def _rest(mask: int) -> list[int]:
    return [b for b in range(64) if not mask >> b & 1]


def _subwords(threshold: int) -> list[list[int]]:
    """For each word, masks that cut the bits outside of it into threshold + 1 words or more."""
    return [_cut(_rest(w), max(threshold + 1, LEAST_WORDS)) for w in words(threshold)]


def _in_blocks(at: np.ndarray, n: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j): at[x] with first[x], first[x] + 1 ... n[x] times, some million at a time."""
    total, done = np.cumsum(n), 0
    while done < len(at):
        end = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + AT_ONCE, "right")))
        m = n[done:end]
        begin = np.cumsum(m) - m
        yield np.repeat(at[done:end], m), np.arange(m.sum()) + np.repeat(first[done:end] - begin, m)
        done = end


def _keyed(values: np.ndarray, mask: np.uint64) -> np.ndarray:
    """Sorted numbers: 32 bits of a hash of the masked value, then 32 of its place. Sorting these is faster than by places."""
    x = values & mask
    x *= np.uint64(0x9E3779B97F4A7C15)
    x &= np.uint64(0xFFFFFFFF << 32)
    x |= np.arange(len(x), dtype=np.uint64)
    x.sort()
    return x


def _equal(left: np.ndarray, right: np.ndarray | None, mask: np.uint64, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Values x of left and y of right within the threshold that agree in the mask, and by chance some others; without `right` pairs of left values, each once."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)

    def near(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(np.bitwise_count(x ^ y) <= threshold)
        return x[at], y[at]

    packed = _keyed(left, mask)
    s, x = packed >> half, left[(packed & low).view(np.int64)]
    if right is None:
        n = len(s)
        ends = np.append(np.flatnonzero(s[1:] != s[:-1]) + 1, n)
        after = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n) - 1  # how many more are alike
        step, most = 1, int(after.max())
        while step <= most:
            if 16 * np.count_nonzero(after >= step) < n:  # few long runs
                at = np.flatnonzero(after >= step)
                for i, j in _in_blocks(at, after[at] - (step - 1), at + step):
                    yield near(x[i], x[j])
                return
            yield near(x[:-step], x[step:])
            step += 1
        return
    packed = _keyed(right, mask)
    ranked, y = packed >> half, right[(packed & low).view(np.int64)]
    lo = np.searchsorted(ranked, s, "left")
    n = np.searchsorted(ranked, s, "right") - lo
    at = np.flatnonzero(n)
    for i, j in _in_blocks(at, n[at], lo[at]):
        yield near(x[i], y[j])


def _n_pairs(left: np.ndarray, right: np.ndarray | None) -> tuple[float, int]:
    """How many pairs agree, and in how many groups."""
    a, na = np.unique(left, return_counts=True)
    if right is None:
        return float((na.astype(float) * (na - 1)).sum() / 2), len(a)
    b, nb = np.unique(right, return_counts=True)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    return float((na[i].astype(float) * nb[j]).sum()), len(i)


def _compare(own: int, differ: list[int], left: np.ndarray, right: np.ndarray | None, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that agree in the word `own`, in no word of `differ`, and differ in at most `threshold` bits.

    Without `right`, pairs of left values. Where many pairs agree, the other bits are cut into
    threshold + s words, of which s are the same for sure: pairs are looked up by every choice of
    s words, and found by the first s that are the same.
    """
    own_ = np.uint64(own)
    pairs, groups = _n_pairs(left & own_, None if right is None else right & own_)
    if not pairs:
        return

    def verified(x: np.ndarray, y: np.ndarray, same: np.uint64, differ: list[int]) -> tuple[np.ndarray, np.ndarray]:
        d = x ^ y
        ok = (d & same) == 0
        for m in differ:
            ok &= (d & np.uint64(m)) != 0
        return x[ok], y[ok]

    rest, n = _rest(own), len(left) + (0 if right is None else len(right))
    # Seconds of comparing groups as wholes, and of looking up by s further words: per pair, row and choice.
    each = 2e-8 if right is None else 5e-8
    cost = {-1: pairs * 5e-9 + groups * 3e-5, 0: n * 3e-8 + pairs * each}
    for s in range(1, 6):
        if threshold + s <= len(rest):
            cost[s] = math.comb(threshold + s, s) * (n * 3e-8 + pairs / 2 ** (s * len(rest) / (threshold + s)) * each + 1e-4)
    s = min(cost, key=cost.get)
    if s < 0:
        left = left[np.argsort(left & own_)]
        keys, starts = np.unique(left & own_, return_index=True)
        if right is not None:
            right = right[np.argsort(right & own_)]
            ranked = right & own_
            lo, hi = np.searchsorted(ranked, keys, "left"), np.searchsorted(ranked, keys, "right")
        for g, (a, b) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), len(left)])):
            x_all = left[a:b]
            y_all = x_all if right is None else right[lo[g] : hi[g]]
            for i in range(0, len(x_all), BLOCK):
                x = x_all[i : i + BLOCK]
                for j in range(i if right is None else 0, len(y_all), BLOCK):
                    y = y_all[j : j + BLOCK]
                    p, q = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= threshold)
                    if right is None and i == j:
                        p, q = p[p < q], q[p < q]
                    if len(p):
                        yield verified(x[p], y[q], own_, differ)
        return
    masks = _cut(rest, threshold + s) if s else []
    for chosen in combinations(range(len(masks)), s):
        mask = own_ | np.uint64(sum(masks[c] for c in chosen))
        others = [*differ, *(masks[c] for c in range(chosen[-1]) if c not in chosen)] if chosen else differ
        for x, y in _equal(left, right, mask, threshold):
            if len(x):
                yield verified(x, y, mask, others)


def _near_of_partition(batches: Iterator[pa.RecordBatch], threshold: int, both: bool, at_once: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Rows (c: position, second word and cell; k; value; side) sorted by c and k, some whole groups at a time."""
    first, second = words(threshold), _subwords(threshold)

    def batch(a: list, b: list) -> pa.RecordBatch:
        x, y = np.concatenate(a), np.concatenate(b)
        distance = np.bitwise_count(x ^ y).astype(np.int32)
        if both:
            u, v = x.view(np.int64), y.view(np.int64)
            x, y = np.minimum(u, v), np.maximum(u, v)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), pa.array(distance)], ["a", "b", "distance"])

    def near(c: np.ndarray, v: np.ndarray, side: np.ndarray) -> Iterator[pa.RecordBatch]:
        some_a, some_b, n = [], [], 0
        cuts = [0, *(np.flatnonzero(np.diff(c)) + 1).tolist(), len(c)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            position, sub = int(c[a]) >> 48, int(c[a]) >> 40 & 0xFF
            own, differ = first[position], first[:position]
            if sub:
                own, differ = own | second[position][sub - 1], [*differ, *second[position][: sub - 1]]
            of, values = side[a:b], v[a:b]
            alone = both and bool((of == 3).all())
            for x, y in _compare(own, differ, values if alone else values[(of & 1) > 0], None if alone else values[(of & 2) > 0], threshold):
                some_a.append(x)
                some_b.append(y)
                n += len(x)
                if n >= 50_000:
                    yield batch(some_a, some_b)
                    some_a, some_b, n = [], [], 0
        if n:
            yield batch(some_a, some_b)

    held, size = [], 0
    for b in batches:
        held.append((b.column("c").to_numpy(), b.column("k").to_numpy(), b.column("value").to_numpy().view(np.uint64), b.column("side").to_numpy()))
        size += b.num_rows
        if size >= at_once:
            c, k, v, s = (np.concatenate(x) for x in zip(*held))
            last = np.flatnonzero((c != c[-1]) | (k != k[-1]))  # the last group may go on
            end = int(last[-1]) + 1 if len(last) else 0
            if end:
                yield from near(c[:end], v[:end], s[:end])
            held, size = [(c[end:], k[end:], v[end:], s[end:])], 0
    if held:
        c, k, v, s = (np.concatenate(x) for x in zip(*held))
        if len(c):
            yield from near(c, v, s)


def _cells(rows: DataFrame, both: bool) -> DataFrame:
    """Rows (c, k, value, side, cl, cr) of groups cut into cl parts of left and cr parts of right values, each part with each of the other side."""
    part = lambda n: F.pmod(F.xxhash64(F.lit("part"), "value"), n)
    cell = lambda i, j, side: F.struct((F.col("c") + i * F.lit(1 << 20) + j).alias("c"), F.lit(side).alias("side"))
    each = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    if both:
        i = part(F.col("cl"))
        to = F.transform(each(F.col("cl")), lambda j: F.when(i == j, cell(i, j, 3)).when(i < j, cell(i, j, 1)).otherwise(cell(j, i, 2)))
        return rows.select("value", "k", F.explode(to).alias("e")).select("value", "e.side", "e.c", "k")
    left = rows.where("side & 1 = 1").select("value", "k", F.explode(F.transform(each(F.col("cr")), lambda j: cell(part(F.col("cl")), j, 1))).alias("e"))
    right = rows.where("side & 2 = 2").select("value", "k", F.explode(F.transform(each(F.col("cl")), lambda i: cell(i, part(F.col("cr")), 2))).alias("e"))
    return left.unionByName(right).select("value", "e.side", "e.c", "k")


def near_values(values: DataFrame, threshold: int, both: bool = False, hot: int = 1_000_000) -> DataFrame:
    """(a, b, distance) of values with side bit 1 and values with side bit 2 within `threshold` bits (0 to 64), equal ones too.

    `values`: unique `value` bigint, `side` int, from a written table, as it is read twice. `both`: all
    values are on both sides; each pair of different ones comes once, a < b. A group of more than `hot` values of
    a side is cut into cells of that many; where that would send a value to more cells than there are words,
    the group is cut by a second word first.
    """
    threshold = min(threshold, 64)
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    cut, second = words(threshold), _subwords(threshold)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masked = lambda m: F.col("value").bitwiseAND(F.lit(signed(m)).cast("bigint"))
    keys = values.select("value", "side", F.explode(F.array(*(F.struct(F.lit(i << 48).cast("bigint").alias("c"), masked(m).alias("k")) for i, m in enumerate(cut)))).alias("e")).select("value", "side", "e.c", "e.k")

    def crowded(rows: DataFrame) -> DataFrame:
        n = rows.groupBy("c", "k").agg(F.count_if(F.col("side").bitwiseAND(1) == 1).alias("nl"), F.count_if(F.col("side").bitwiseAND(2) == 2).alias("nr"))
        parts = lambda c: F.greatest(F.ceil(F.col(c) / F.lit(hot)), F.lit(1)).cast("bigint")
        return n.where(F.greatest("nl", "nr") > hot).select(F.col("c").alias("hc"), F.col("k").alias("hk"), parts("nl").alias("cl"), parts("nr").alias("cr"))

    at = lambda rows: (F.col("c") == F.col("hc")) & (F.col("k") == F.col("hk"))
    full = crowded(keys)
    plain = ["value", "side", "c", "k"]
    dealt = keys
    if not full.isEmpty():
        # There are at most 4 * 2 ** 16 words.
        j = keys.join(F.broadcast(full), at(keys), "left")
        n_cells = F.col("cl") if both else F.greatest("cl", "cr")
        dealt = j.where("hc IS NULL").select(*plain).unionByName(_cells(j.where(n_cells <= len(cut)), both))
        masks = F.array(*(F.array(*(F.lit(signed(w | m)).cast("bigint") for m in of)) for w, of in zip(cut, second)))
        finer = j.where(n_cells > len(cut)).select("value", "side", "c", F.posexplode(F.element_at(masks, F.shiftright("c", 48).cast("int") + 1)).alias("sub", "mask"))
        finer = finer.select("value", "side", (F.col("c") + (F.col("sub") + 1).cast("bigint") * F.lit(1 << 40)).alias("c"), F.col("value").bitwiseAND(F.col("mask")).alias("k"))
        j = finer.join(crowded(finer), at(finer), "left")
        dealt = dealt.unionByName(j.where("hc IS NULL").select(*plain)).unionByName(_cells(j.where("hc IS NOT NULL"), both))
    # Comparing costs more than the rows weigh, so their partitions aren't put together by weight.
    rows = dealt.repartition(spread(values.sparkSession), "c", "k").sortWithinPartitions("c", "k")
    return rows.mapInArrow(lambda x: _near_of_partition(x, threshold, both), "a bigint, b bigint, distance int")


def hamming_self_pairs(rows: DataFrame, scratch: Scratch, most: int, id_: str = "id", value: str = "phash", limit: str | None = None, usual: int | None = None) -> DataFrame:
    """(a, b, distance), a < b, of rows within min of both rows' `limit` column (or `most`, its upper bound).

    Null hashes are near to nothing. `usual`: only rows of a greater limit are compared at `most`, the
    others at this distance; the result is the same.
    """
    known = scratch.keep(rows.where(F.col(value).isNotNull()).select(F.col(id_).alias("id"), F.col(value).alias("value"), (F.col(limit) if limit else F.lit(most)).alias("most")))
    different = lambda d: scratch.keep(d.select("value").distinct().withColumn("side", F.lit(3)))
    values = different(known)
    near = near_values(values, most if usual is None else min(usual, most), both=True)
    if usual is not None and usual < most:
        near = near.unionByName(near_values(different(known.where(F.col("most") > usual)), most, both=True).where(F.col("distance") > usual))
    near = near.unionByName(values.select(F.col("value").alias("a"), F.col("value").alias("b"), F.lit(0).alias("distance")))
    left = known.select(F.col("id").alias("ia"), F.col("value").alias("a"), F.col("most").alias("ma"))
    right = known.select(F.col("id").alias("ib"), F.col("value").alias("b"), F.col("most").alias("mb"))
    pairs = near.join(left, "a").join(right, "b").where((F.col("distance") <= F.least("ma", "mb")) & ((F.col("a") != F.col("b")) | (F.col("ia") < F.col("ib"))))
    return pairs.select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"), "distance")


def hamming_links(rows: DataFrame, scratch: Scratch, most: int, id_: str = "id", value: str = "phash", limit: str | None = None, usual: int | None = None) -> DataFrame:
    """(a, b): links with the same components as `hamming_self_pairs`, fewer for exact copies.

    Rows of one value and limit are linked to the least of them only.
    """
    known = scratch.keep(rows.where(F.col(value).isNotNull()).select(F.col(id_).alias("id"), F.col(value).alias("value"), (F.col(limit) if limit else F.lit(most)).alias("most")))
    first = known.groupBy("value", "most").agg(F.min("id").alias("id"))
    first = scratch.keep(first)
    copies = known.join(first.withColumnRenamed("id", "first"), ["value", "most"]).where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    return copies.unionByName(hamming_self_pairs(first, scratch, most, "id", "value", "most", usual).select("a", "b"))


def hamming_cross_pairs(left: DataFrame, right: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """(a, b, distance, mirrored) of left rows (id, phash) and right rows (id, phash, phash_mirror) within `most` bits.

    The least of the straight and the mirrored distance; mirrored only if that is less.
    Right rows without both hashes take no part.
    """
    l = scratch.keep(left.where("phash IS NOT NULL").select("id", F.col("phash").alias("value")))  # noqa: E741
    r = scratch.keep(right.where("phash IS NOT NULL AND phash_mirror IS NOT NULL").select("id", F.explode(F.array(F.struct(F.col("phash").alias("value"), F.lit(False).alias("mirrored")), F.struct(F.col("phash_mirror").alias("value"), F.lit(True).alias("mirrored")))).alias("f")).select("id", "f.*"))
    values = scratch.keep(l.select("value", F.lit(1).alias("side")).unionByName(r.select("value", F.lit(2).alias("side"))).groupBy("value").agg(F.bit_or("side").alias("side")))
    near = near_values(values, most)
    pairs = near.join(l.select(F.col("id").alias("ia"), F.col("value").alias("a")), "a").join(r.select(F.col("id").alias("ib"), F.col("value").alias("b"), "mirrored"), "b")
    best = pairs.groupBy("ia", "ib").agg(F.min(F.struct("distance", "mirrored")).alias("x"))
    return best.select(F.col("ia").alias("a"), F.col("ib").alias("b"), "x.distance", "x.mirrored")


def _n_words(left: int, right: int, threshold: int) -> int:
    """Into how many words to cut the bits to look values up within `threshold` bits; 0 to compare all with all."""
    cost = {0: left * right * 5e-9}
    for m in range(3, 9):
        cost[m] = sum(math.comb(b, t // m) * (left * (1e-7 + right / 2**b * 1e-8) + 5e-5) for t in range(threshold + 1) for b in [len(range(t % m, 64, m))])
    return min(cost, key=cost.get)


def _together(values: np.ndarray, bits: range) -> np.ndarray:
    """The given bits of each value as a number."""
    out = np.zeros(len(values), np.int64)
    for i, b in enumerate(bits):
        out |= ((values >> np.uint64(b)) & np.uint64(1)).view(np.int64) << i
    return out


def _nearest_in_turn(left: np.ndarray, right: np.ndarray, limit: np.ndarray, threshold: int, at_once: int = 50_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in left, right values, distances) of pairs within `limit` (per left value, at most `threshold`), which sinks to the least found.

    Every turn flips one bit more of one of the words, so that after turn t all pairs within t bits
    have been seen, and a left value is done when t passes its limit. Pairs at a later limit may come too, and more than once.
    """

    def within(who: np.ndarray, y: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        np.minimum.at(limit, who, d)
        ok = d == limit[who]
        return who[ok], y[ok], d[ok]

    m = _n_words(len(left), len(right), threshold)
    if not m:
        for i in range(0, len(left), BLOCK):
            for j in range(0, len(right), BLOCK):
                d = np.bitwise_count(left[i : i + BLOCK, None] ^ right[None, j : j + BLOCK])
                p, q = np.nonzero(d <= limit[i : i + BLOCK, None])
                if len(p):
                    yield within(p + i, right[j + q], d[p, q])
        return
    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for t in range(threshold + 1):
        open_ = np.flatnonzero(limit >= t)
        if not len(open_):
            return
        bits = range(t % m, 64, m)
        if t % m not in tables:
            key = _together(right, bits)
            ends = np.cumsum(np.bincount(key, minlength=1 << len(bits)), dtype=np.int32)
            tables[t % m] = right[np.argsort(key)], np.concatenate([np.zeros(1, np.int32), ends])
        ranked, starts = tables[t % m]
        key = _together(left[open_], bits)
        order = np.argsort(key)
        at, key = open_[order], key[order]
        values = left[at]
        for flipped in combinations(range(len(bits)), t // m):
            word = key ^ sum(1 << b for b in flipped)
            lo = starts[word]
            n = starts[word + 1] - lo
            hit = np.flatnonzero(n)
            lo, n = lo[hit].astype(np.int64), n[hit]
            total, done = np.cumsum(n, dtype=np.int64), 0
            while done < len(hit):
                before = int(total[done - 1]) if done else 0
                end = max(done + 1, int(np.searchsorted(total, before + at_once, "right")))
                ends = total[done:end] - before
                of = n[done:end]
                j = np.repeat(lo[done:end] - ends + of, of)
                j += np.arange(len(j))
                d = np.repeat(values[hit[done:end]], of)
                d ^= ranked[j]
                d = np.bitwise_count(d)
                ok = np.flatnonzero(d <= threshold)
                if len(ok):
                    who = at[hit[done + np.searchsorted(ends, ok, "right")]]
                    yield within(who, ranked[j[ok]], d[ok])
                done = end


def _nearest_of_partition(batches: Iterator[pa.RecordBatch], threshold: int, at_once: int = 2_000_000, most_ties: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Rows (k, value) sorted by k: twice the cell, one more for right values, of which some at a time are held."""

    def emitted(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b", "distance"])

    def cell(runs: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        lefts, rights, held, found, size, left, limit = [], [], 0, [], 0, None, None
        for side, v in runs:
            if side == 0:
                lefts.append(v)
                continue
            if side == 1:
                rights.append(v)
                held += len(v)
                if held < at_once:
                    continue
            if left is None:
                left = np.concatenate(lefts) if lefts else np.empty(0, np.uint64)
                limit = np.full(len(left), threshold, np.uint8)
            if len(left) and held:
                for who, y, d in _nearest_in_turn(left, np.concatenate(rights), limit, threshold):
                    found.append((who, y, d))
                    size += len(who)
                    if size > most_ties:
                        found, size = least(found, limit)
                        if size > most_ties // 2:
                            yield emitted([pairs(left, *found[0])])
                            found, size = [], 0
            rights, held = [], 0
        if size:
            found, size = least(found, limit)
            yield emitted([pairs(left, *found[0])])

    def least(found: list, limit: np.ndarray) -> tuple[list, int]:
        who, y, d = (np.concatenate(x) for x in zip(*found))
        ok = d == limit[who]
        return [(who[ok], y[ok], d[ok])], int(ok.sum())

    def pairs(left: np.ndarray, who: np.ndarray, y: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return left[who].view(np.int64), y.view(np.int64), d.astype(np.int32)

    def runs() -> Iterator[tuple[int, np.ndarray]]:
        for b in batches:
            k, v = b.column("k").to_numpy(), b.column("value").to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero(np.diff(k)) + 1).tolist(), len(k)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i < j:
                    yield int(k[i]), v[i:j].copy()

    for _, of in groupby(runs(), key=lambda r: r[0] >> 1):
        yield from cell(chain(((k & 1, v) for k, v in of), [(2, np.empty(0, np.uint64))]))


def nearest_values(left: DataFrame, right: DataFrame, threshold: int, cell: int = 2_000_000) -> DataFrame:
    """(a, b, distance): for each value of left those of right at the least distance, if that is within `threshold` bits; others of right, further away, and repeated rows may be among them.

    left, right: unique `value` bigint; left from a written table, as it is read twice. Left values are dealt to cells, of about `cell` at
    most, each with all right values, which a task looks through in parts, with the least distances so far as limits.
    """
    threshold = min(threshold, 64)
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    n = max(2 * left.sparkSession.sparkContext.defaultParallelism, -(-left.count() // cell))
    own = left.select((F.pmod(F.xxhash64("value"), n) * 2).cast("int").alias("k"), "value")
    all_ = right.select(F.explode(F.sequence(F.lit(1), F.lit(2 * n - 1), F.lit(2))).alias("k"), "value")
    rows = own.unionByName(all_).repartitionById(n, F.shiftright("k", 1)).sortWithinPartitions("k")
    return rows.mapInArrow(lambda x: _nearest_of_partition(x, threshold), "a bigint, b bigint, distance int")


def nearest(left: DataFrame, pool: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """(id, distance, nearest) of left rows (id, phash) with a pool row (name, phash) within `most` bits; ties: least name."""
    l = scratch.keep(left.where("phash IS NOT NULL").select("id", F.col("phash").alias("value")))  # noqa: E741
    named = scratch.keep(pool.where("phash IS NOT NULL").groupBy(F.col("phash").alias("value")).agg(F.min("name").alias("name")))
    near = nearest_values(scratch.keep(l.select("value").distinct()), named.select("value"), most)
    best = near.join(named, F.col("b") == F.col("value")).groupBy("a").agg(F.min(F.struct("distance", "name")).alias("x"))
    return l.join(best, F.col("value") == F.col("a")).select("id", "x.distance", F.col("x.name").alias("nearest"))


def _straight_or_mirrored(value: str, straight: str, mirror: str) -> Column:
    return F.least(hamming(F.col(value), F.col(straight)), hamming(F.col(value), F.col(mirror)))


def same_name_pairs(left: DataFrame, right: DataFrame, beyond: int) -> DataFrame:
    """(a, b, distance, mirrored) of left (a, phash, base) and right (b, pb, mb, base) of one base, more than `beyond` bits apart.

    Rows are to be one per kind, that is, per hashes and base, so equal pictures don't multiply.
    """
    straight, mirror = hamming(F.col("phash"), F.col("pb")), hamming(F.col("phash"), F.col("mb"))
    pairs = left.select("a", "phash", "base").join(right.select("b", "pb", "mb", "base"), "base")
    return pairs.select("a", "b", F.least(straight, mirror).alias("distance"), (mirror < straight).alias("mirrored")).where(F.col("distance") > beyond)


def cross_split_groups(valid: DataFrame, train: DataFrame, scratch: Scratch, most: int, cap: int = 12, dismissed: DataFrame | None = None) -> DataFrame:
    """(a, b, distance, rank, extra): of each valid picture the `cap` nearest of train, and how many more there are.

    valid: image_id, base, phash; train also phash_mirror. A pair matches within `most` bits, straight or
    mirrored, or if both have one base, at any distance; pairs in `dismissed` (a, b) don't. Pictures without
    these hashes take no part. Ties: least b.

    Kinds (equal hashes, and equal hashes and base) are joined, not pictures. Of a kind of train, `cap` least
    pictures can be among the nearest, and one more for each dismissal of a valid picture.
    """
    v = scratch.keep(valid.where("phash IS NOT NULL").select("image_id", "base", "phash"))
    t = scratch.keep(train.where("phash IS NOT NULL AND phash_mirror IS NOT NULL").select("image_id", "base", F.col("phash").alias("pb"), F.col("phash_mirror").alias("mb")))
    gone, at_most = None, cap
    if dismissed is not None:
        pairs = dismissed.select("a", "b").distinct().join(v.select(F.col("image_id").alias("a"), "phash", F.col("base").alias("base_a")), "a")
        pairs = pairs.join(t.select(F.col("image_id").alias("b"), "pb", "mb", F.col("base").alias("base_b")), "b")
        near_or_same = (_straight_or_mirrored("phash", "pb", "mb") <= most) | F.coalesce(F.col("base_a") == F.col("base_b"), F.lit(False))
        gone = scratch.keep(pairs.where(near_or_same).select("a", "b"))
        per = gone.groupBy("a").agg(F.count(F.lit(1)).alias("gone"))
        at_most += per.agg(F.max("gone")).first()[0] or 0

    def first(keys: list[str]) -> DataFrame:
        return rank_in_groups(t.select(*keys, "image_id"), keys, ["image_id"], scratch, "nth").where(F.col("nth") < at_most).select(*keys, F.col("image_id").alias("b"))

    def top(rows: DataFrame, key: str, n: int) -> DataFrame:
        w = Window.partitionBy(key).orderBy("distance", "b")
        return rows.select(key, "distance", "b").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)

    hashes = t.groupBy("pb", "mb").agg(F.min("image_id").alias("b"), F.count(F.lit(1)).alias("copies"))
    of_valid = v.groupBy("phash").agg(F.min("image_id").alias("id"))
    near = hamming_cross_pairs(of_valid, hashes.select(F.col("b").alias("id"), F.col("pb").alias("phash"), F.col("mb").alias("phash_mirror")), scratch, most)
    near = scratch.keep(near.select(F.col("a").alias("id"), "b", "distance").join(hashes, "b").drop("b").join(of_valid, "id"))
    by_hash = scratch.keep(top(near.join(first(["pb", "mb"]), ["pb", "mb"]), "phash", at_most).drop("rank"))
    n_hash = near.groupBy("phash").agg(F.sum("copies").alias("n"))

    kinds = scratch.keep(v.groupBy("phash", "base").agg(F.min("image_id").alias("kind")))
    others = scratch.keep(t.groupBy("pb", "mb", "base").agg(F.min("image_id").alias("b"), F.count(F.lit(1)).alias("copies")))
    far = scratch.keep(same_name_pairs(kinds.withColumnRenamed("kind", "a"), others, most).select(F.col("a").alias("kind"), "b", "distance").join(others, "b").drop("b"))
    by_name = top(far.join(first(["pb", "mb", "base"]), ["pb", "mb", "base"]), "kind", at_most).drop("rank")
    n_name = far.groupBy("kind").agg(F.sum("copies").alias("n"))

    found = scratch.keep(by_hash.join(kinds, "phash").select("kind", "distance", "b").unionByName(by_name.select("kind", "distance", "b")))
    total = n_hash.join(kinds, "phash").select("kind", "n").unionByName(n_name.select("kind", "n")).groupBy("kind").agg(F.sum("n").alias("n"))
    members = v.join(kinds.withColumnRenamed("base", "base_"), (v["phash"] == kinds["phash"]) & v["base"].eqNullSafe(F.col("base_"))).select(F.col("image_id").alias("a"), "kind")
    if gone is None:
        rows = members.join(top(found, "kind", cap).join(total, "kind"), "kind")
    else:
        left = members.join(found, "kind").join(gone, ["a", "b"], "left_anti")
        counts = members.join(total, "kind").join(per, "a", "left").select("a", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"))
        rows = top(left, "a", cap).join(counts, "a")
    return rows.select("a", "b", "distance", "rank", F.greatest(F.col("n") - cap, F.lit(0)).alias("extra"))


__all__ = ["hamming", "hamming_self_pairs", "hamming_links", "hamming_cross_pairs", "nearest", "nearest_values", "near_values", "same_name_pairs", "cross_split_groups"]
