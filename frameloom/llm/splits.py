"""Problem 7: splits that keep related records together.

Components by parallel hooking and shortcutting over a parent table: in each round every
record's parent is replaced by its grandparent (shortcutting), and the ends of every link
hook their parent, and its parent, under the least grandparent seen across the link
(hooking); the links are then rewritten to grandparents and those inside one tree are
dropped, so tables shrink from round to round.

Components are then given to splits by size: sizes and how often each occurs (for n
records fewer than sqrt(2n) sizes) go to the driver, where bitsets of reachable subset
sums choose how many components of each size make a split's total closest to its target.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.plans.ranks import rank_in_groups
from frameloom.plans.scratch import Scratch


def hook_and_shortcut(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(v, p): of every record with a link to another, the least id p of its component.

    Links are undirected; null ends, links to itself and repeated links are without
    effect. An empty table gives an empty result; other columns are ignored.
    """
    edges = scratch.keep(
        links.select(F.least(a, b).cast("bigint").alias("a"), F.greatest(a, b).cast("bigint").alias("b"))
        .where(links[a].isNotNull() & links[b].isNotNull() & (links[a] != links[b])).distinct()
    )
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("a").alias("p")), F.struct(F.col("b").alias("v"), F.col("a").alias("p")))).alias("e")).select("e.*")
    parents = scratch.keep(ends.groupBy("v").agg(F.min("p").alias("p")))  # each record hooked to its least neighbour, if less
    for _ in range(most_rounds):
        up = parents.select(F.col("v").alias("p"), F.col("p").alias("g"))
        grand = scratch.keep(parents.join(up, "p").select("v", "p", "g"))
        of = lambda end: grand.select(F.col("v").alias(end), F.col("p").alias(f"p{end}"), F.col("g").alias(f"g{end}"))
        across = scratch.keep(edges.join(of("a"), "a").join(of("b"), "b").where("ga <> gb").select("a", "b", "pa", "pb", "ga", "gb"))
        done = across.isEmpty() and grand.where("p <> g").isEmpty()
        hooks = across.select(F.explode(F.array(*(F.struct(F.col(x).alias("v"), F.least("ga", "gb").alias("p")) for x in ("a", "b", "pa", "pb", "ga", "gb")))).alias("e")).select("e.*")
        old_parents, old_edges = parents, edges
        parents = scratch.keep(grand.select("v", F.col("g").alias("p")).unionByName(hooks).groupBy("v").agg(F.min("p").alias("p")))
        edges = scratch.keep(across.select(F.least("ga", "gb").alias("a"), F.greatest("ga", "gb").alias("b")).distinct())
        scratch.drop(old_parents, old_edges, grand, across)
        if done:
            return parents
    raise RuntimeError(f"no stable parents after {most_rounds} rounds")


def components(records: DataFrame, scratch: Scratch, entity: list[str], alias: list[str]) -> DataFrame:
    """records (id, ...) with group_id: the least id among all related records.

    Two records are related if they agree in all `entity` columns (none of them null) or
    in all `alias` columns, directly or over further records; a record with a null in
    both is on its own. Records are first gathered into entities, so links only run between
    entities that share an alias: from each to the least entity of that alias.
    A single entity or alias may hold any share of the rows: both are aggregated on the map
    side before they are joined. ids must be unique and not null.
    """
    has = lambda cols: reduce(and_, (F.col(c).isNotNull() for c in cols))
    own = F.struct(F.lit(2).alias("kind"), F.col("id").alias("k1"), F.lit(0).cast("bigint").alias("k2"))
    key = lambda cols, kind: F.struct(F.lit(kind).alias("kind"), F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit("second"), *reversed(cols)).alias("k2"))
    by_alias = F.when(has(alias), key(alias, 1)).otherwise(own)
    keyed = records.drop("group_id").withColumns({"__e": F.when(has(entity), key(entity, 0)).otherwise(by_alias), "__a": by_alias})
    kept = scratch.keep(keyed.drop(*{*entity, *alias} - {"id"}))
    pairs = scratch.keep(kept.groupBy("__e", "__a").agg(F.min("id").alias("least")))
    entities = pairs.groupBy("__e").agg(F.min("least").alias("node"))
    named = scratch.keep(pairs.join(entities, "__e").select("__e", "__a", "node"))
    shared = named.where("__a.kind = 1").groupBy("__a").agg(F.min("node").alias("centre"), F.max("node").alias("far")).where("centre <> far").select("__a", "centre")
    links = named.join(shared, "__a").where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b"))
    parents = hook_and_shortcut(links, scratch)
    roots = named.select("__e", "node").distinct().join(parents, F.col("node") == F.col("v"), "left").select("__e", F.coalesce("p", "node").alias("group_id"))
    return kept.join(roots, "__e").drop("__e", "__a")


def _with(bits: int, size: int, count: int, limit: int) -> int:
    """Sums reachable with up to `count` components of a size more."""
    step = 1
    while count > 0:  # 1, 2, 4 ... copies at a time
        take = min(step, count)
        bits |= (bits << (size * take)) & limit
        count, step = count - take, step * 2
    return bits


def _closest(groups: list[tuple[int, int]], target: int) -> list[int]:
    """How many components of each (size, count) to take for a total closest to target (ties: the smaller total).

    Bit s of a bitset is set if some of the components so far have s records together. Sums over twice
    the target are further off than none and are cut. Of k bitsets every sqrt(k)-th is kept, those
    between are made again on the way back; no further size is looked at once the target is reached.
    """
    limit, every = (1 << (2 * target + 1)) - 1, math.isqrt(len(groups)) + 1
    bits, kept, n = 1, [1], 0
    while n < len(groups) and not bits >> target & 1:
        bits = _with(bits, *groups[n], limit)
        n += 1
        if n % every == 0:
            kept.append(bits)
    below = (bits & ((1 << (target + 1)) - 1)).bit_length() - 1
    above = bits >> (target + 1)
    best = below
    if above:
        over = target + 1 + (above & -above).bit_length() - 1
        best = over if over - target < target - below else below
    taken = [0] * len(groups)
    for first in range((n - 1) // every * every, -1, -every) if n else ():
        steps = [kept[first // every]]
        for i in range(first, min(first + every, n) - 1):
            steps.append(_with(steps[-1], *groups[i], limit))
        for i in range(first + len(steps) - 1, first - 1, -1):
            size, count = groups[i]
            while not steps[i - first] >> best & 1:
                best, taken[i] = best - size, taken[i] + 1
            assert taken[i] <= count and best >= 0
    return taken


def choose_totals(sizes: dict[int, int], shares: dict[str, float]) -> dict[str, dict[int, int]]:
    """For each split, how many components of each size it gets.

    Of each size every split first gets the whole part of its share, so that splits are
    alike in what they hold; what is left of each size is dealt by subset sums, the split of
    least share first, and the last split takes the rest. Where that leaves a split off its
    target, the problem is solved again without the first step and the better of the two kept.
    """
    total, names = sum(s * n for s, n in sizes.items()), sorted(shares, key=lambda k: (shares[k], k))
    weight = sum(shares.values())
    if weight <= 0 or min(shares.values()) < 0:
        raise ValueError("shares must be positive")
    target, given = {}, 0
    for k in names[:-1]:
        target[k] = int(round(total * shares[k] / weight))
        given += target[k]
    target[names[-1]] = total - given

    def solve(dealt: bool) -> tuple[int, dict[str, dict[int, int]]]:
        left, got = dict(sizes), {k: dict.fromkeys(sizes, 0) for k in names}
        if dealt:
            for s, n in sizes.items():
                for k in names:
                    got[k][s] = int(n * shares[k] / weight)
                    left[s] -= got[k][s]
        off = 0
        for k in names[:-1]:
            groups = [(s, n) for s, n in sorted(left.items(), reverse=True) if n]
            want = max(0, target[k] - sum(s * n for s, n in got[k].items()))
            for (s, _), t in zip(groups, _closest(groups, want)):
                got[k][s] += t
                left[s] -= t
            off += abs(target[k] - sum(s * n for s, n in got[k].items()))
        for s, n in left.items():
            got[names[-1]][s] += n
        return off, got

    best = solve(True)
    if best[0]:
        best = min(best, solve(False), key=lambda x: x[0])
    return best[1]


def assign_splits(grouped: DataFrame, scratch: Scratch, shares: dict[str, float], seed: int = 42) -> DataFrame:
    """grouped (id, group_id, ...) with new_split; all records of a group get the same.

    Which components of a size go to which split is decided by a seeded hash of group_id.
    An empty table gives an empty result.
    """
    grouped = grouped.drop("group_size", "new_split")
    sized = grouped.groupBy("group_id").agg(F.count(F.lit(1)).alias("size")).withColumn("rnd", F.xxhash64(F.lit(seed), "group_id"))
    ranked = rank_in_groups(sized, ["size"], ["rnd", "group_id"], scratch, "nth")
    ranked = scratch.keep(ranked.select("group_id", "size", "nth"))
    counts = {r["size"]: r["n"] for r in ranked.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # fewer than sqrt(2 n) rows
    spark = grouped.sparkSession
    bounds, chosen = [], choose_totals(counts, shares)
    for s in counts:
        at = 0
        for k in sorted(shares):
            n = chosen[k][s]
            if n:
                bounds.append((s, at, at + n, k))
            at += n
    # Fewer than sqrt(2 n) sizes, a row for each split that gets some.
    table = spark.createDataFrame(bounds, "of_size bigint, lo bigint, hi bigint, new_split string")
    placed = ranked.join(F.broadcast(table), (F.col("size") == F.col("of_size")) & (F.col("nth") >= F.col("lo")) & (F.col("nth") < F.col("hi"))).select("group_id", F.col("size").alias("group_size"), "new_split")
    return grouped.join(placed, "group_id")


def scattered(grouped: DataFrame, split: str = "split") -> DataFrame:
    """The rows of groups whose records lie in more than one split. Null splits count as none."""
    torn = grouped.groupBy("group_id").agg(F.min(split).alias("__lo"), F.max(split).alias("__hi")).where("__lo <> __hi").select("group_id")
    return grouped.join(torn, "group_id", "left_semi")
