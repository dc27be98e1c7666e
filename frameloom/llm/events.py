"""Problem 1: runs of consecutive events that show the same.

Adjacent agglomeration. Every event begins as a run of its own in its entity's linked
list; a priority queue holds the links between neighbouring runs, most similar first,
and the two runs at its head are merged until no link meets the limits. Runs are
compared at the events that meet at their border, so a run of any length may grow and
a merge never changes another link.

Entities may be of any size: events are range-partitioned by (entity, order), each task
agglomerates its piece batch by batch with one open run carried over, and the two
outermost runs of every partition, so at most twice as many rows as partitions, are
agglomerated once more across the borders.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.plans.scratch import Scratch

RUN = "e1 bigint, e2 bigint, start_id bigint, start_at bigint, start_hash bigint, end_id bigint, end_at bigint, end_hash bigint, n bigint, first boolean, last boolean"


def _agglomerate(links: np.ndarray, distance: np.ndarray, counts: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Heads, tails and sizes of the runs left of len(counts) runs in a row.

    links[i] says that runs i and i+1 may merge, distance[i] how unlike they are there.
    """
    n = len(counts)
    tail_of, head_of, size = list(range(n)), list(range(n)), counts.tolist()
    at = np.flatnonzero(links)
    queue = ((distance[at].astype(np.int64) << 40) | at).tolist()
    heapq.heapify(queue)
    merged = bytearray(n)
    while queue:
        i = heapq.heappop(queue) & ((1 << 40) - 1)
        head, tail = head_of[i], tail_of[i + 1]
        head_of[tail], tail_of[head] = head, tail
        size[head] += size[i + 1]
        merged[i + 1] = 1
    heads = [i for i in range(n) if not merged[i]]
    return heads, [tail_of[i] for i in heads], [size[i] for i in heads]


def _link(e1, e2, end_at, end_hash, known_end, start_at, start_hash, known_start, max_bits: int, max_gap: int) -> tuple[np.ndarray, np.ndarray]:
    """For neighbours i, i+1: whether they may merge, and their distance in bits."""
    distance = np.bitwise_count((end_hash[:-1] ^ start_hash[1:]).view(np.uint64))
    ok = (e1[:-1] == e1[1:]) & (e2[:-1] == e2[1:]) & known_end[:-1] & known_start[1:]
    return ok & (distance < max_bits) & (np.abs(start_at[1:] - end_at[:-1]) <= max_gap), distance


def _runs_of_partition(batches: Iterator[pa.RecordBatch], max_bits: int, max_gap: int, least: int) -> Iterator[pa.RecordBatch]:
    """Runs of a sorted partition; of those shorter than `least` only the outermost two."""
    names = [x.split()[0] for x in RUN.split(", ")]
    kinds = [pa.bool_() if x.endswith("boolean") else pa.int64() for x in RUN.split(", ")]

    def out(cols: dict, keep: np.ndarray) -> pa.RecordBatch:
        arrays = []
        for name, kind in zip(names, kinds):
            mask = ~cols[f"known_{name[:-5]}"][keep] if name.endswith("_hash") else None
            arrays.append(pa.array(cols[name][keep], kind, mask=mask))
        return pa.RecordBatch.from_arrays(arrays, names)

    held: dict | None = None  # the last run so far
    begun = False
    for b in batches:
        if not b.num_rows:
            continue
        e1, e2, at, ids = (b.column(c).to_numpy(zero_copy_only=False) for c in ("e1", "e2", "at", "id"))
        known = ~b.column("hash").is_null().to_numpy(zero_copy_only=False)
        h = b.column("hash").fill_null(0).to_numpy(zero_copy_only=False)
        runs = {"e1": e1, "e2": e2, "start_id": ids, "start_at": at, "start_hash": h, "known_start": known, "end_id": ids, "end_at": at, "end_hash": h, "known_end": known, "n": np.ones(len(ids), np.int64)}
        if held is not None:
            runs = {k: np.concatenate([held[k], v]) for k, v in runs.items()}
        links, distance = _link(runs["e1"], runs["e2"], runs["end_at"], runs["end_hash"], runs["known_end"], runs["start_at"], runs["start_hash"], runs["known_start"], max_bits, max_gap)
        heads, tails, sizes = _agglomerate(links, distance, runs["n"])
        done = {k: v[tails] if k in ("end_id", "end_at", "end_hash", "known_end") else v[heads] for k, v in runs.items()}
        done["n"] = np.array(sizes, np.int64)
        held = {k: v[-1:] for k, v in done.items()}
        done["first"] = np.zeros(len(heads), bool)
        done["first"][0] = not begun
        done["last"] = np.zeros(len(heads), bool)
        if len(heads) > 1:
            keep = np.flatnonzero((done["n"][:-1] >= least) | done["first"][:-1])
            begun = True
            if len(keep):
                yield out(done, keep)
    if held is not None:
        held["first"], held["last"] = np.array([not begun]), np.array([True])
        yield out(held, np.array([0]))


def collapse_runs(events: DataFrame, scratch: Scratch, entity: list[str], order: str, event_id: str, signature: str, max_bits: int = 10, max_gap: int = 60, least: int = 1) -> DataFrame:
    """One row per maximal run of neighbours that differ in fewer than `max_bits` bits and at most `max_gap` in `order`.

    Result: e1, e2 (a 128-bit key of the entity), start_id, start_at, end_id, end_at, n
    (events), span (end_at - start_at + 1). Only runs of `least` events or more.
    Ties in `order` go by event_id; repeated rows are events of their own (make them
    unique before). A null signature compares with nothing, so it is a run of one; rows
    with a null entity column, order or event_id are in no sequence and left out. An
    empty table gives an empty result; columns other than those named are ignored.
    """
    known = events.dropna(subset=[*entity, order, event_id])
    keyed = known.select(
        F.xxhash64(*entity).alias("e1"),
        F.xxhash64(F.lit("second"), *reversed(entity)).alias("e2"),
        F.col(order).cast("bigint").alias("at"),
        F.col(event_id).cast("bigint").alias("id"),
        F.col(signature).cast("bigint").alias("hash"),
    )
    # Written first, as ranges are found by a sample of the rows, which would run what makes them twice.
    sorted_ = scratch.keep(keyed).repartitionByRange("e1", "e2", "at", "id").sortWithinPartitions("e1", "e2", "at", "id")
    runs = scratch.keep(sorted_.mapInArrow(lambda x: _runs_of_partition(x, max_bits, max_gap, least), RUN))
    outer = runs.where("first OR last")  # at most two rows per partition
    w = Window.orderBy("e1", "e2", "start_at", "start_id")
    before = {c: F.lag(c).over(w) for c in ("e1", "e2", "end_at", "end_hash", "last")}
    joins = (
        before["last"] & F.col("first") & (before["e1"] == F.col("e1")) & (before["e2"] == F.col("e2"))
        & (F.bit_count(before["end_hash"].bitwiseXOR(F.col("start_hash"))) < max_bits) & (F.col("start_at") - before["end_at"] <= max_gap)
    )
    marked = outer.withColumn("new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    key = F.struct("start_at", "start_id", "first")
    stitched = marked.groupBy("e1", "e2", "run").agg(
        F.min_by("start_id", key).alias("start_id"), F.min("start_at").alias("start_at"), F.max_by("end_id", key).alias("end_id"), F.max("end_at").alias("end_at"), F.sum("n").alias("n")
    )
    columns = ["e1", "e2", "start_id", "start_at", "end_id", "end_at", "n"]
    whole = runs.where("NOT (first OR last)").select(*columns).unionByName(stitched.select(*columns))
    return whole.where(F.col("n") >= least).withColumn("span", F.col("end_at") - F.col("start_at") + 1)
