"""Problem 6: same or near-same records across splits.

An image's hash is read as five words of 13 or 12 bits. Two hashes that differ in at most
four bits agree in at least one word, so the words of the evaluation records are
partitioned by (position, word), the training records' words are scanned against them,
and every hit is verified on all 64 bits (`operators/similarity.py` `near_values`, which also cuts crowded
words on both sides). Containment is the share of an evaluation record's words that the training record has too.
Export marks are a further token, matched exactly.

Copies count once: records of equal hashes are one kind, kinds are matched, and pairs of
records are only made where they are asked for. Counts come from the kinds' sizes.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.operators.similarity import near_values, words
from frameloom.plans.scratch import Scratch

NEAR = 4
STRAIGHT, MIRRORED = 1, 2


class Overlaps(NamedTuple):
    """members: id, train, mark, kind (its hashes; null without any) and the records' other columns; kinds: kind, n_train,
    n_eval; near: kt, ke, distance, containment of near kinds of training and of evaluation records."""

    members: DataFrame
    kinds: DataFrame
    near: DataFrame


def _containment(a: str, b: str) -> F.Column:
    """Share of words that two hashes have in common."""
    d = F.col(a).bitwiseXOR(F.col(b))
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    cut = words(NEAR)
    return reduce(add, ((d.bitwiseAND(F.lit(signed(m)).cast("bigint")) == 0).cast("int") for m in cut)) / F.lit(float(len(cut)))


def match_kinds(records: DataFrame, scratch: Scratch) -> Overlaps:
    """Kinds of records (id, split, phash, phash_mirror, mark, further columns) and which of them are near. See `cross_split_overlaps`."""
    taken = ("id", "split", "phash", "phash_mirror", "mark")
    others = [c for c in records.columns if c not in (*taken, "train", "kind")]
    known = F.col("phash").isNotNull().cast("int") + F.col("phash_mirror").isNotNull().cast("int") * 2
    kind = F.when(known > 0, F.struct(F.coalesce("phash", F.lit(0)).alias("h"), F.coalesce("phash_mirror", F.lit(0)).alias("m"), known.alias("f")))
    members = scratch.keep(records.where("id IS NOT NULL AND split IN ('train', 'valid', 'test')").select("id", "split", *others, (F.col("split") == "train").alias("train"), F.unhex("mark").alias("mark"), kind.alias("kind")))
    kinds = scratch.keep(members.where("kind IS NOT NULL").groupBy("kind").agg(F.count_if("train").alias("n_train"), F.count_if(~F.col("train")).alias("n_eval")))
    face = lambda c, face: F.when(F.col("kind.f").bitwiseAND(face) > 0, F.struct(F.col(f"kind.{c}").alias("value"), F.lit(face).alias("face")))
    faces = kinds.select("kind", "n_train", "n_eval", F.explode(F.array_compact(F.array(face("h", STRAIGHT), face("m", MIRRORED)))).alias("x")).select("kind", "n_train", "n_eval", "x.*")
    side = F.when(F.col("n_train") > 0, 1).otherwise(0) + F.when(F.col("n_eval") > 0, 2).otherwise(0)
    values = scratch.keep(faces.groupBy("value").agg(F.bit_or(side).alias("side")))
    close = scratch.keep(near_values(values, NEAR).withColumn("containment", _containment("a", "b")))
    t = faces.where("n_train > 0").select(F.col("kind").alias("kt"), F.col("value").alias("a"), F.col("face").alias("ft"))
    e = faces.where("n_eval > 0").select(F.col("kind").alias("ke"), F.col("value").alias("b"), F.col("face").alias("fe"))
    met = close.join(t, "a").join(e, "b").where(~((F.col("ft") == MIRRORED) & (F.col("fe") == MIRRORED)))
    near = scratch.keep(met.groupBy("kt", "ke").agg(F.min("distance").alias("distance"), F.max("containment").alias("containment")))
    return Overlaps(members, kinds, near)


def cross_split_overlaps(records: DataFrame, scratch: Scratch) -> DataFrame:
    """All pairs of a training and an evaluation record that are the same or nearly so.

    `records`: id (unique), split (train, valid, test; others take no part), phash,
    phash_mirror, mark. Result: id_train, id_eval, distance (least number of unlike bits,
    straight or with one of the two mirrored; null if only the marks agree), containment
    (of the hash words, 0 likewise), same_mark. A pair counts if the marks agree, or at
    most four bits differ between the two phash, or between one's phash and the other's
    phash_mirror. A null hash or mark compares with nothing; rows of null id are left out.
    Empty tables give an empty result; further columns are ignored.
    """
    members, _, near = match_kinds(records.select("id", "split", "phash", "phash_mirror", "mark"), scratch)
    t = members.where("train").select(F.col("id").alias("id_train"), F.col("mark").alias("mark_t"), F.col("kind").alias("kt"))
    e = members.where("NOT train").select(F.col("id").alias("id_eval"), F.col("mark").alias("mark_e"), F.col("kind").alias("ke"))
    same = F.coalesce(F.col("mark_t") == F.col("mark_e"), F.lit(False)).alias("same_mark")
    by_hash = near.join(t, "kt").join(e, "ke").select("id_train", "id_eval", "distance", "containment", same)
    by_mark = t.join(e, F.col("mark_t") == F.col("mark_e")).join(near, ["kt", "ke"], "left_anti")
    return by_hash.unionByName(by_mark.select("id_train", "id_eval", F.lit(None).cast("int").alias("distance"), F.lit(0.0).alias("containment"), F.lit(True).alias("same_mark")))


def overlap_counts(records: DataFrame, scratch: Scratch, by: list[str]) -> DataFrame:
    """Per split and `by` of the evaluation records: n_images, n_overlapping, n_pairs, n_by_hash, n_by_mark.

    The pairs of `cross_split_overlaps`, counted without making them: a record's pairs are the
    training records of the kinds near its own, those of its mark, less those of both.
    """
    members, kinds, near = match_kinds(records, scratch)
    hashed = near.join(kinds.select(F.col("kind").alias("kt"), "n_train"), "kt").groupBy(F.col("ke").alias("kind")).agg(F.sum("n_train").alias("by_hash"))
    marked = members.where("mark IS NOT NULL")
    marks = marked.where("train").groupBy("mark").agg(F.count(F.lit(1)).alias("by_mark"))
    of = marked.where("kind IS NOT NULL").groupBy("mark", "kind").agg(F.count_if("train").alias("nt"), F.count_if(~F.col("train")).alias("ne"))
    t, e = of.where("nt > 0").select("mark", F.col("kind").alias("kt"), "nt"), of.where("ne > 0").select("mark", F.col("kind").alias("ke"))
    both = t.join(e, "mark").join(near.select("kt", "ke"), ["kt", "ke"]).groupBy("mark", F.col("ke").alias("kind")).agg(F.sum("nt").alias("both_"))
    j = members.where("NOT train").join(hashed, "kind", "left").join(marks, "mark", "left").join(both, ["mark", "kind"], "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    pairs = n("by_hash") + n("by_mark") - n("both_")
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
    return j.groupBy("split", *by).agg(F.count(F.lit(1)).alias("n_images"), F.count_if(pairs > 0).alias("n_overlapping"), total(pairs, "n_pairs"), total(n("by_hash"), "n_by_hash"), total(n("by_mark"), "n_by_mark"))
