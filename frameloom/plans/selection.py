"""The whole candidate selection: cheap rules, thinning of clips, duplicates, variety; every rejected picture with its reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.operators import curate as C
from frameloom.operators.graph import connected_components
from frameloom.operators.sequences import thin_clips
from frameloom.operators.similarity import hamming_links
from frameloom.params import DEFAULTS, Params
from frameloom.plans.scratch import Scratch


def select(images: DataFrame, boxes: DataFrame, sized: DataFrame, hashes: DataFrame, cat: DataFrame, scratch: Scratch, params: Params = DEFAULTS) -> DataFrame:
    """images (image_id, dataset, split, clip, frame, width, height) with excluded, stage and reason.

    sized: boxes with pixel corners b. Stages work on what the ones before left over.
    """
    one = cat.groupBy("dataset").agg(*(F.max(c).alias(c) for c in ("variety_min", "closeup", "faraway", "phash_max")))
    images = scratch.keep(images.join(hashes.select("image_id", "phash"), "image_id", "left"))
    cheap = C.cheap_cascade(images, boxes, one, params)
    rejected = scratch.keep(cheap.where("reason IS NOT NULL").select("image_id", F.lit("cheap").alias("stage"), "reason"))
    left = images.join(rejected, "image_id", "left_anti")

    thinned = scratch.keep(thin_clips(left.where("clip IS NOT NULL"), params).where("NOT keep"))
    temporal = thinned.select("image_id", F.lit("temporal").alias("stage"), F.concat(F.lit("redundant frame, kept is "), F.col("kept_by")).alias("reason"))
    left = scratch.keep(left.join(thinned, "image_id", "left_anti"))

    most = C.effective(one, params).select("dataset", F.col("phash_max").alias("most"))
    limited = left.join(most, "dataset", "left").select(F.col("image_id").alias("id"), "phash", F.coalesce("most", F.lit(params.phash_distance)).alias("most"))
    comp = connected_components(hamming_links(limited, scratch, C.widest_distance(one, params), limit="most", usual=params.phash_distance), scratch)
    n = boxes.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    ranked = scratch.keep(comp.withColumnRenamed("id", "image_id").join(left.select("image_id", "dataset", "split"), "image_id").join(n, "image_id", "left"))
    keeper = ranked.groupBy("component").agg(F.min(F.struct(-F.coalesce("n", F.lit(0)), F.col("dataset"), F.col("split"), F.col("image_id"))).alias("k"))
    dedup = ranked.join(keeper, "component").where("image_id <> k.image_id").select("image_id", F.lit("dedup").alias("stage"), F.concat(F.lit("close copy of "), F.col("k.image_id")).alias("reason"))
    dedup = scratch.keep(dedup)
    left = left.join(dedup, "image_id", "left_anti")

    other = boxes.where(F.col("class_id") != params.target_class).groupBy("image_id").agg(F.count(F.lit(1)).alias("others"))
    wanted = left.join(other, "image_id", "left").join(C.effective(one, params).select("dataset", "variety_min"), "dataset", "left").withColumns({"others": F.coalesce("others", F.lit(0)), "variety_min": F.coalesce("variety_min", F.lit(params.variety_min_instances))})
    riders = C.rider_pairs(sized.where(F.col("class_id") == params.target_class), sized.where(F.col("class_id") == params.person_class), params).select("image_id", F.lit(True).alias("rider")).distinct()
    why = F.when(F.col("others") < F.col("variety_min"), F.concat_ws(" ", "others", F.lit("objects found,"), "variety_min", F.lit("wanted"))).when(F.col("rider"), "box covers the rider too")
    variety = wanted.join(riders, "image_id", "left").withColumn("reason", why).where("reason IS NOT NULL").select("image_id", F.lit("variety").alias("stage"), "reason")
    return C.last_marking(images.drop("phash"), rejected, temporal, dedup, variety)
