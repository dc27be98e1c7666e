"""The current state of the image index and of the hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameloom.functions import names as N


def current_images(index: DataFrame, **values: Column) -> DataFrame:
    """One row per image_id: of the row of latest indexed_at, dataset, split and the given values.

    Dataset and split are read from image_path, where they are spelled properly; where the
    path is null or has other levels, from their columns (trimmed, letter case ignored).
    Values are computed before the shuffle, so only what is asked for is moved; the maximum
    is combined on the map side, so an image indexed any number of times is no hot key.
    Rows of equal indexed_at: the one with the greatest values. Null image_ids are left
    out; a null indexed_at counts as earliest. Other columns are ignored.
    """
    tail = F.col("__levels")
    got = {
        "dataset": F.coalesce(N.level_dataset(tail), F.lower(F.trim(F.col("dataset_id")))),
        "split": F.coalesce(N.split_spelling(N.level_split(tail)), N.split_spelling(F.col("split"))),
        **values,
    }
    rows = index.where("image_id IS NOT NULL").withColumn("__levels", N.levels(F.col("image_path"))).select(F.col("image_id").cast("bigint"), F.struct(F.col("indexed_at"), *(v.alias(k) for k, v in got.items())).alias("__row"))
    return rows.groupBy("image_id").agg(F.max("__row").alias("__row")).select("image_id", *(F.col(f"__row.{k}").alias(k) for k in got))


def current_hashes(hashes: DataFrame) -> DataFrame:
    """One row per image_id with phash and phash_mirror; of several differing rows the greatest known values."""
    return hashes.where("image_id IS NOT NULL").groupBy(F.col("image_id").cast("bigint").alias("image_id")).agg(F.max("phash").alias("phash"), F.max("phash_mirror").alias("phash_mirror"))
