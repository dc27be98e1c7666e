"""Views of the test tables that several problems share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import names as N
from frameloom.operators.images import current_hashes, current_images
from frameloom.sources.tables import table


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, dataset, split, clip, frame of the images that lie in a clip."""
    index = N.with_names(table(spark, sf_dir, "image_index"))
    return current_images(index, clip=F.col("__clip"), frame=F.col("__frame")).where("clip IS NOT NULL AND frame IS NOT NULL")


def related(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, dataset, split, clip (null for none), base of all images."""
    index = N.with_names(table(spark, sf_dir, "image_index"))
    return current_images(index, clip=F.col("__clip"), base=F.col("__base"))


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_hashes(table(spark, sf_dir, "hashes"))
