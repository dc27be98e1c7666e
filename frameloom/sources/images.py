"""Listings of picture files and whole datasets on a file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import names as N
from frameloom.sources.labels import label_lines, label_path, parse_boxes

PICTURES = "*.{jpg,jpeg,png,JPG,JPEG,PNG}"


def list_images(spark: SparkSession, root: str | list[str], must_exist: bool = False) -> DataFrame:
    """(path, size, mtime) of picture files under one or more folders; the files' bytes aren't read.

    must_exist: no picture at all is an error.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", PICTURES).load(root)
    out = files.select("path", F.col("length").alias("size"), F.col("modificationTime").cast("double").alias("mtime"))
    if must_exist and out.isEmpty():
        raise FileNotFoundError(f"no pictures under {root}")
    return out


def image_bytes(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """(path, content) of picture files, for models and hashers."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", PICTURES).load(root).select("path", "content")


def scan_dataset(spark: SparkSession, root: str, mode: str = "lenient") -> tuple[DataFrame, DataFrame]:
    """(images, boxes) of `<root>/<dataset>/<split>/images/<file>` with labels beside them in `labels`.

    images: path, dataset, split, file, size, mtime, has_label (a missing label file isn't an empty
    one). boxes: path of the picture and the columns of parse_boxes.
    """
    same = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    pictures = list_images(spark, root).withColumn("path", same(F.col("path"))).withColumn("label", label_path(F.col("path")))
    lines = label_lines(spark, root).withColumn("path", same(F.col("path")))
    there = lines.select(F.col("path").alias("label"), F.lit(True).alias("__there")).distinct()
    images = pictures.join(there, "label", "left").select("path", N.path_dataset(F.col("path")).alias("dataset"), N.path_split(F.col("path")).alias("split"), N.path_file(F.col("path")).alias("file"), "size", "mtime", F.col("__there").isNotNull().alias("has_label"))
    boxes = parse_boxes(lines.withColumnRenamed("path", "label"), ["label"], mode)
    return images, pictures.select("path", "label").join(boxes, "label").drop("label")


def sha256(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of files."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))
