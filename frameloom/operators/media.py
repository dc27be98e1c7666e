"""Leaves that need pixels or a model: interfaces to plug them in, and the relational part around them.

A model is a factory called once per Python worker, giving a function from a list of
encoded pictures to a list of detections (class, confidence, x1, y1, x2, y2) per picture.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Detector = Callable[[list[bytes]], list[list[tuple]]]
Hasher = Callable[[bytes], tuple[int, int] | None]
DETECTED = "image_id bigint, det_ord int, class_id int, conf double, x1 double, y1 double, x2 double, y2 double"


def detect(images: DataFrame, factory: Callable[[], Detector], batch: int = 16) -> DataFrame:
    """Detections of pictures (image_id, content), `batch` pictures at a time."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for part in parts:
            for at in range(0, len(part), batch):
                some = part.iloc[at : at + batch]
                rows = [(int(i), n, int(c), float(p), *map(float, box)) for i, found in zip(some["image_id"], model([bytes(x) for x in some["content"]])) for n, (c, p, *box) in enumerate(found)]
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in DETECTED.split(", ")])

    return images.select("image_id", "content").mapInPandas(run, DETECTED)


def hashed(images: DataFrame, factory: Callable[[], Hasher]) -> DataFrame:
    """(image_id, phash, phash_mirror) of pictures; null for those the hasher can't read."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = factory()
        for part in parts:
            got = [hasher(bytes(c)) or (None, None) for c in part["content"]]
            yield pd.DataFrame({"image_id": part["image_id"], "phash": pd.array([g[0] for g in got], "Int64"), "phash_mirror": pd.array([g[1] for g in got], "Int64")})

    return images.select("image_id", "content").mapInPandas(run, "image_id bigint, phash bigint, phash_mirror bigint")


def enough_detections(images: DataFrame, detections: DataFrame, least: Column, conf: float) -> DataFrame:
    """images with n_found of confident detections and `enough`."""
    n = detections.where(F.col("conf") >= conf).groupBy("image_id").agg(F.count(F.lit(1)).alias("n_found"))
    return images.join(n, "image_id", "left").withColumn("n_found", F.coalesce("n_found", F.lit(0))).withColumn("enough", F.col("n_found") >= least)


def wedge(dark_first: Column, dark_last: Column, length: Column) -> Column:
    """Whether rows of an edge look like the padding of a turned picture: arrays of dark runs at both ends of sampled rows.

    A row counts if its dark run is 15 to 95 percent of its length; false for fewer than five
    such rows; true if the runs change along the edge, that is, fewer than 70 percent are alike.
    """
    both = F.zip_with(dark_first, dark_last, lambda a, b: F.greatest(a, b).cast("double") / length)
    usable = F.filter(both, lambda x: (x >= 0.15) & (x <= 0.95))
    middle = F.element_at(F.array_sort(usable), F.greatest(F.floor(F.size(usable) / 2).cast("int"), F.lit(1)))
    alike = F.size(F.filter(usable, lambda x: F.abs(x - middle) < 0.02))
    return F.when(F.size(usable) < 5, False).otherwise(alike / F.size(usable) < 0.7)


def sampled_frames(videos: DataFrame, every: int) -> DataFrame:
    """(video, idx) of every `every`-th frame."""
    return videos.where("n_frames > 0").select("video", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_frames") - 1, F.lit(every).cast("bigint"))).alias("idx"))


def sheet_positions(rank: Column, columns: int) -> tuple[Column, Column]:
    """Row and column of the rank-th picture (from 0) of a contact sheet."""
    return F.floor(rank / columns).cast("int"), (rank % columns).cast("int")


def sheet_cells(n: Column, columns: int) -> Column:
    """Cells of a sheet of n pictures, its last row filled up with blanks."""
    return (F.ceil(n / columns) * columns).cast("bigint")
