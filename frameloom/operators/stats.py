"""Counts, shares, quantiles and reports."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.plans.ranks import running_totals
from frameloom.plans.scratch import Scratch


def split_summary(images: DataFrame, boxes: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Per split and in TOTAL: images, background, missing, empty, instances, max_instances, mean_instances.

    `images` (split, image_id) is a bag: an image in two splits counts twice in TOTAL. `labels`
    (image_id): pictures with a label file; without it none is missing.
    """
    n = boxes.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    j = images.select("split", "image_id").join(n, "image_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    j = j.join(labels.select("image_id", F.lit(True).alias("there")).distinct(), "image_id", "left") if labels is not None else j.withColumn("there", F.lit(True))
    none = F.col("n") == 0
    return j.rollup("split").agg(
        F.count(F.lit(1)).alias("images"), F.count_if(none).alias("background"), F.count_if(none & F.col("there").isNull()).alias("missing"), F.count_if(none & F.col("there").isNotNull()).alias("empty"),
        F.sum("n").cast("bigint").alias("instances"), F.max("n").alias("max_instances"), F.avg("n").alias("mean_instances"), F.grouping("split").alias("g"),
    ).withColumn("split", F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("split"))).drop("g")


def class_report(images: DataFrame, boxes: DataFrame, classes: DataFrame, splits: tuple[str, ...] = ("train", "valid", "test")) -> DataFrame:
    """Per class of the class map, zero ones too: instances, pictures, share of instances in percent, instances per split."""
    j = images.select("split", "image_id").join(boxes.select("image_id", "class_id"), "image_id")
    per_image = j.groupBy("class_id", "split", "image_id").agg(F.count(F.lit(1)).alias("n"))
    per = per_image.groupBy("class_id").agg(F.sum("n").alias("instances"), F.count(F.lit(1)).alias("class_images"), *(F.sum(F.when(F.col("split") == s, F.col("n"))).alias(f"instances_{s}") for s in splits))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    whole = F.sum("instances").over(Window.partitionBy())  # a row per class
    return classes.join(per, "class_id", "left").select("class_id", "name", zero("instances"), zero("class_images"), *(zero(f"instances_{s}") for s in splits)).withColumn("percent", F.coalesce(F.lit(100.0) * F.col("instances") / F.nullif(whole, F.lit(0)), F.lit(0.0)))


def index_report(index: DataFrame) -> DataFrame:
    """Counts by stage, by criterion, by dataset, by split and in all, of (dataset, split, excluded, stage, criterion)."""
    return index.groupingSets([["stage"], ["criterion"], ["dataset", "criterion"], ["dataset"], ["split"], []], "stage", "criterion", "dataset", "split").agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n"), F.count_if("excluded").alias("n_excluded"), F.count_if(~F.coalesce("excluded", F.lit(False))).alias("n_kept")
    )


def dimension_stats(images: DataFrame) -> DataFrame:
    """One row: least, median and greatest width and height, and the number of resolutions, of pictures of known size."""
    known = images.where("width > 0 AND height > 0")
    return known.agg(F.count(F.lit(1)).alias("n"), *(f(c).cast("double").alias(f"{name}_{c}") for c in ("width", "height") for name, f in (("min", F.min), ("median", F.median), ("max", F.max))), F.countDistinct("width", "height").alias("resolutions"))


def contributions(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Per dataset: pictures, boxes, boxes a picture, shares of all in percent."""
    n = boxes.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    d = images.select("dataset", "image_id").join(n, "image_id", "left").groupBy("dataset").agg(F.count(F.lit(1)).alias("images"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("boxes"))
    all_ = Window.partitionBy()  # a row per dataset
    share = lambda c: F.lit(100.0) * F.col(c) / F.nullif(F.sum(c).over(all_), F.lit(0))
    return d.select("dataset", "images", "boxes", (F.col("boxes") / F.col("images")).alias("mean_boxes"), share("images").alias("images_percent"), share("boxes").alias("boxes_percent"))


def annotation_stats(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """(n_boxes, images): how many pictures have so many boxes, none included."""
    n = boxes.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    return images.select("image_id").join(n, "image_id", "left").groupBy(F.coalesce("n", F.lit(0)).alias("n_boxes")).agg(F.count(F.lit(1)).alias("images"))


def quantiles(df: DataFrame, by: list[str], value: str, ps: tuple[float, ...], scratch: Scratch, root: bool = False) -> DataFrame:
    """Per `by` a column q_<i> for each share: exact quantiles, linearly interpolated; `root`: also r_<i>, those of the square root.

    Different values are counted and ranked across range partitions, so no group is held as a whole. Null values don't count.
    """
    counted = scratch.keep(df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("x")).agg(F.count(F.lit(1)).alias("n")))
    ranked = running_totals(counted, ["x"], "n", scratch, "before", by)
    whole = counted.groupBy(*by).agg(F.sum("n").alias("all_")) if by else counted.agg(F.sum("n").alias("all_"))
    j = ranked.join(whole.withColumnsRenamed({c: f"__{c}" for c in by}), [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]) if by else ranked.crossJoin(F.broadcast(whole))  # one row
    out = []
    for i, p in enumerate(ps):
        at = F.lit(float(p)) * (F.col("all_") - 1)
        low = F.floor(at)
        there = lambda r, c: F.max(F.when((F.col("before") <= r) & (r < F.col("before") + F.col("n")), c))
        part = F.max(at - low)
        for name, c in (("q", F.col("x")), *((("r", F.sqrt("x")),) if root else ())):
            lo, hi = there(low, c), there(F.least(low + 1, F.col("all_") - 1), c)
            out.append((lo * (F.lit(1.0) - part) + hi * part).alias(f"{name}_{i}"))
    return j.groupBy(*by).agg(*out)


def size_bands(areas: DataFrame, by: list[str], scratch: Scratch, value: str = "area") -> DataFrame:
    """min, p10, median, mean, p90, max of a value and of its root; quantiles interpolate linearly and are exact."""
    ps = (0.1, 0.5, 0.9)
    areas = scratch.keep(areas.select(*by, value))
    q = quantiles(areas, by, value, ps, scratch, root=True)
    rest = areas.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("area_min"), F.round(F.avg(value), 9).alias("area_mean"), F.max(value).alias("area_max"))
    named = {f"{c}_{i}": f"{n}_p{int(p * 100)}" for i, p in enumerate(ps) for c, n in (("q", "area"), ("r", "side"))}
    return rest.join(q.select(*by, *(F.round(c, 9).alias(n) for c, n in named.items())), by, "left")


def log_edges(low: float, high: float, bins: int = 10) -> list[float]:
    """Edges of bins evenly spaced by logarithm between two positive values, the first 0, the last infinite."""
    if not 0 < low < high:
        return [0.0, math.inf]
    return [0.0, *(low * (high / low) ** (i / bins) for i in range(1, bins)), math.inf]


def histogram(values: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """(bin, n) of half-open bins [edge, next edge), empty ones too."""
    b = None
    for i in range(len(edges) - 1):
        inside = (F.col(value) >= edges[i]) & (F.col(value) < edges[i + 1])
        b = F.when(inside, i) if b is None else b.when(inside, i)
    got = values.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n")).where("bin IS NOT NULL")
    return values.sparkSession.range(len(edges) - 1).select(F.col("id").cast("int").alias("bin")).join(got, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def elbow(costs: list[float], distinct: int, gain: float = 0.15) -> int:
    """Number of groups from the sums of squares within 1, 2 ... groups: where the gain of one group more drops most.

    1 for fewer than three different values; the most if its gain is over `gain` of the first sum. Ties: the fewer.
    """
    if distinct < 3:
        return 1
    most = len(costs)
    if costs[0] <= 0 or most < 3:
        return min(2, most)
    gains = [costs[k - 1] - costs[k] for k in range(1, most)]  # of 2, 3 ... groups
    if gains[-1] / costs[0] > gain:
        return most
    drops = [gains[i] - gains[i + 1] for i in range(len(gains) - 1)]
    return drops.index(max(drops)) + 2


def grouped_values(values: DataFrame, value: str, scratch: Scratch, k: int | None = None, most: int = 5, rounds: int = 100) -> DataFrame:
    """(group, n, centre, least, most) of the values in k groups by 1-D k-means, ascending; k: None for the elbow up to `most`.

    Starts at the quantiles (i + 0.5) / k, ties go to the lower centre, ends when the groups stay as they
    are; empty groups are left out, and k values or fewer are one group. All numbers of groups are
    tried at once, each round one aggregate of the counted different values. Null values don't count.
    """
    counted = scratch.keep(values.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n")))
    whole = counted.agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean")).first()
    schema = "group int, n bigint, centre double, least double, most double"
    if not whole.d:
        return values.sparkSession.createDataFrame([], schema)
    wanted = range(1, min(most, whole.d) + 1) if k is None else [k]
    moving = [i for i in wanted if i > 1 and whole.n > i]
    centres: dict[int, list[float]] = {i: [whole.mean] for i in wanted}
    if moving:
        shares = [(i, (j + 0.5) / i) for i in moving for j in range(i)]
        starts = quantiles(values.select(F.col(value).cast("double").alias("v")), [], "v", tuple(p for _, p in shares), scratch).first()
        for i in moving:
            centres[i] = [starts[f"q_{at}"] for at, (of, _) in enumerate(shares) if of == i]

    def nearest(c: list[float]) -> F.Column:
        return F.array_min(F.array(*(F.struct(F.abs(F.col("x") - F.lit(float(m))).alias("d"), F.lit(j).alias("j")) for j, m in enumerate(c))))

    sizes: dict[int, list[int]] = {}
    open_ = list(moving)
    for _ in range(rounds):
        if not open_:
            break
        at = counted.select("x", "n", *(nearest(centres[i]).j.alias(f"g{i}") for i in open_))
        got = at.agg(*(f.alias(f"{name}{i}_{j}") for i in open_ for j in range(i) for name, f in (("n", F.sum(F.when(F.col(f"g{i}") == j, F.col("n")))), ("s", F.sum(F.when(F.col(f"g{i}") == j, F.col("n") * F.col("x"))))))).first()
        for i in list(open_):
            n = [got[f"n{i}_{j}"] or 0 for j in range(i)]
            # Groups are stretches of the sorted values, so equal sizes are equal groups.
            if n == sizes.get(i):
                open_.remove(i)
                continue
            sizes[i] = n
            centres[i] = [got[f"s{i}_{j}"] / m if m else c for j, (m, c) in enumerate(zip(n, centres[i]))]
    if k is None:
        costs = counted.agg(*(F.sum(nearest(centres[i]).d ** 2 * F.col("n")).alias(f"c{i}") for i in wanted)).first()
        k = elbow([costs[f"c{i}"] for i in wanted], whole.d)
    rows = counted.select("x", "n", nearest(centres[k]).j.alias("g")).groupBy("g").agg(F.sum("n").alias("n"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("centre"), F.min("x").alias("least"), F.max("x").alias("most")).collect()
    return values.sparkSession.createDataFrame([(i, r.n, r.centre, r.least, r.most) for i, r in enumerate(sorted(rows, key=lambda r: r.centre))], schema)


def split_stats(images: DataFrame, boxes: DataFrame, scratch: Scratch, target_class: int = 80) -> DataFrame:
    """Per split: pictures, those with a target, targets, histogram 0 .. 5+, quantiles of area and long side, size shares."""
    t = boxes.where(F.col("class_id") == target_class)
    n = t.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    per = images.select("image_id", "split").join(n, "image_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    counts = per.groupBy("split").agg(F.count(F.lit(1)).alias("images"), F.count_if(F.col("n") > 0).alias("with_target"), F.sum("n").cast("bigint").alias("instances"), *(F.count_if((F.col("n") == i) if i < 5 else (F.col("n") >= 5)).alias(f"n_{i}") for i in range(6)))
    a = F.col("w") * F.col("h") * F.lit(100.0)
    pixels = F.col("w") * F.col("width") * F.col("h") * F.col("height")
    sizes = images.select("image_id", "split", "width", "height").join(t, "image_id").withColumns({"a": a, "long": F.greatest(F.col("w"), F.col("h")), "px": pixels})
    sizes = scratch.keep(sizes.select("split", "a", "long", "px"))
    size = sizes.groupBy("split").agg(F.count_if(F.col("px") < 1024).alias("small"), F.count_if((F.col("px") >= 1024) & (F.col("px") < 9216)).alias("medium"), F.count_if(F.col("px") >= 9216).alias("large"))
    ps = (0.05, 0.25, 0.5, 0.75, 0.95)
    for c, name in (("a", "area"), ("long", "side")):
        size = size.join(quantiles(sizes, ["split"], c, ps, scratch).select("split", *(F.round(f"q_{i}", 9).alias(f"{name}_p{int(p * 100)}") for i, p in enumerate(ps))), "split", "left")
    return counts.join(size, "split", "left")


def subset_report(source: DataFrame, subset: DataFrame, chosen: list[int]) -> DataFrame:
    """Before and after of a class subset: both (image_id, class_id or null) with a row per box or picture without boxes.

    Picture shares are of all pictures, source instances of those of all classes, subset
    instances of those of the chosen classes only.
    """
    def per(df: DataFrame, tag: str) -> DataFrame:
        return df.where(F.col("class_id").isin(*chosen)).groupBy("class_id").agg(F.countDistinct("image_id").alias(f"images_{tag}"), F.count(F.lit(1)).alias(f"instances_{tag}"))

    total = lambda df, only, tag: df.agg(F.countDistinct("image_id").alias(f"all_images_{tag}"), F.count_if(F.col("class_id").isin(*chosen) if only else F.col("class_id").isNotNull()).alias(f"all_instances_{tag}"))
    out = per(source, "source").join(per(subset, "subset"), "class_id", "left").fillna(0)
    out = out.join(F.broadcast(total(source, False, "source")), F.lit(True)).join(F.broadcast(total(subset, True, "subset")), F.lit(True))  # one row each
    share = lambda p, w: F.coalesce(F.lit(100.0) * F.col(p) / F.nullif(F.col(w), F.lit(0)), F.lit(0.0))
    return out.select("class_id", "images_source", share("images_source", "all_images_source").alias("images_source_percent"), "instances_source", share("instances_source", "all_instances_source").alias("instances_source_percent"), "images_subset", share("images_subset", "all_images_subset").alias("images_subset_percent"), "instances_subset", share("instances_subset", "all_instances_subset").alias("instances_subset_percent"))
