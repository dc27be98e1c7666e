"""Filter cascades with reasons, overrides per dataset, detection selection, label rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameloom.functions import geometry as G
from frameloom.params import DEFAULTS, Params
from frameloom.sources.labels import override


def catalog(raw: DataFrame) -> DataFrame:
    """Typed catalog, one row per dataset: enabled, download, class names and overrides (null: default)."""
    return raw.select(
        F.concat_ws("-v", "project_id", F.coalesce(F.trim("version"), F.lit(""))).alias("dataset"),
        (F.col("enabled") == "1").alias("enabled"), (F.col("download") == "1").alias("download"),
        (F.coalesce(F.trim("version"), F.lit("")) != "").alias("pinned"), "workspace_id",
        F.split("escooter_class_name", r"\|").alias("class_names"),
        override(F.col("variety_min_instances"), "int").alias("variety_min"),
        override(F.col("closeup_area_threshold"), "double").alias("closeup"),
        override(F.col("faraway_area_threshold"), "double").alias("faraway"),
        override(F.col("phash_distance_threshold"), "int").alias("phash_max"),
    ).distinct()


def enabled_ids(cat: DataFrame) -> DataFrame:
    return cat.where("enabled AND pinned").select("dataset").distinct()


def effective(cat: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Per dataset the override, else the default."""
    return cat.select("dataset", F.coalesce("variety_min", F.lit(params.variety_min_instances)).alias("variety_min"), F.coalesce("closeup", F.lit(params.closeup_area)).alias("closeup"), F.coalesce("faraway", F.lit(params.faraway_area)).alias("faraway"), F.coalesce("phash_max", F.lit(params.phash_distance)).alias("phash_max"))


def widest_distance(cat: DataFrame, params: Params = DEFAULTS) -> int:
    """The greatest distance up to which some dataset takes pictures for the same."""
    return max(params.phash_distance, effective(cat, params).agg(F.max("phash_max")).first()[0] or 0)


def cheap_cascade(images: DataFrame, boxes: DataFrame, cat: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """images with n_target, max_area, min_area, reason (null: kept); the first rule that fails names it.

    No target box; any target box of closeup area or more; any under faraway area; fewer
    pixels than min_pixels. Pictures of unknown size have no pixels.
    """
    a = F.col("w") * F.col("h")
    target = boxes.where(F.col("class_id") == params.target_class).groupBy("image_id").agg(F.count(F.lit(1)).alias("n_target"), F.max(a).alias("max_area"), F.min(a).alias("min_area"))
    eff = effective(cat, params)
    joined = images.join(target, "image_id", "left").join(eff, "dataset", "left")
    closeup, faraway = F.coalesce("closeup", F.lit(params.closeup_area)), F.coalesce("faraway", F.lit(params.faraway_area))
    pixels = F.coalesce(F.col("width").cast("bigint") * F.col("height"), F.lit(0))
    reason = (
        F.when(F.coalesce("n_target", F.lit(0)) == 0, "no target box").when(F.col("max_area") >= closeup, "target fills the view")
        .when(F.col("min_area") < faraway, "target too far away").when(pixels < params.min_pixels, "picture too small")
    )
    return joined.select(*images.columns, F.coalesce("n_target", F.lit(0)).alias("n_target"), "max_area", "min_area", reason.alias("reason"))


def last_marking(base: DataFrame, *stages: DataFrame) -> DataFrame:
    """base (image_id, ...) with excluded, stage and reason of the last of `stages` (image_id, stage, reason) that marks it."""
    marks = None
    for i, s in enumerate(stages):
        s = s.select("image_id", F.lit(i).alias("ord"), "stage", "reason")
        marks = s if marks is None else marks.unionByName(s)
    last = marks.groupBy("image_id").agg(F.max(F.struct("ord", "stage", "reason")).alias("m"))
    return base.join(last, "image_id", "left").select(*base.columns, F.col("m").isNotNull().alias("excluded"), F.col("m.stage").alias("stage"), F.col("m.reason").alias("reason"))


def rider_pairs(boxes: DataFrame, people: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """(image_id, box_ord) of target boxes that a taller person box contains in part: corners struct `b` on either side."""
    t, p = boxes.select("image_id", "box_ord", "b"), people.select("image_id", F.col("b").alias("pb"))
    hit = (G.containment(F.col("b"), F.col("pb")) >= params.rider_overlap) & (G.height(F.col("b")) > 0) & (G.height(F.col("pb")) / F.nullif(G.height(F.col("b")), F.lit(0.0)) > params.rider_height_ratio)
    return t.join(p, "image_id").where(hit).select("image_id", "box_ord").distinct()


def select_detections(detections: DataFrame, targets: DataFrame, rescued: DataFrame | None = None, params: Params = DEFAULTS) -> DataFrame:
    """detections with coverage and fate: low_conf, implausible, lookalike or kept, the first that applies.

    coverage is that by the union of the picture's target boxes, for look-alike classes only.
    Pictures in `rescued` (image_id) skip the look-alike rule.
    """
    around = targets.groupBy("image_id").agg(F.collect_list("b").alias("__targets"))  # a picture's boxes
    joined = detections.join(around, "image_id", "left")
    if rescued is not None:
        joined = joined.join(rescued.select("image_id", F.lit(True).alias("__rescued")).distinct(), "image_id", "left")
    else:
        joined = joined.withColumn("__rescued", F.lit(None).cast("boolean"))
    alike = F.col("class_id").isin(*params.lookalike_classes)
    joined = joined.withColumn("coverage", F.when(alike & (F.col("conf") >= params.conf_threshold), G.union_coverage(F.col("b"), F.col("__targets"))).otherwise(F.lit(0.0)))
    fate = (
        F.when(F.col("conf") < params.conf_threshold, "low_conf").when(F.col("class_id").isin(*params.implausible_classes), "implausible")
        .when(alike & (F.col("coverage") > params.lookalike_overlap) & F.col("__rescued").isNull(), "lookalike").otherwise("kept")
    )
    return joined.withColumn("fate", fate).drop("__targets", "__rescued")


def remap_classes(boxes: DataFrame, order: list[int]) -> DataFrame:
    """Boxes of the listed classes, their class being the place in the list."""
    at = F.create_map(*(F.lit(x) for i, c in enumerate(order) for x in (c, i)))
    return boxes.where(F.col("class_id").isin(*order)).withColumn("class_id", F.element_at(at, F.col("class_id")))


def annotation_format(lines: DataFrame, key: str) -> DataFrame:
    """bbox, polygon, mixed or unknown per key, by the number of fields of all lines that aren't blank."""
    n = F.size(F.split(F.trim("raw"), r"\s+"))
    c = lines.groupBy(key).agg(F.count_if((F.trim("raw") != "") & (n == 5)).alias("five"), F.count_if((F.trim("raw") != "") & (n > 5)).alias("more"))
    fmt = F.when((F.col("five") > 0) & (F.col("more") > 0), "mixed").when(F.col("five") > 0, "bbox").when(F.col("more") > 0, "polygon").otherwise("unknown")
    return c.select(key, "five", "more", fmt.alias("format"))


def missing_names(wanted: Column, there: Column) -> Column:
    return F.array_except(wanted, there)


def where_user(df: DataFrame, predicate: str) -> DataFrame:
    """Rows of a predicate written by the user; an unknown column is an error."""
    return df.where(F.expr(predicate))


def clip_boxes(boxes: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """boxes with action (kept, clipped, removed) and the values after clipping."""
    args = [F.col(c) for c in ("xc", "yc", "w", "h")]
    new = G.clipped(*args)
    out = G.outside(*args, tolerance)
    action = F.when(~out, "kept").when(new.isNull(), "removed").otherwise("clipped")
    return boxes.withColumn("action", action).withColumn("__new", F.when(out, new).otherwise(F.struct(*(F.col(c) for c in ("xc", "yc", "w", "h"))))).withColumns({c: F.col(f"__new.{c}") for c in ("xc", "yc", "w", "h")}).drop("__new")


def modified_boxes(current: DataFrame, original: DataFrame, within: float = 1e-5) -> DataFrame:
    """Current boxes without an original of the same picture and class whose four numbers differ by less than `within`."""
    o = original.select("image_id", "class_id", *(F.col(c).alias(f"o_{c}") for c in ("xc", "yc", "w", "h")))
    same = (current["image_id"] == o["image_id"]) & (current["class_id"] == o["class_id"])
    for c in ("xc", "yc", "w", "h"):
        same = same & (F.abs(current[c] - o[f"o_{c}"]) < within)
    return current.join(o, same, "left_anti")


def variant_keepers(files: DataFrame, group: list[str], rotated: str, name: str) -> DataFrame:
    """files with keep: of each group the first by name that isn't rotated, else the first. Names are unique in a group.

    The first is found by an aggregate that combines on the map side, so a group may be of any size.
    """
    first = files.groupBy(*group).agg(F.min(F.struct(F.col(rotated), F.col(name))).alias("__first"))
    keyed = first.select(*(F.col(c).alias(f"__{i}") for i, c in enumerate(group)), "__first")
    on = None
    for i, c in enumerate(group):
        same = F.col(c).eqNullSafe(F.col(f"__{i}"))
        on = same if on is None else on & same
    return files.join(keyed, on).withColumn("keep", F.struct(F.col(rotated), F.col(name)) == F.col("__first")).drop("__first", *(f"__{i}" for i in range(len(group))))


def upsert(old: DataFrame, new: DataFrame, key: str, owned: list[str]) -> DataFrame:
    """Right-biased merge: a row of `new` replaces the old one, null values too, but for the `owned` columns it doesn't bring."""
    o, n = old.alias("o"), new.withColumn("__new", F.lit(True)).alias("n")
    out = [F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key)]
    for c in old.columns:
        if c == key:
            continue
        out.append(F.col(f"o.{c}").alias(c) if c in owned or c not in new.columns else F.when(F.col("n.__new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(*out)


def reconcile(cat: DataFrame, indexed: DataFrame, on_disk: DataFrame) -> DataFrame:
    """(dataset, status) of catalog (dataset, enabled, pinned, workspace), index (dataset, workspace) and disk (dataset).

    ok, missing (enabled, not indexed), not_on_disk, workspace_mismatch, disabled, unpinned,
    orphan (not in the catalog).
    """
    c = cat.groupBy("dataset").agg(F.max("enabled").alias("enabled"), F.max("pinned").alias("pinned"), F.max("workspace_id").alias("ws"), F.lit(True).alias("c"))
    i = indexed.groupBy("dataset").agg(F.max("workspace_id").alias("iws"), F.lit(True).alias("i"))
    d = on_disk.select("dataset", F.lit(True).alias("d")).distinct()
    j = c.join(i, "dataset", "full_outer").join(d, "dataset", "full_outer")
    status = (
        F.when(F.col("c").isNull(), "orphan").when(~F.col("pinned"), "unpinned").when(~F.col("enabled"), "disabled").when(F.col("i").isNull(), "missing")
        .when(F.col("d").isNull(), "not_on_disk").when(~F.col("ws").eqNullSafe(F.col("iws")), "workspace_mismatch").otherwise("ok")
    )
    return j.select("dataset", status.alias("status"))
