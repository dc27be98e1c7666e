"""Queries on label files, catalogs, filter rules and box functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.catalogue.registry import query
from frameloom.catalogue.views import BX, CAT, DET, EFF, H, IMG, LOG, SB, Views, containment_sql, iou_sql, overlap_sql
from frameloom.functions import geometry as G
from frameloom.functions import names as N
from frameloom.functions import text as T
from frameloom.operators import curate as C

from frameloom.sources import labels as L

LISTED = "IN (0, 1, 2, 3, 5, 7, 80)"
REASON_SQL = """CASE WHEN reason IS NULL OR reason = '' THEN '(no reason)' WHEN regexp_matches(reason, '^[0-9]+ objects? found, [0-9]+ wanted$|^0 objects found$') THEN 'too few objects found'
  WHEN regexp_matches(reason, '^close copy of .+$') THEN 'close copy of another picture' WHEN regexp_matches(reason, '^redundant frame.*$') THEN 'redundant frame of a sequence'
  WHEN regexp_matches(reason, '^picture too small.*$') THEN 'picture too small' ELSE reason END"""


def _lines(v: Views) -> DataFrame:
    """The boxes as label lines; every tenth box of a picture has a sixth field, every ninth a class of 1.5."""
    number = F.when(F.col("box_ord") % 10 == 8, F.lit("1.5")).otherwise(F.col("class_id").cast("string"))
    raw = F.concat_ws(" ", number, *(F.col(c).cast("string") for c in ("xc", "yc", "w", "h")))
    return v.bx.select("image_id", (F.col("box_ord") + 1).alias("line_no"), F.when(F.col("box_ord") % 10 == 9, F.concat(raw, F.lit(" 0.5"))).otherwise(F.concat(F.lit("  "), raw, F.lit(" "))).alias("raw"))


@query(f"WITH {BX} SELECT image_id, box_ord + 1 AS box_ord, class_id, xc, yc, w, h FROM bx WHERE box_ord % 10 NOT IN (8, 9)")
def a1_label_boxes(v: Views) -> DataFrame:
    return L.parse_boxes(_lines(v), ["image_id"])


@query(f"WITH {BX} SELECT image_id, box_ord + 1 AS box_ord, CASE WHEN box_ord % 10 = 8 THEN 1 ELSE class_id END AS class_id, xc, yc, w, h FROM bx WHERE box_ord % 10 <> 9")
def a2_label_boxes_tolerant(v: Views) -> DataFrame:
    return L.parse_boxes(_lines(v), ["image_id"], "tolerant")


@query(f"WITH {BX} SELECT image_id, count(*) AS n_lines, count(*) FILTER (box_ord % 10 = 8) AS n_errors, min(CASE WHEN box_ord % 10 = 8 THEN image_id || ':' || (box_ord + 1) END) AS first_error FROM bx GROUP BY image_id")
def a5_label_errors(v: Views) -> DataFrame:
    return L.parse_boxes(_lines(v), ["image_id"], "strict").groupBy("image_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count("error").alias("n_errors"), F.min("error").alias("first_error"))


@query(f"WITH {BX} SELECT image_id, class_id, count(*) AS n FROM bx GROUP BY image_id, class_id")
def a6_class_histogram(v: Views) -> DataFrame:
    return v.bx.groupBy("image_id", "class_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {IMG}, {BX}, n AS (SELECT image_id, count(*) FILTER (class_id = 80) AS n_areas, sum(CASE WHEN class_id = 80 THEN w * h ELSE 0e0 END) AS area FROM bx GROUP BY image_id)
SELECT image_id, n_areas, round(area, 12) AS area FROM img LEFT JOIN n USING (image_id)""")
def a7_target_areas(v: Views) -> DataFrame:
    """Null for pictures without labels, 0 for those with labels of other classes only."""
    target = F.col("class_id") == 80
    n = v.bx.groupBy("image_id").agg(F.count_if(target).alias("n_areas"), F.round(F.sum(F.when(target, F.col("w") * F.col("h")).otherwise(F.lit(0.0))), 12).alias("area"))
    return v.pick().select("image_id").join(n, "image_id", "left")


@query(f"WITH {BX} SELECT class_id, image_id, array_to_string(list_sort(list(box_ord)), ',') AS ords FROM bx WHERE class_id {LISTED} GROUP BY class_id, image_id")
def a8_boxes_by_picture(v: Views) -> DataFrame:
    return v.bx.where(f"class_id {LISTED}").groupBy("class_id", "image_id").agg(F.array_join(F.sort_array(F.collect_list("box_ord")).cast("array<string>"), ",").alias("ords"))


@query("SELECT row_number() OVER (ORDER BY project_id, version, workspace_id, enabled, download, notes) AS line_no, CASE WHEN contains(coalesce(notes, ''), 'footage') THEN 'line ' || line_no || ': 4 fields, 3 wanted' END AS error FROM datasets_to_download")
def a17_catalog_arity(v: Views) -> DataFrame:
    rows = v.table("datasets_to_download").withColumn("line_no", F.row_number().over(Window.orderBy("project_id", "version", "workspace_id", "enabled", "download", "notes")).cast("bigint"))  # a control table
    raw = F.concat_ws(",", F.coalesce("project_id", F.lit("")), F.coalesce("version", F.lit("")), F.when(F.contains(F.coalesce("notes", F.lit("")), F.lit("footage")), F.lit("a,b")).otherwise(F.lit("a")))
    return L.catalog_lines(rows.select("line_no", raw.alias("raw")), ["project_id", "version", "workspace_id"]).select("line_no", "error")


@query(f"WITH {CAT} SELECT DISTINCT dataset FROM cat WHERE enabled AND pinned")
def a19_enabled_ids(v: Views) -> DataFrame:
    return C.enabled_ids(v.cat)


@query(f"WITH {CAT} SELECT dataset, len(class_names) AS n_classes, variety_min, closeup, faraway, phash_max FROM cat")
def a20_overrides(v: Views) -> DataFrame:
    return v.cat.select("dataset", F.size("class_names").cast("bigint").alias("n_classes"), "variety_min", "closeup", "faraway", "phash_max")


@query(f"""WITH {CAT}, {IMG}, old AS (SELECT dataset AS id, count(*) AS images, min(split) AS split, max(file) AS note FROM img GROUP BY dataset),
new AS (SELECT dataset AS id, max(phash_max)::BIGINT AS images, max(workspace_id) AS split FROM cat WHERE enabled GROUP BY dataset)
SELECT id, CASE WHEN new.split IS NOT NULL THEN new.images ELSE old.images END AS images, CASE WHEN new.split IS NOT NULL THEN new.split ELSE old.split END AS split, note FROM old FULL JOIN new USING (id)""")
def a24_index_upsert(v: Views) -> DataFrame:
    old = v.pick(file=N.path_file(F.col("image_path"))).groupBy(F.col("dataset").alias("id")).agg(F.count(F.lit(1)).alias("images"), F.min("split").alias("split"), F.max("file").alias("note"))
    new = v.cat.where("enabled").groupBy(F.col("dataset").alias("id")).agg(F.max("phash_max").cast("bigint").alias("images"), F.max("workspace_id").alias("split"))
    return C.upsert(old, new, "id", ["note"])


@query(f"WITH {IMG} SELECT dataset, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'valid') AS valid, count(*) FILTER (split = 'test') AS test FROM img GROUP BY dataset")
def a25_split_counts(v: Views) -> DataFrame:
    return v.pick().groupBy("dataset").agg(*(F.count_if(F.col("split") == s).alias(s) for s in ("train", "valid", "test")))


@query(f"WITH {IMG}, {BX}, {SB}, {DET} SELECT dataset || '/' || image_id AS key, ord AS det_ord, class_id, conf, round(x1, 9) AS x1, round(y2, 9) AS y2, height, width FROM det")
def a26_cached_detections(v: Views) -> DataFrame:
    """Detections packed into JSON caches, one per picture, and read back."""
    d = v.det.groupBy("dataset", "image_id", "width", "height").agg(F.sort_array(F.collect_list(F.struct("ord", "class_id", "conf", "b"))).alias("d"))
    boxes = F.transform("d", lambda x: F.array(x.class_id.cast("double"), x.conf, x.b.x1, x.b.y1, x.b.x2, x.b.y2, x.ord.cast("double")))
    entry = F.struct(F.lit(0.0).alias("mtime"), F.lit(1).alias("size"), F.lit(0.1).alias("capture_conf"), F.array("height", "width").alias("orig_shape"), F.create_map(F.lit("0"), boxes).alias("detections"))
    raw = d.select(F.to_json(F.create_map(F.concat_ws("/", "dataset", "image_id"), entry, F.concat(F.lit("__class_names__"), F.col("image_id")), F.lit(None).cast(entry_type(entry)))).alias("raw"), F.transform("d", lambda x: x.ord).alias("ords"), "image_id")
    out = L.cached_detections(raw.select("raw"))
    ords = raw.select(F.posexplode("ords").alias("det_ord", "ord"), "image_id")
    joined = out.withColumn("image_id", F.substring_index("key", "/", -1).cast("bigint")).join(ords, ["image_id", "det_ord"])
    return joined.select("key", F.col("ord").alias("det_ord"), "class_id", "conf", F.round("x1", 9).alias("x1"), F.round("y2", 9).alias("y2"), "height", "width")


def entry_type(_: F.Column) -> str:
    return "struct<mtime: double, size: int, capture_conf: double, orig_shape: array<int>, detections: map<string, array<array<double>>>>"


@query(f"WITH {IMG} SELECT base AS name, count(DISTINCT dataset || '/' || file) AS paths FROM img GROUP BY base HAVING paths > 1")
def a44_name_clashes(v: Views) -> DataFrame:
    from frameloom.operators.sampling import name_clashes

    return name_clashes(N.with_names(v.table("image_index")).transform(lambda d: _current_paths(d)), "path", F.col("base"))


def _current_paths(index: DataFrame) -> DataFrame:
    from frameloom.operators.images import current_images

    return current_images(index, file=F.col("__file"), base=F.col("__base")).select(F.concat_ws("/", "dataset", "file").alias("path"), "base")


@query(f"""WITH {LOG}, names AS (SELECT DISTINCT 'picture_' || user_id AS name FROM events WHERE user_id % 3 <> 0)
SELECT name, decision, name IN (SELECT name FROM names) AS there FROM decided WHERE decision = 'select'""")
def a45_selected(v: Views) -> DataFrame:
    from frameloom.operators.review import current_decisions

    names = v.table("events").where("user_id % 3 <> 0").select(F.concat(F.lit("picture_"), F.col("user_id")).alias("name"), F.lit(True).alias("there")).distinct()
    return current_decisions(v.decisions).where("decision = 'select'").join(names, "name", "left").select("name", "decision", F.coalesce("there", F.lit(False)).alias("there"))


@query(f"""WITH {IMG}, {BX}, {CAT}, j AS (SELECT i.image_id, i.dataset, i.file, bool_or(c.enabled) AS on_ FROM img i JOIN cat c USING (dataset) WHERE NOT coalesce(i.excluded, FALSE) GROUP BY ALL)
SELECT dataset || '__' || file AS name, CASE WHEN on_ THEN 'copied' ELSE 'disabled' END AS fate, (SELECT count(*) FROM bx WHERE bx.image_id = j.image_id AND class_id = 80) AS n_target FROM j""")
def a46_union_build(v: Views) -> DataFrame:
    img = v.pick(file=N.path_file(F.col("image_path")), excluded=F.col("excluded")).where("NOT coalesce(excluded, false)")
    on = v.cat.groupBy("dataset").agg(F.bool_or("enabled").alias("on_"))
    n = v.bx.where("class_id = 80").groupBy("image_id").agg(F.count(F.lit(1)).alias("n_target"))
    return img.join(on, "dataset").join(n, "image_id", "left").select(F.concat(F.col("dataset"), F.lit("__"), F.col("file")).alias("name"), F.when(F.col("on_"), "copied").otherwise("disabled").alias("fate"), F.coalesce("n_target", F.lit(0)).alias("n_target"))


@query(f"""WITH {IMG}, {BX}, {CAT}, {EFF}, e1 AS (SELECT dataset, max(closeup) AS closeup, max(faraway) AS faraway FROM eff GROUP BY dataset),
t AS (SELECT image_id, count(*) AS n_target, max(w * h) AS max_area, min(w * h) AS min_area FROM bx WHERE class_id = 80 GROUP BY image_id)
SELECT image_id, dataset, coalesce(n_target, 0) AS n_target, max_area, min_area,
  CASE WHEN coalesce(n_target, 0) = 0 THEN 'no target box' WHEN max_area >= coalesce(closeup, 4e-1) THEN 'target fills the view' WHEN min_area < coalesce(faraway, 1e-3) THEN 'target too far away'
    WHEN coalesce(width::BIGINT * height, 0) < 160000 THEN 'picture too small' END AS reason
FROM img LEFT JOIN t USING (image_id) LEFT JOIN e1 USING (dataset)""")
def b1_cheap_cascade(v: Views) -> DataFrame:
    cat = v.cat.groupBy("dataset").agg(*(F.max(c).alias(c) for c in ("variety_min", "closeup", "faraway", "phash_max")))
    return C.cheap_cascade(v.pick(width=F.col("width"), height=F.col("height")), v.bx, cat).select("image_id", "dataset", "n_target", "max_area", "min_area", "reason")


@query(f"WITH {CAT}, {EFF} SELECT * FROM eff")
def b2_effective_parameters(v: Views) -> DataFrame:
    return C.effective(v.cat)


@query(f"""WITH {IMG}, {H}, {BX}, small AS (SELECT image_id FROM img WHERE coalesce(width, 0) < 700), nohash AS (SELECT image_id FROM img ANTI JOIN hs USING (image_id)), nobox AS (SELECT image_id FROM img ANTI JOIN bx USING (image_id))
SELECT image_id, image_id IN (SELECT * FROM small) OR image_id IN (SELECT * FROM nohash) OR image_id IN (SELECT * FROM nobox) AS excluded,
  CASE WHEN image_id IN (SELECT * FROM nobox) THEN 'variety' WHEN image_id IN (SELECT * FROM nohash) THEN 'dedup' WHEN image_id IN (SELECT * FROM small) THEN 'cheap' END AS stage,
  CASE WHEN image_id IN (SELECT * FROM nobox) THEN 'no box' WHEN image_id IN (SELECT * FROM nohash) THEN 'no hash' WHEN image_id IN (SELECT * FROM small) THEN 'narrow' END AS reason FROM img""")
def b6_last_marking(v: Views) -> DataFrame:
    img = v.pick(width=F.col("width"))
    mark = lambda d, s, r: d.select("image_id", F.lit(s).alias("stage"), F.lit(r).alias("reason"))
    return C.last_marking(img.select("image_id"), mark(img.where("coalesce(width, 0) < 700"), "cheap", "narrow"), mark(img.join(v.h, "image_id", "left_anti"), "dedup", "no hash"), mark(img.join(v.bx, "image_id", "left_anti"), "variety", "no box"))


@query(f"WITH {IMG} SELECT image_id, dataset, split FROM img WHERE width > 600 AND split = 'valid' AND NOT coalesce(excluded, FALSE)")
def b7_user_predicate(v: Views) -> DataFrame:
    return C.where_user(v.pick(width=F.col("width"), excluded=F.col("excluded")), "width > 600 AND split = 'valid' AND NOT coalesce(excluded, false)").select("image_id", "dataset", "split")


@query(f"WITH {BX} SELECT image_id, bool_or(w * h >= 4e-1 OR w * h < 1e-3) AS rejected FROM bx GROUP BY image_id")
def b10_area_rejection(v: Views) -> DataFrame:
    a = F.col("w") * F.col("h")
    return v.bx.groupBy("image_id").agg(F.bool_or((a >= 0.4) | (a < 0.001)).alias("rejected"))


_COVER = """len(list_filter(range(0, 1024), lambda i: len(list_filter(ts, lambda o:
  d.x1 + (d.x2 - d.x1) * ((i % 32)::DOUBLE + 5e-1) / 32e0 >= o.x1 AND d.x1 + (d.x2 - d.x1) * ((i % 32)::DOUBLE + 5e-1) / 32e0 <= o.x2
  AND d.y1 + (d.y2 - d.y1) * ((i // 32)::DOUBLE + 5e-1) / 32e0 >= o.y1 AND d.y1 + (d.y2 - d.y1) * ((i // 32)::DOUBLE + 5e-1) / 32e0 <= o.y2)) > 0))::DOUBLE / 1024e0"""


@query(f"""WITH {IMG}, {BX}, {SB}, {DET}, t AS (SELECT image_id, list({{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}) AS ts FROM sb WHERE class_id = 80 GROUP BY image_id),
c AS (SELECT d.image_id, d.ord, d.class_id, d.conf, CASE WHEN d.class_id IN (1, 3, 12, 31, 36) AND d.conf >= 45e-2 AND ts IS NOT NULL THEN {_COVER} ELSE 0e0 END AS coverage FROM det d LEFT JOIN t USING (image_id) WHERE d.class_id <> 80)
SELECT *, CASE WHEN conf < 45e-2 THEN 'low_conf' WHEN class_id IN (40,42,44,57,59,60,61,62,64,65,66,68,69,70,71,72,78,79) THEN 'implausible' WHEN class_id IN (1, 3, 12, 31, 36) AND coverage > 6e-1 AND image_id % 10 <> 0 THEN 'lookalike' ELSE 'kept' END AS fate FROM c""")
def b13_select_detections(v: Views) -> DataFrame:
    rescued = v.bx.where("image_id % 10 = 0").select("image_id")
    return C.select_detections(v.det.where("class_id <> 80").select("image_id", "ord", "class_id", "conf", "b"), v.sb.where("class_id = 80"), rescued).select("image_id", "ord", "class_id", "conf", "coverage", "fate")


@query(f"WITH {BX} SELECT image_id, box_ord, CASE class_id WHEN 80 THEN 0 WHEN 0 THEN 1 ELSE 2 END AS class_id FROM bx WHERE class_id IN (80, 0, 2)")
def b14_remap_classes(v: Views) -> DataFrame:
    return C.remap_classes(v.bx, [80, 0, 2]).select("image_id", "box_ord", "class_id")


@query(f"WITH {BX} SELECT image_id, count(*) FILTER (class_id = 80) AS n_target, count(*) FILTER (class_id <> 80) AS n_ignored FROM bx GROUP BY image_id")
def b16_target_only(v: Views) -> DataFrame:
    return v.bx.groupBy("image_id").agg(F.count_if(F.col("class_id") == 80).alias("n_target"), F.count_if(F.col("class_id") != 80).alias("n_ignored"))


@query(f"WITH {BX} SELECT image_id, count(*) FILTER (box_ord % 10 <> 9) AS five, count(*) FILTER (box_ord % 10 = 9) AS more, CASE WHEN five > 0 AND more > 0 THEN 'mixed' WHEN five > 0 THEN 'bbox' ELSE 'polygon' END AS format FROM bx GROUP BY image_id")
def b18_annotation_format(v: Views) -> DataFrame:
    return C.annotation_format(_lines(v), "image_id")


@query(f"WITH {CAT} SELECT dataset, array_to_string(list_sort(list_distinct(list_filter(class_names, lambda x: x NOT IN ('kick scooter', '12')))), '|') AS extra, array_to_string(list_sort(list_filter(['kick scooter', '12'], lambda x: NOT list_contains(class_names, x))), '|') AS missing FROM cat WHERE class_names IS NOT NULL")
def b19_missing_names(v: Views) -> DataFrame:
    wanted = F.array(F.lit("kick scooter"), F.lit("12"))
    return v.cat.where("class_names IS NOT NULL").select("dataset", F.array_join(F.sort_array(C.missing_names(F.col("class_names"), wanted)), "|").alias("extra"), F.array_join(F.sort_array(C.missing_names(wanted, F.col("class_names"))), "|").alias("missing"))


@query(f"WITH {CAT} SELECT DISTINCT dataset, workspace_id FROM cat WHERE enabled AND download")
def b20_to_download(v: Views) -> DataFrame:
    return v.cat.where("enabled AND download").select("dataset", "workspace_id").distinct()


@query(f"WITH {IMG} SELECT coalesce(nullif(stage, ''), '(no stage)') || ' / ' || {REASON_SQL} AS criterion, min(CASE stage WHEN 'cheap' THEN 0 WHEN 'temporal' THEN 1 WHEN 'dedup' THEN 2 WHEN 'variety' THEN 3 ELSE 99 END) AS rank, count(*) AS n FROM img WHERE excluded GROUP BY 1")
def b22_criteria(v: Views) -> DataFrame:
    img = v.pick(excluded=F.col("excluded"), stage=F.col("exclusion_stage"), reason=F.col("exclusion_reason")).where("excluded")
    return img.groupBy(T.criterion(F.col("stage"), F.col("reason")).alias("criterion")).agg(F.min(T.stage_rank(F.col("stage"))).alias("rank"), F.count(F.lit(1)).alias("n"))


@query(rf"WITH {IMG} SELECT dataset, split, regexp_replace(file, '(?i)\.rf\.[0-9a-f]+\.(jpg|jpeg|png)$', '') AS base, count(*) AS n FROM img GROUP BY ALL")
def b24_variant_bases(v: Views) -> DataFrame:
    return v.pick(base=N.variant_base(N.path_file(F.col("image_path")))).groupBy("dataset", "split", "base").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {IMG} SELECT image_id, dataset, split, base, clip, frame FROM img")
def b25_names(v: Views) -> DataFrame:
    return v.img.select("image_id", "dataset", "split", "base", "clip", "frame")


@query(f"WITH {IMG} SELECT image_id, dataset || '/' || split || '/images/' || file AS key, string_split(dataset || '__' || file, '__')[1] AS dataset FROM img")
def b31_keys(v: Views) -> DataFrame:
    img = v.pick(file=N.path_file(F.col("image_path")))
    return img.select("image_id", F.concat_ws("/", "dataset", "split", F.lit("images"), "file").alias("key"), N.dataset_of_flat_name(F.concat_ws("__", "dataset", "file")).alias("dataset"))


@query(f"""WITH {BX} SELECT b.image_id, b.box_ord FROM bx b WHERE NOT EXISTS (SELECT 1 FROM bx o WHERE o.image_id = b.image_id AND o.class_id = b.class_id
  AND abs(b.xc - (o.xc + CASE WHEN o.box_ord % 3 = 0 THEN 2e-4 ELSE 0e0 END)) < 1e-5 AND abs(b.yc - o.yc) < 1e-5 AND abs(b.w - o.w) < 1e-5 AND abs(b.h - o.h) < 1e-5)""")
def b34_modified_boxes(v: Views) -> DataFrame:
    original = v.bx.withColumn("xc", F.col("xc") + F.when(F.col("box_ord") % 3 == 0, F.lit(2e-4)).otherwise(F.lit(0.0)))
    return C.modified_boxes(v.bx, original).select("image_id", "box_ord")


@query(f"WITH {IMG} SELECT dataset || '/' || file AS key, width AS size FROM img WHERE width > 0 AND (width % 3 = 0 OR image_id % 4 = 0 OR image_id % 4 = 1)")
def b38_stale_cache(v: Views) -> DataFrame:
    """Files whose cached entry is missing, changed, or captured at too high a confidence."""
    img = v.pick(file=N.path_file(F.col("image_path")), width=F.col("width")).where("width > 0").withColumn("key", F.concat_ws("/", "dataset", "file"))
    files = img.select("key", F.lit(0.0).alias("mtime"), F.col("width").alias("size"), "image_id")
    cache = img.where("image_id % 4 <> 0").select("key", F.lit(0.0).alias("mtime"), F.when(F.col("width") % 3 == 0, F.col("width") + 1).otherwise(F.col("width")).alias("size"), F.when(F.col("image_id") % 4 == 1, F.lit(0.5)).otherwise(F.lit(0.1)).alias("capture_conf"))
    return L.stale(files, cache, 0.1).select("key", "size")


@query(f"WITH {BX}, c AS (SELECT image_id, box_ord, (xc - w / 2e0 < -1e-4) OR (yc - h / 2e0 < -1e-4) OR (xc + w / 2e0 > 1.0001e0) OR (yc + h / 2e0 > 1.0001e0) AS outside FROM bx) SELECT * FROM c")
def b40_outside(v: Views) -> DataFrame:
    return v.bx.select("image_id", "box_ord", G.outside(F.col("xc"), F.col("yc"), F.col("w"), F.col("h")).alias("outside"))


@query(f"""WITH {IMG}, {BX}, {SB} SELECT image_id, ord, round(x1, 6) AS x1, round(y2, 6) AS y2, round(pixels, 6) AS pixels, CASE WHEN pixels < 1024 THEN 'small' WHEN pixels < 9216 THEN 'medium' ELSE 'large' END AS bucket,
  round(1e0 - (xc + w / 2e0), 9) AS mirrored_x1, round(least(width - 1 - x1, width - 1 - x2), 6) AS turned_x1, round(least(height - 1 - y1, height - 1 - y2), 6) AS turned_y1 FROM sb""")
def c3_box_functions(v: Views) -> DataFrame:
    s = v.sb
    n = G.corners(F.col("xc"), F.col("yc"), F.col("w"), F.col("h"))
    s = s.withColumn("m", G.mirrored(n)).withColumn("t", G.rotated(F.col("b"), F.lit(180), F.col("width"), F.col("height")))
    return s.select("image_id", "ord", F.round("b.x1", 6).alias("x1"), F.round("b.y2", 6).alias("y2"), F.round("pixels", 6).alias("pixels"), G.size_bucket(F.col("pixels")).alias("bucket"), F.round("m.x1", 9).alias("mirrored_x1"), F.round("t.x1", 6).alias("turned_x1"), F.round("t.y1", 6).alias("turned_y1"))


@query(f"""WITH {IMG}, {BX}, {SB}, t AS (SELECT image_id, list({{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}) AS ts FROM sb WHERE class_id = 80 GROUP BY image_id)
SELECT d.image_id, d.ord, {_COVER} AS coverage FROM sb d JOIN t USING (image_id) WHERE d.class_id <> 80""")
def c12_union_coverage(v: Views) -> DataFrame:
    t = v.sb.where("class_id = 80").groupBy("image_id").agg(F.collect_list("b").alias("ts"))
    return v.sb.where("class_id <> 80").join(t, "image_id").select("image_id", "ord", G.union_coverage(F.col("b"), F.col("ts")).alias("coverage"))


@query(f"WITH {IMG}, {BX}, {SB} SELECT a.image_id, a.ord AS a, b.ord AS b, round({iou_sql('a', 'b')}, 9) AS iou, round({containment_sql('a', 'b')}, 9) AS containment, round(least({containment_sql('a', 'b')}, {containment_sql('b', 'a')}), 9) AS mutual FROM sb a JOIN sb b ON a.image_id = b.image_id AND a.ord < b.ord WHERE {overlap_sql('a', 'b')} > 0")
def c13_box_pairs(v: Views) -> DataFrame:
    a, b = v.sb.select("image_id", F.col("ord").alias("a"), F.col("b").alias("ba")), v.sb.select("image_id", F.col("ord").alias("o"), F.col("b").alias("bb"))
    j = a.join(b, "image_id").where((F.col("a") < F.col("o")) & (G.intersection(F.col("ba"), F.col("bb")) > 0))
    return j.select("image_id", "a", F.col("o").alias("b"), F.round(G.iou(F.col("ba"), F.col("bb")), 9).alias("iou"), F.round(G.containment(F.col("ba"), F.col("bb")), 9).alias("containment"), F.round(G.mutual_containment(F.col("ba"), F.col("bb")), 9).alias("mutual"))


@query(f"""WITH {BX}, k AS (SELECT image_id, box_ord, greatest(xc - w / 2e0, 0e0) AS x1, greatest(yc - h / 2e0, 0e0) AS y1, least(xc + w / 2e0, 1e0) AS x2, least(yc + h / 2e0, 1e0) AS y2,
  (xc - w / 2e0 < -1e-4) OR (yc - h / 2e0 < -1e-4) OR (xc + w / 2e0 > 1.0001e0) OR (yc + h / 2e0 > 1.0001e0) AS o, xc, yc, w, h FROM bx)
SELECT image_id, box_ord, CASE WHEN NOT o THEN 'kept' WHEN x2 <= x1 OR y2 <= y1 THEN 'removed' ELSE 'clipped' END AS action,
  round(CASE WHEN NOT o THEN w WHEN x2 > x1 AND y2 > y1 THEN x2 - x1 END, 9) AS w, round(CASE WHEN NOT o THEN h WHEN x2 > x1 AND y2 > y1 THEN y2 - y1 END, 9) AS h FROM k""")
def c18_clip_boxes(v: Views) -> DataFrame:
    return C.clip_boxes(v.bx).select("image_id", "box_ord", "action", F.round("w", 9).alias("w"), F.round("h", 9).alias("h"))


@query("SELECT list_name, classe, round(TRY_CAST(replace(regexp_replace(percentuale_istanze_subset, '[%\\s]', '', 'g'), ',', '.') AS DOUBLE), 9) AS share FROM coco_subset_20000_4000")
def c27_decimal_comma(v: Views) -> DataFrame:
    return v.table("coco_subset_20000_4000").select("list_name", "classe", F.round(T.decimal_comma(F.col("percentuale_istanze_subset")), 9).alias("share"))


@query(f"""WITH {IMG}, {BX}, {SB}, {DET}, a AS (SELECT image_id, class_id, count(*) AS n FROM sb GROUP BY ALL), d AS (SELECT image_id, class_id, count(*) AS n FROM det WHERE conf >= 45e-2 GROUP BY ALL),
j AS (SELECT image_id, class_id, coalesce(a.n, 0) AS x, coalesce(d.n, 0) AS y FROM a FULL JOIN d USING (image_id, class_id))
SELECT image_id, sum(least(x, y))::DOUBLE / nullif(sum(greatest(x, y)), 0)::DOUBLE AS similarity FROM j GROUP BY image_id""")
def c28_class_similarity(v: Views) -> DataFrame:
    """Weighted Jaccard of the class counts of boxes and of confident detections."""
    a = v.sb.groupBy("image_id", "class_id").agg(F.count(F.lit(1)).alias("x"))
    d = v.det.where("conf >= 0.45").groupBy("image_id", "class_id").agg(F.count(F.lit(1)).alias("y"))
    j = a.join(d, ["image_id", "class_id"], "full_outer").fillna(0, ["x", "y"])
    return j.groupBy("image_id").agg((F.sum(F.least("x", "y")) / F.nullif(F.sum(F.greatest("x", "y")), F.lit(0))).alias("similarity"))


@query(f"""WITH {IMG} SELECT dataset, count(*) AS n, count(*) FILTER (width > 0 AND height > 0) AS sized FROM img GROUP BY dataset""")
def b5_provenance(v: Views) -> DataFrame:
    return v.pick(width=F.col("width"), height=F.col("height")).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("width") > 0) & (F.col("height") > 0)).alias("sized"))


