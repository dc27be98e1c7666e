"""Queries on statistics, samples, evaluation, training runs, review logs and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.catalogue.registry import query
from frameloom.catalogue.views import BX, CAT, DET, IMG, LOG, RUNS, SB, Views, greedy_sql, iou_sql
from frameloom.functions import names as N
from frameloom.operators import evaluation as E
from frameloom.operators import matching as M
from frameloom.operators import review as R
from frameloom.operators import runs as J
from frameloom.operators import sampling as H
from frameloom.operators import stats as S
from frameloom.params import DEFAULTS
from frameloom.plans.scratch import Scratch, shared_dir

CLASSES_SQL = "classes AS (SELECT DISTINCT classe AS class_id, max(nome) AS name FROM coco_subset_20000_4000 GROUP BY classe)"


def _classes(v: Views) -> DataFrame:
    return v.table("coco_subset_20000_4000").groupBy(F.col("classe").alias("class_id")).agg(F.max("nome").alias("name"))


@query(f"""WITH {IMG}, {BX}, lab AS (SELECT DISTINCT image_id FROM boxes), n AS (SELECT image_id, count(*) AS n FROM bx GROUP BY image_id),
j AS (SELECT split, coalesce(n, 0) AS n, image_id IN (SELECT image_id FROM lab) AS there FROM img LEFT JOIN n USING (image_id))
SELECT CASE WHEN grouping(split) = 1 THEN 'TOTAL' ELSE split END AS split, count(*) AS images, count(*) FILTER (n = 0) AS background, count(*) FILTER (n = 0 AND NOT there) AS missing, count(*) FILTER (n = 0 AND there) AS empty, sum(n)::BIGINT AS instances, max(n) AS max_instances, round(avg(n), 9) AS mean_instances
FROM j GROUP BY ROLLUP (split)""")
def g1_split_summary(v: Views) -> DataFrame:
    return S.split_summary(v.pick(), v.bx, v.table("boxes")).withColumn("mean_instances", F.round("mean_instances", 9))


@query(f"""WITH {IMG}, {BX}, {CLASSES_SQL}, j AS (SELECT class_id, split, image_id FROM bx JOIN img USING (image_id)), p AS (SELECT class_id, count(*) AS n, count(DISTINCT image_id) AS i, count(*) FILTER (split = 'train') AS t, count(*) FILTER (split = 'valid') AS va, count(*) FILTER (split = 'test') AS te FROM j GROUP BY class_id)
SELECT class_id, name, coalesce(n, 0) AS instances, coalesce(i, 0) AS class_images, coalesce(t, 0) AS instances_train, coalesce(va, 0) AS instances_valid, coalesce(te, 0) AS instances_test, round(coalesce(1e2 * n / sum(n) OVER (), 0e0), 9) AS percent FROM classes LEFT JOIN p USING (class_id)""")
def g2_class_report(v: Views) -> DataFrame:
    return S.class_report(v.pick(), v.bx, _classes(v)).withColumn("percent", F.round("percent", 9))


@query(f"WITH {IMG}, {BX} SELECT class_id, split, count(*) AS instances, count(DISTINCT image_id) AS images FROM bx JOIN img USING (image_id) GROUP BY class_id, split")
def g3_class_stats(v: Views) -> DataFrame:
    per = v.bx.join(v.pick(), "image_id").groupBy("class_id", "split", "image_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("class_id", "split").agg(F.sum("n").cast("bigint").alias("instances"), F.count(F.lit(1)).alias("images"))


_CHOSEN = [0, 1, 2, 3, 5, 7]


@query(f"""WITH {IMG}, {BX}, src AS (SELECT i.image_id, class_id FROM img i LEFT JOIN bx USING (image_id) WHERE split = 'train'), sub AS (SELECT * FROM src WHERE image_id % 3 = 0 AND class_id IN (0, 1, 2, 3, 5, 7)),
a AS (SELECT class_id, count(DISTINCT image_id) AS images_source, count(*) AS instances_source FROM src WHERE class_id IN (0, 1, 2, 3, 5, 7) GROUP BY class_id), b AS (SELECT class_id, count(DISTINCT image_id) AS images_subset, count(*) AS instances_subset FROM sub GROUP BY class_id),
t AS (SELECT (SELECT count(DISTINCT image_id) FROM src) AS si, (SELECT count(class_id) FROM src) AS sn, (SELECT count(DISTINCT image_id) FROM sub) AS ui, (SELECT count(*) FROM sub) AS un)
SELECT class_id, images_source, round(1e2 * images_source / si, 9) AS images_source_percent, instances_source, round(1e2 * instances_source / sn, 9) AS instances_source_percent, coalesce(images_subset, 0) AS images_subset, round(1e2 * coalesce(images_subset, 0) / ui, 9) AS images_subset_percent, coalesce(instances_subset, 0) AS instances_subset, round(1e2 * coalesce(instances_subset, 0) / un, 9) AS instances_subset_percent
FROM a LEFT JOIN b USING (class_id), t""")
def g6_subset_report(v: Views) -> DataFrame:
    """Every third picture that has a chosen class is the subset."""
    source = v.pick().where("split = 'train'").select("image_id").join(v.bx.select("image_id", "class_id"), "image_id", "left")
    subset = source.where((F.col("image_id") % 3 == 0) & F.col("class_id").isin(*_CHOSEN))
    out = S.subset_report(source, subset, _CHOSEN)
    return out.withColumns({c: F.round(c, 9) for c in out.columns if c.endswith("percent")})


@query(f"""WITH {IMG}, r AS (SELECT dataset, split, excluded, stage, CASE WHEN excluded THEN coalesce(nullif(stage, ''), '(no stage)') END AS criterion FROM img)
SELECT stage, criterion, dataset, split, (grouping(stage) * 8 + grouping(criterion) * 4 + grouping(dataset) * 2 + grouping(split))::INT AS level, count(*) AS n, count(*) FILTER (excluded) AS n_excluded, count(*) FILTER (NOT coalesce(excluded, FALSE)) AS n_kept
FROM r GROUP BY GROUPING SETS ((stage), (criterion), (dataset, criterion), (dataset), (split), ())""")
def g9_index_report(v: Views) -> DataFrame:
    img = v.pick(excluded=F.col("excluded"), stage=F.col("exclusion_stage"))
    return S.index_report(img.withColumn("criterion", F.when(F.col("excluded"), F.coalesce(F.nullif(F.col("stage"), F.lit("")), F.lit("(no stage)")))))


@query(f"WITH {IMG} SELECT count(*) AS n, min(width)::DOUBLE AS min_width, median(width) AS median_width, max(width)::DOUBLE AS max_width, min(height)::DOUBLE AS min_height, median(height) AS median_height, max(height)::DOUBLE AS max_height, count(DISTINCT (width, height)) AS resolutions FROM img WHERE width > 0 AND height > 0")
def g10_dimensions(v: Views) -> DataFrame:
    return S.dimension_stats(v.pick(width=F.col("width"), height=F.col("height")))


@query(f"""WITH {IMG}, {BX}, n AS (SELECT image_id, count(*) AS n FROM bx GROUP BY image_id), d AS (SELECT dataset, count(*) AS images, coalesce(sum(n), 0)::BIGINT AS boxes FROM img LEFT JOIN n USING (image_id) GROUP BY dataset)
SELECT dataset, images, boxes, round(boxes / images, 9) AS mean_boxes, round(1e2 * images / sum(images) OVER (), 9) AS images_percent, round(1e2 * boxes / sum(boxes) OVER (), 9) AS boxes_percent FROM d""")
def g11_contributions(v: Views) -> DataFrame:
    out = S.contributions(v.pick(), v.bx)
    return out.withColumns({c: F.round(c, 9) for c in ("mean_boxes", "images_percent", "boxes_percent")})


@query(f"WITH {IMG}, {BX}, n AS (SELECT image_id, count(*) AS n FROM bx GROUP BY image_id) SELECT coalesce(n, 0) AS n_boxes, count(*) AS images FROM img LEFT JOIN n USING (image_id) GROUP BY 1")
def g12_annotation_histogram(v: Views) -> DataFrame:
    return S.annotation_stats(v.pick(), v.bx)


def _q(value: str, name: str, ps: tuple = (0.1, 0.5, 0.9)) -> str:
    return ", ".join(f"round(quantile_cont({value}, {p}), 9) AS {name}_p{int(p * 100)}" for p in ps)


@query(f"WITH {BX}, a AS (SELECT class_id, w * h AS area FROM bx) SELECT class_id, count(*) AS n, min(area) AS area_min, {_q('area', 'area')}, round(avg(area), 9) AS area_mean, max(area) AS area_max, {_q('sqrt(area)', 'side')} FROM a GROUP BY class_id")
def g13_size_bands(v: Views) -> DataFrame:
    return S.size_bands(v.bx.select("class_id", (F.col("w") * F.col("h")).alias("area")), ["class_id"], Scratch(v.spark, "g13"))


_EDGES = S.log_edges(DEFAULTS.faraway_area, DEFAULTS.closeup_area)


@query(f"WITH {BX}, b AS (SELECT CASE {' '.join(f'WHEN w * h >= {a!r}::DOUBLE AND w * h < {repr(b) if b != float('inf') else chr(39) + 'inf' + chr(39)}::DOUBLE THEN {i}' for i, (a, b) in enumerate(zip(_EDGES[:-1], _EDGES[1:])))} END AS bin FROM bx) SELECT r::INT AS bin, count(b.bin) AS n FROM range(0, 10) t(r) LEFT JOIN b ON b.bin = r GROUP BY r")
def g14_size_histogram(v: Views) -> DataFrame:
    return S.histogram(v.bx.select((F.col("w") * F.col("h")).alias("area")), "area", _EDGES)


@query()
def g15_size_groups(v: Views) -> DataFrame:
    """Target boxes in groups by the logarithm of their area, as many as the elbow says: boxes, middle and ends."""
    areas = v.bx.where(F.col("class_id") == DEFAULTS.target_class).select(F.log10(F.col("w") * F.col("h")).alias("log_area"))
    got = S.grouped_values(areas, "log_area", Scratch(v.spark, "g15"))
    return got.select("group", "n", *(F.round(F.pow(F.lit(10.0), c), 9).alias(name) for c, name in (("centre", "area"), ("least", "area_from"), ("most", "area_to"))))


_P5 = (0.05, 0.25, 0.5, 0.75, 0.95)


@query(f"""WITH {IMG}, {BX}, t AS (SELECT * FROM bx WHERE class_id = 80), n AS (SELECT image_id, count(*) AS n FROM t GROUP BY image_id), p AS (SELECT split, coalesce(n, 0) AS n FROM img LEFT JOIN n USING (image_id)),
c AS (SELECT split, count(*) AS images, count(*) FILTER (n > 0) AS with_target, sum(n)::BIGINT AS instances, {', '.join(f'count(*) FILTER (n {"=" if i < 5 else ">="} {i}) AS n_{i}' for i in range(6))} FROM p GROUP BY split),
z AS (SELECT split, w * h * 1e2 AS a, greatest(w, h) AS l, w * width * h * height AS px FROM img JOIN t USING (image_id)),
s AS (SELECT split, {_q('a', 'area', _P5)}, {_q('l', 'side', _P5)}, count(*) FILTER (px < 1024) AS small, count(*) FILTER (px >= 1024 AND px < 9216) AS medium, count(*) FILTER (px >= 9216) AS large FROM z GROUP BY split)
SELECT * FROM c LEFT JOIN s USING (split)""")
def g19_split_stats(v: Views) -> DataFrame:
    return S.split_stats(v.pick(width=F.col("width"), height=F.col("height")), v.bx, Scratch(v.spark, "g19"))


@query(f"""WITH {IMG}, {BX}, {SB}, {DET} SELECT class_id, count(*) FILTER (conf >= 45e-2) AS kept, count(*) FILTER (conf < 45e-2) AS dropped, round(avg(conf), 9) AS mean_conf FROM det GROUP BY class_id""")
def g22_detection_totals(v: Views) -> DataFrame:
    return v.det.groupBy("class_id").agg(F.count_if(F.col("conf") >= 0.45).alias("kept"), F.count_if(F.col("conf") < 0.45).alias("dropped"), F.round(F.avg("conf"), 9).alias("mean_conf"))


@query(f"""WITH {LOG}, items AS (SELECT DISTINCT 'picture_' || user_id AS name, 'ds' || (user_id % 7) AS dataset FROM events)
SELECT dataset, count(*) FILTER (decision = 'select') AS n_select, count(*) FILTER (decision = 'discard') AS n_discard, count(*) FILTER (coalesce(decision, '') NOT IN ('select', 'discard')) AS n_todo, count(*) AS n FROM items LEFT JOIN decided USING (name) GROUP BY dataset""")
def g23_review_counts(v: Views) -> DataFrame:
    items = v.table("events").select(F.concat(F.lit("picture_"), F.col("user_id")).alias("name"), F.concat(F.lit("ds"), F.col("user_id") % 7).alias("dataset")).distinct()
    return R.review_counts(items, R.current_decisions(v.decisions), ["dataset"])


@query()
def h1_balanced_split(v: Views) -> DataFrame:
    """A train and valid side for every picture; groups of related pictures stay together."""
    scratch = Scratch(v.spark, "h1")
    grouped = scratch.keep(H.related_groups(v.img.select("image_id", "dataset", "clip", "base"), scratch, ["dataset", "clip"], "base").select("image_id", "dataset", "group_id"))
    return H.balanced_split(grouped, scratch).select("image_id", "group_id", "side")


@query()
def h3_quota_subset(v: Views) -> DataFrame:
    n = v.bx.where(F.col("class_id").isin(*_CHOSEN)).select("image_id", "class_id").distinct()
    scratch = Scratch(v.spark, "h3")
    n = scratch.keep(n)
    return H.quota_subset(n, _CHOSEN, budget=n.select("image_id").distinct().count() // 4, least=50, scratch=scratch)


@query(f"WITH {BX} SELECT DISTINCT image_id FROM bx WHERE class_id IN (0, 1, 2, 3, 5, 7)")
def h4_with_classes(v: Views) -> DataFrame:
    return v.bx.where(F.col("class_id").isin(*_CHOSEN)).select("image_id").distinct()


@query(f"WITH {IMG} SELECT image_id, dataset FROM img WHERE split = 'train' ORDER BY md5('42:' || image_id), image_id LIMIT 500")
def h6_seeded_sample(v: Views) -> DataFrame:
    return H.sample(v.pick().where("split = 'train'"), 500, "image_id", Scratch(v.spark, "h6")).select("image_id", "dataset")


@query(f"WITH {IMG}, u AS (SELECT dataset, split FROM img, range(0, 3) WHERE split = 'train' UNION ALL SELECT dataset, split FROM img WHERE split = 'valid') SELECT dataset, split, count(*) AS n FROM u GROUP BY ALL")
def h8_replicated(v: Views) -> DataFrame:
    img = v.pick()
    return H.replicate(img.where("split = 'train'"), 3, img.where("split = 'valid'")).groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {IMG}, {BX}, k AS (SELECT image_id, count(*) AS n FROM bx WHERE class_id IN (0, 80) GROUP BY image_id) SELECT dataset, count(*) AS images, sum(n)::BIGINT AS boxes FROM img JOIN k USING (image_id) WHERE split <> 'test' GROUP BY dataset")
def h9_filtered_merge(v: Views) -> DataFrame:
    k = v.bx.where("class_id IN (0, 80)").groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    return v.pick().where("split <> 'test'").join(k, "image_id").groupBy("dataset").agg(F.count(F.lit(1)).alias("images"), F.sum("n").cast("bigint").alias("boxes"))


@query(f"WITH {IMG} SELECT file AS name, count(DISTINCT dataset || '/' || split) AS paths FROM img GROUP BY file HAVING paths > 1")
def h12_name_guard(v: Views) -> DataFrame:
    img = v.pick(file=N.path_file(F.col("image_path")))
    return H.name_clashes(img.select(F.concat_ws("/", "dataset", "split", "file").alias("path"), "file"), "path", F.col("file"))


def _matched(v: Views) -> DataFrame:
    return M.exclusive_matches(v.sb, v.det)


def _average_precision(v: Views, scratch: Scratch) -> DataFrame:
    return E.mean_average_precision(v.sb, v.det, M.matches_by_threshold(v.sb, v.det, scratch, E.IOU_THRESHOLDS), scratch)


@query(f"""WITH RECURSIVE {IMG}, {BX}, {SB}, {DET}, truth AS (SELECT * FROM sb WHERE class_id = 80), guess AS (SELECT * FROM det WHERE class_id = 80 AND conf >= 25e-2), {greedy_sql('truth', 'guess', '5e-1')},
a AS (SELECT TRUE AS gt, pixels, EXISTS (SELECT 1 FROM won w WHERE w.image_id = t.image_id AND w.class_id = t.class_id AND w.gt = t.ord) AS hit FROM truth t
  UNION ALL SELECT FALSE, pixels, EXISTS (SELECT 1 FROM won w WHERE w.image_id = s.image_id AND w.class_id = s.class_id AND w.ord = s.ord) FROM guess s),
b AS (SELECT *, CASE WHEN pixels < 1024 THEN 'small' WHEN pixels < 9216 THEN 'medium' ELSE 'large' END AS bucket FROM a)
SELECT bucket, count(*) FILTER (gt AND hit) AS tp, count(*) FILTER (gt AND NOT hit) AS fn, count(*) FILTER (NOT gt AND NOT hit) AS fp, count(*) FILTER (gt AND hit) / nullif(count(*) FILTER (gt), 0) AS recall FROM b GROUP BY bucket""")
def i1_size_breakdown(v: Views) -> DataFrame:
    return E.size_breakdown(M.exclusive_matches(v.sb.where("class_id = 80"), v.det.where("class_id = 80 AND conf >= 0.25")))


@query()
def i2_average_precision(v: Views) -> DataFrame:
    """AP at an overlap of 0.5, and the mean over 0.5 to 0.95; i4 has precision and recall."""
    return _average_precision(v, Scratch(v.spark, "i2"))


@query(f"""WITH {IMG}, {BX}, {SB}, {DET}, b AS (SELECT a.split, a.image_id, a.ord, coalesce(max(d.conf), 0e0) AS conf FROM sb a LEFT JOIN (SELECT * FROM det WHERE class_id = 80) d ON a.image_id = d.image_id AND {iou_sql('a', 'd')} >= 5e-1 WHERE a.class_id = 80 GROUP BY ALL)
SELECT count(*) FILTER (conf = 0) AS missed, count(*) FILTER (conf > 0 AND conf < 25e-2) AS weak, count(*) FILTER (conf >= 25e-2) AS ok, round(count(*) FILTER (conf > 0) / greatest(count(*), 1), 9) AS recall FROM b""")
def i3_mining_totals(v: Views) -> DataFrame:
    b = M.best_confidence(v.sb.where("class_id = 80").select("image_id", "ord", "b"), v.det.where("class_id = 80"))
    n = lambda s: F.count_if(F.col("status") == s)
    return b.agg(n("missed").alias("missed"), n("weak").alias("weak"), n("ok").alias("ok"), F.round((n("weak") + n("ok")) / F.greatest(F.count(F.lit(1)), F.lit(1)), 9).alias("recall"))


@query()
def i4_curve_at_confidence(v: Views) -> DataFrame:
    """Precision and recall at a confidence of 0.5, null for a class of no predictions, and the APs."""
    scratch = Scratch(v.spark, "i4")
    curve = E.at_confidence(E.precision_recall(_matched(v), scratch), 0.5)
    return _average_precision(v, scratch).drop("positives").join(curve, "class_id", "left").select("class_id", "precision", "recall", "ap50", "ap50_95")


@query()
def i5_class_means(v: Views) -> DataFrame:
    scratch = Scratch(v.spark, "i5")
    ap = E.average_precision(_matched(v), scratch)
    strict = E.average_precision(M.exclusive_matches(v.sb, v.det, 0.75), scratch)
    return E.class_means(E.compare_classes(ap, strict).withColumnRenamed("delta", "ap"), [])


@query(f"""WITH {RUNS} SELECT epoch, a.map50, a.map50_95, b.map50 AS base_map50, b.map50_95 AS base_map50_95, round(a.map50 - b.map50, 9) AS delta50, round(a.map50_95 - b.map50_95, 9) AS delta50_95, CASE WHEN b.map50 IS NULL THEN '(baseline stopped)' ELSE 'compared' END AS state
FROM (SELECT * FROM runs WHERE run = 'click') a LEFT JOIN (SELECT * FROM runs WHERE run = 'view' AND epoch < 15) b USING (epoch)""")
def j1_compare_curves(v: Views) -> DataFrame:
    r = v.runs
    return J.compare_curves(r.where("run = 'click'"), r.where("run = 'view' AND epoch < 15")).withColumns({"delta50": F.round("delta50", 9), "delta50_95": F.round("delta50_95", 9)})


@query(f"WITH {RUNS} SELECT run, arg_max(epoch, (map50_95, -epoch)) AS best_epoch, max(map50_95) AS best_map50_95, max(epoch) AS last_epoch, round(arg_max(time, epoch) / 36e2, 9) AS hours, count(*) AS epochs FROM runs GROUP BY run")
def j2_milestones(v: Views) -> DataFrame:
    return J.best_epoch(v.runs).withColumn("hours", F.round("hours", 9))


@query("SELECT event_type AS run, arg_max(event_id::VARCHAR, (ts, event_id::VARCHAR)) AS path FROM events GROUP BY event_type")
def j6_latest_checkpoint(v: Views) -> DataFrame:
    files = v.table("events").select(F.col("event_type").alias("run"), F.col("event_id").cast("string").alias("path"), F.col("ts").alias("mtime"))
    return J.latest(files, "run").select("run", "path")


@query(f"WITH {CAT}, p AS (SELECT project_id, try_cast(trim(version) AS INT) AS version, coalesce(contains(notes, 'dense'), FALSE) AS augmented FROM datasets_to_download) SELECT project_id, arg_max(version, (NOT augmented, version)) AS version FROM p WHERE version IS NOT NULL GROUP BY project_id")
def a50_preferred_version(v: Views) -> DataFrame:
    t = v.table("datasets_to_download").select("project_id", F.trim("version").try_cast("int").alias("version"), F.coalesce(F.contains("notes", F.lit("dense")), F.lit(False)).alias("augmented"))
    return J.preferred_version(t.where("version IS NOT NULL"))


@query(f"WITH {LOG} SELECT * FROM decided")
def k2_current_decisions(v: Views) -> DataFrame:
    return R.current_decisions(v.decisions)


@query(f"WITH {LOG} SELECT name, arg_min(value, seq) AS value FROM log GROUP BY name")
def k3_first_version(v: Views) -> DataFrame:
    return R.first_version(v.decisions, "value")


@query()
def k6_placement(v: Views) -> DataFrame:
    """Errors among the events stand for undo."""
    log = v.table("events").select(F.col("event_id").alias("seq"), F.when(F.col("event_type") == "error", "undo").when(F.col("event_type") == "signup", "exclude").otherwise("move").alias("action"), F.concat(F.lit("picture_"), F.col("user_id")).alias("name"), F.lit("train").alias("from_split"))
    return R.placement(log, Scratch(v.spark, "k6")).select("name", "action")


@query(f"""WITH {IMG}, {BX}, {SB}, i AS (SELECT image_id, ord, (x2 - x1) * (y2 - y1) AS area FROM sb WHERE x1 <= 320 AND x2 >= 320 AND y1 <= 240 AND y2 >= 240) SELECT image_id, arg_min(ord, (area, ord)) AS ord, round(min(area), 6) AS area FROM i GROUP BY image_id""")
def k10_hit_test(v: Views) -> DataFrame:
    return R.hit_box(v.sb, 320, 240).withColumn("area", F.round("area", 6))


@query(f"WITH {IMG}, {BX}, c AS (SELECT split, class_id, count(*) AS n FROM bx JOIN img USING (image_id) GROUP BY ALL) SELECT split, array_to_string(list_sort(list(class_id)), ',') AS classes, sum(n)::BIGINT AS n FROM c GROUP BY split")
def k5_split_state(v: Views) -> DataFrame:
    c = v.bx.join(v.pick(), "image_id").groupBy("split", "class_id").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("split").agg(F.array_join(F.sort_array(F.collect_list("class_id")).cast("array<string>"), ",").alias("classes"), F.sum("n").cast("bigint").alias("n"))


def _stream_dir(v: Views, name: str) -> str:
    import uuid

    return f"{shared_dir(v.spark).rstrip('/')}/frameloom-stream-{name}-{uuid.uuid4().hex}"


@query(f"WITH {RUNS} SELECT run, epoch, map50 FROM runs WHERE epoch % 5 = 0")
def l1_followed_metrics(v: Views) -> DataFrame:
    """Result files that arrive are followed by a stream, which acts on every fifth epoch once."""
    from frameloom.streaming.ingest import follow_metrics

    d = _stream_dir(v, "l1")
    v.runs.select("run", "epoch", "time", "map50", "map50_95").write.option("header", "true").csv(f"{d}/in")
    follow_metrics(v.spark, f"{d}/in", f"{d}/state", 5, lambda df: df.write.mode("append").parquet(f"{d}/out"), once=True).awaitTermination()
    return v.spark.read.schema("run string, epoch int, time double, map50 double, map50_95 double").parquet(f"{d}/out").select("run", "epoch", "map50")


@query("SELECT event_type, count(*) AS n, max(event_id) AS last FROM events WHERE value IS NOT NULL GROUP BY event_type")
def l3_incremental_cache(v: Views) -> DataFrame:
    """Two runs of an incremental stream over growing input take each file once."""
    from frameloom.streaming.ingest import incremental

    d = _stream_dir(v, "l3")
    schema = "event_id bigint, event_type string, value double"
    e = v.table("events").select("event_id", "event_type", "value")
    keep = lambda df: df.where("value IS NOT NULL").select("event_id", "event_type")
    for part in (0, 1):
        e.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{d}/in")
        incremental(v.spark, f"{d}/in", schema, f"{d}/out", f"{d}/state", keep).awaitTermination()
    return v.spark.read.parquet(f"{d}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))
