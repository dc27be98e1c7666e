"""Further queries: datasets as views, small reports, review helpers, model leaves, whole pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.catalogue import pairs  # noqa: F401  (its SQL is used here)
from frameloom.catalogue.registry import QUERIES, SQL, query
from frameloom.catalogue.views import BX, CAT, DET, EFF, H, IMG, LOG, RUNS, SB, Views, containment_sql, iou_sql
from frameloom.functions import geometry as G
from frameloom.functions import names as N
from frameloom.functions import text as T
from frameloom.operators import curate as C
from frameloom.operators import matching as M
from frameloom.operators import media
from frameloom.operators import review as R
from frameloom.operators import sampling as S
from frameloom.operators.graph import connected_components
from frameloom.plans.scratch import Scratch
from frameloom.plans.selection import select
from frameloom.sources import sinks

ITEMS = "items AS (SELECT DISTINCT 'picture_' || user_id AS name, 'ds' || (user_id % 7) AS dataset FROM events)"


def _items(v: Views) -> DataFrame:
    return v.table("events").select(F.concat(F.lit("picture_"), F.col("user_id")).alias("name"), F.concat(F.lit("ds"), F.col("user_id") % 7).alias("dataset")).distinct()


@query(f"WITH {LOG}, bag AS (SELECT 'picture_' || user_id AS path FROM events UNION ALL SELECT name FROM decided) SELECT path, count(*) AS n FROM bag GROUP BY path")
def a10_manifest_bag(v: Views) -> DataFrame:
    """Lines of two lists as a bag: repeats count."""
    bag = v.table("events").select(F.concat(F.lit("picture_"), F.col("user_id")).alias("path")).unionByName(R.current_decisions(v.decisions).select(F.col("name").alias("path")))
    return bag.groupBy("path").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {LOG}, {ITEMS} SELECT name, dataset FROM items WHERE name IN (SELECT trim(name) FROM decided WHERE decision = 'reserve')")
def a16_rescue_set(v: Views) -> DataFrame:
    rescued = R.current_decisions(v.decisions).where("decision = 'reserve'").select(F.trim("name").alias("name")).distinct()
    return _items(v).join(rescued, "name", "left_semi")


@query(f"""WITH {CAT} SELECT dataset, '| ' || concat_ws(' | ', dataset, coalesce(workspace_id, '-'), CASE WHEN enabled THEN 'yes' ELSE 'no' END, coalesce(array_to_string(class_names, ', '), '-'), coalesce(variety_min::VARCHAR, '-'), coalesce(closeup::VARCHAR, '-'), coalesce(faraway::VARCHAR, '-'), coalesce(phash_max::VARCHAR, '-')) || ' |' AS line FROM cat""")
def a23_catalog_markdown(v: Views) -> DataFrame:
    return sinks.catalog_markdown(v.cat)


@query(f"WITH {CAT}, {IMG}, {BX}, {SB}, p AS (SELECT image_id, dataset, file, ord, x1, y2 FROM sb JOIN img USING (image_id, dataset, file) WHERE class_id = 0) SELECT dataset, file, count(*) AS people, round(min(x1), 6) AS left_most FROM p GROUP BY dataset, file")
def a30_people_by_file(v: Views) -> DataFrame:
    files = v.pick(file=N.path_file(F.col("image_path"))).select("image_id", "file")
    return v.sb.where("class_id = 0").join(files, "image_id").groupBy("dataset", "file").agg(F.count(F.lit(1)).alias("people"), F.round(F.min("b.x1"), 6).alias("left_most"))


@query(rf"WITH {IMG}, {BX} SELECT dataset, file AS \"to\", regexp_replace(file, '\.[^.]*$', '') || '.txt' AS label, image_id IN (SELECT image_id FROM bx) AS has_label FROM img WHERE split = 'valid'".replace('\\"', '"'))
def a39_copy_plan(v: Views) -> DataFrame:
    img = v.pick(path=F.translate(F.col("image_path"), "\\", "/")).where("split = 'valid'")
    return sinks.copy_plan(img.drop("to"), v.bx).join(img.select("path", "dataset").distinct(), "path").select("dataset", "to", "label", "has_label")


@query(f"WITH {BX} SELECT class_id, count(DISTINCT image_id) AS images, count(*) AS boxes FROM bx WHERE class_id IN (0, 80) GROUP BY class_id")
def a41_virtual_dataset(v: Views) -> DataFrame:
    return sinks.virtual_dataset(v.bx, [0, 80]).groupBy("class_id").agg(F.countDistinct("image_id").alias("images"), F.count(F.lit(1)).alias("boxes"))


@query(f"WITH {IMG}, {BX}, m AS (SELECT image_id, box_ord, CASE class_id WHEN 80 THEN 0 ELSE 1 END AS class_id FROM bx WHERE class_id IN (80, 0)) SELECT split, class_id, count(*) AS n FROM img LEFT JOIN m USING (image_id) GROUP BY split, class_id")
def a42_filtered_dataset(v: Views) -> DataFrame:
    mapped = C.remap_classes(v.bx, [80, 0]).select("image_id", "box_ord", "class_id")
    return sinks.filtered_dataset(v.pick().select("image_id", "split"), mapped).groupBy("split", "class_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {IMG}, t AS (SELECT file, min(image_id) AS image_id FROM img WHERE split = 'train' GROUP BY file), v AS (SELECT image_id, file FROM img WHERE split = 'valid') SELECT v.image_id, v.file IN (SELECT file FROM t) AS clash FROM v")
def a59_merge_guard(v: Views) -> DataFrame:
    """Pictures to be merged into a split, and whether their names are taken there."""
    img = v.pick(file=N.path_file(F.col("image_path")))
    taken = img.where("split = 'train'").select("file", F.lit(True).alias("clash")).distinct()
    return img.where("split = 'valid'").join(taken, "file", "left").select("image_id", F.coalesce("clash", F.lit(False)).alias("clash"))


@query(f"WITH {IMG} SELECT image_id, dataset FROM img WHERE excluded AND stage = 'cheap' ORDER BY md5('7:' || image_id), image_id LIMIT 200")
def b8_index_sample(v: Views) -> DataFrame:
    rows = C.where_user(v.pick(excluded=F.col("excluded"), stage=F.col("exclusion_stage")), "excluded AND stage = 'cheap'")
    return S.sample(rows, 200, "image_id", Scratch(v.spark, "b8"), 7).select("image_id", "dataset")


@query(f"WITH {LOG}, {ITEMS} SELECT name, CASE WHEN decision IN ('select', 'discard') THEN decision ELSE 'todo' END AS status FROM items LEFT JOIN decided USING (name)")
def b33_status(v: Views) -> DataFrame:
    return R.view(_items(v).withColumn("classes", F.lit(None).cast("array<int>")), R.current_decisions(v.decisions)).select("name", "status")


_BACKUP = "old AS (SELECT image_id, box_ord, class_id + (box_ord % 4 = 3)::INT AS class_id, w FROM bx WHERE image_id % 2 = 0)"


@query(f"WITH {BX}, {_BACKUP}, a AS (SELECT image_id, list({{'o': box_ord, 'c': class_id, 'w': w}} ORDER BY box_ord) AS l FROM bx GROUP BY image_id), b AS (SELECT image_id, list({{'o': box_ord, 'c': class_id, 'w': w}} ORDER BY box_ord) AS l FROM old GROUP BY image_id) SELECT image_id, b.l IS NOT NULL AND a.l <> b.l AS modified, len(coalesce(b.l, a.l)) AS original_boxes FROM a LEFT JOIN b USING (image_id)")
def b35_modified_labels(v: Views) -> DataFrame:
    """Whether a label file differs from its backup, if it has one, and the boxes of the original."""
    listed = lambda d: d.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("box_ord", "class_id", "w"))).alias("l"))
    old = v.bx.where("image_id % 2 = 0").withColumn("class_id", F.col("class_id") + F.when(F.col("box_ord") % 4 == 3, 1).otherwise(0))
    j = listed(v.bx).join(listed(old).withColumnRenamed("l", "o"), "image_id", "left")
    return j.select("image_id", F.coalesce(F.col("o") != F.col("l"), F.lit(False)).alias("modified"), F.size(F.coalesce("o", "l")).cast("bigint").alias("original_boxes"))


@query(f"WITH {IMG}, {BX}, {SB} SELECT image_id, ord, round(least(y1, y2), 6) AS x1_90, round(least(width - 1 - x1, width - 1 - x2), 6) AS y1_90, round(least(height - 1 - y1, height - 1 - y2), 6) AS x1_270 FROM sb")
def c17_turned_boxes(v: Views) -> DataFrame:
    turn = lambda d: G.rotated(F.col("b"), F.lit(d), F.col("width"), F.col("height"))
    s = v.sb.withColumns({"t90": turn(90), "t270": turn(270)})
    return s.select("image_id", "ord", F.round("t90.x1", 6).alias("x1_90"), F.round("t90.y1", 6).alias("y1_90"), F.round("t270.x1", 6).alias("x1_270"))


@query(f"WITH {RUNS} SELECT run, epoch, 'mAP50 ' || printf('%.3f', map50) AS line FROM runs")
def c32_metric_lines(v: Views) -> DataFrame:
    return v.runs.select("run", "epoch", F.concat(F.lit("mAP50 "), T.three_places(F.col("map50"))).alias("line"))


@query()
def e9_detection_duplicates(v: Views) -> DataFrame:
    """Pictures of a dataset whose boxes match one by one at least four times, each with its group and the group's size."""
    scratch = Scratch(v.spark, "e9")
    b = v.bx.join(v.pick().select("image_id", "dataset"), "image_id").select("image_id", "dataset", "class_id", F.col("box_ord").alias("ord"), "xc", "yc", "w", "h")
    pairs = M.box_twins(b, scratch)
    comp = connected_components(pairs.select("a", F.col("z").alias("b")), scratch)
    size = comp.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return comp.join(size, "component").select(F.col("id").alias("image_id"), "component", "size")


@query(f"WITH {BX}, n AS (SELECT image_id, class_id, list({{'x': xc - w / 2e0, 'o': box_ord}} ORDER BY box_ord) AS l FROM bx GROUP BY image_id, class_id) SELECT image_id, class_id, len(l) AS n, round(l[1].x, 9) AS first_x FROM n")
def e10_boxes_by_class(v: Views) -> DataFrame:
    x = F.sort_array(F.collect_list(F.struct("box_ord", (F.col("xc") - F.col("w") / F.lit(2.0)).alias("x"))))
    return v.bx.groupBy("image_id", "class_id").agg(x.alias("l")).select("image_id", "class_id", F.size("l").cast("bigint").alias("n"), F.round(F.get("l", F.lit(0)).x, 9).alias("first_x"))


@query("SELECT 'picture_' || user_id AS path, min(event_id) AS ord FROM events GROUP BY user_id")
def e15_ordered_distinct(v: Views) -> DataFrame:
    return v.table("events").groupBy(F.concat(F.lit("picture_"), F.col("user_id")).alias("path")).agg(F.min("event_id").alias("ord"))


_TOP = "top AS (SELECT image_id, class_id, arg_max(box_ord, (CASE WHEN box_ord % 3 = 1 THEN 5e-1 ELSE -1e0 END, w * h, -box_ord)) AS top FROM bx GROUP BY ALL)"


@query(f"""WITH {IMG}, {BX}, {_TOP}, k AS (SELECT image_id, array_to_string(list_sort(list(DISTINCT class_id)), ',') AS classes FROM bx GROUP BY image_id),
q AS (SELECT bx.*, split, classes, xc - w / 2e0 AS x1, yc - h / 2e0 AS y1, xc + w / 2e0 AS x2, yc + h / 2e0 AS y2 FROM bx JOIN img USING (image_id) JOIN k USING (image_id)),
r AS (SELECT q.image_id, classes, class_id, FALSE AS mirrored, x1, y1, x2, y2 FROM q JOIN top USING (image_id, class_id) WHERE box_ord = top AND split = 'valid'),
r2 AS (SELECT * FROM r UNION ALL SELECT image_id, classes, class_id, TRUE, 1e0 - x2, y1, 1e0 - x1, y2 FROM r),
m AS (SELECT r2.image_id AS a, t.image_id AS b, mirrored, r2.class_id, max({iou_sql('r2', 't')}) AS s FROM r2 JOIN (SELECT * FROM q WHERE split = 'train') t USING (classes, class_id) GROUP BY ALL HAVING s >= 9e-1),
n AS (SELECT a, b, mirrored, count(*) AS n, sum(s) AS total FROM m GROUP BY ALL), o AS (SELECT a, b, arg_max({{'n': n, 't': total, 'm': mirrored}}, (n, total, NOT mirrored)) AS x FROM n GROUP BY a, b)
SELECT a, b, x.n AS overlaps, round(x.t / x.n, 6) AS iou FROM o""")
def e13_signature_overlaps(v: Views) -> DataFrame:
    """Valid and train pictures of equal class sets whose main boxes lie alike, straight or mirrored."""
    conf = F.when(F.col("box_ord") % 3 == 1, 0.5).otherwise(-1.0)
    b = v.bx.join(v.pick().select("image_id", "split"), "image_id")
    top = v.bx.groupBy("image_id", "class_id").agg(F.max_by("box_ord", F.struct(conf, F.col("w") * F.col("h"), -F.col("box_ord"))).alias("t"))
    b = b.join(top, ["image_id", "class_id"]).withColumns({"top": F.col("box_ord") == F.col("t"), "ord": F.col("box_ord")})
    return M.signature_overlaps(b.where("split = 'valid'"), b.where("split = 'train'")).select("a", "b", "overlaps", F.round("iou", 6).alias("iou"))


@query(f"""WITH {IMG}, dup AS (SELECT image_id FROM ({SQL['e5_duplicates']}) WHERE image_id <> keeper) SELECT dataset, count(dup.image_id) AS excluded, count(*) AS total FROM img LEFT JOIN dup USING (image_id) GROUP BY dataset""")
def e8_duplicate_counts(v: Views) -> DataFrame:
    """Per dataset how many pictures are excluded as duplicates, of how many."""
    dup = QUERIES["e5_duplicates"](v.spark, v.dir).where("image_id <> keeper").select("image_id", F.lit(True).alias("x"))
    return v.pick().join(dup, "image_id", "left").groupBy("dataset").agg(F.count("x").alias("excluded"), F.count(F.lit(1)).alias("total"))


@query(f"WITH {BX}, n AS (SELECT class_id, count(*) AS n FROM bx GROUP BY class_id) SELECT class_id, n FROM n ORDER BY n DESC, class_id LIMIT 40")
def f7_top_classes(v: Views) -> DataFrame:
    return v.bx.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "class_id").limit(40)


@query(f"WITH {BX}, n AS (SELECT class_id, count(*) AS n FROM bx GROUP BY class_id), r AS (SELECT class_id, n, row_number() OVER (ORDER BY n DESC, class_id)::INT AS by_frequency, row_number() OVER (ORDER BY class_id)::INT AS by_id FROM n) SELECT *, by_frequency <= 5 OR by_frequency > (SELECT count(*) FROM n) - 5 AS shown FROM r")
def f8_class_orders(v: Views) -> DataFrame:
    """Classes by frequency and by number, and whether they are among the first or last five."""
    n = v.bx.groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    r = lambda *o: F.row_number().over(Window.orderBy(*o))  # noqa: E731  (a row per class)
    return n.select("class_id", "n", r(F.col("n").desc(), "class_id").alias("by_frequency"), r("class_id").alias("by_id"), F.count(F.lit(1)).over(Window.partitionBy()).alias("all_")).withColumn("shown", (F.col("by_frequency") <= 5) | (F.col("by_frequency") > F.col("all_") - 5)).drop("all_")


@query(f"WITH {RUNS}, d AS (SELECT epoch, round((b.map50 - a.map50) * 1e2, 6) AS delta FROM (SELECT * FROM runs WHERE run = 'view') a JOIN (SELECT * FROM runs WHERE run = 'purchase') b USING (epoch)) SELECT * FROM d ORDER BY delta, epoch LIMIT 10")
def f10_worst_regressions(v: Views) -> DataFrame:
    r = v.runs
    d = r.where("run = 'view'").select("epoch", F.col("map50").alias("a")).join(r.where("run = 'purchase'").select("epoch", F.col("map50").alias("b")), "epoch")
    return d.select("epoch", F.round((F.col("b") - F.col("a")) * F.lit(100.0), 6).alias("delta")).orderBy("delta", "epoch").limit(10)


@query(f"WITH {LOG}, {ITEMS} SELECT dataset, min(name) FILTER (decision IS NULL) AS first FROM items LEFT JOIN decided USING (name) GROUP BY dataset")
def f13_first_undecided(v: Views) -> DataFrame:
    return _items(v).join(R.current_decisions(v.decisions), "name", "left").groupBy("dataset").agg(F.min(F.when(F.col("decision").isNull(), F.col("name"))).alias("first"))


@query(f"WITH {IMG}, {BX} SELECT class_id, count(*) AS instances, count(DISTINCT image_id) AS images, count(DISTINCT dataset) AS datasets FROM bx JOIN img USING (image_id) GROUP BY class_id")
def g5_review_class_stats(v: Views) -> DataFrame:
    per = v.bx.join(v.pick().select("image_id", "dataset"), "image_id").groupBy("class_id", "dataset", "image_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("class_id").agg(F.sum("n").cast("bigint").alias("instances"), F.count(F.lit(1)).alias("images"), F.countDistinct("dataset").alias("datasets"))


@query(f"WITH {IMG}, {BX} SELECT split, round(avg(CASE WHEN w * h >= 1e-2 AND w * h < 1e-1 THEN 1e0 ELSE 0e0 END), 9) AS middle FROM bx JOIN img USING (image_id) GROUP BY split")
def g21_share_in_range(v: Views) -> DataFrame:
    a = F.col("w") * F.col("h")
    return v.bx.join(v.pick().select("image_id", "split"), "image_id").groupBy("split").agg(F.round(F.avg(F.when((a >= 0.01) & (a < 0.1), 1.0).otherwise(0.0)), 9).alias("middle"))


@query(f"WITH {IMG} SELECT split, count(*) AS n, count(*) FILTER (excluded) AS excluded, count(DISTINCT dataset) AS datasets FROM img GROUP BY split")
def g28_state_counts(v: Views) -> DataFrame:
    return v.pick(excluded=F.col("excluded")).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_if("excluded").alias("excluded"), F.countDistinct("dataset").alias("datasets"))


@query("SELECT image_id, box_ord, class_id FROM (SELECT DISTINCT image_id, box_ord, class_id FROM boxes) b WHERE NOT EXISTS (SELECT 1 FROM image_index i WHERE i.image_id = b.image_id)")
def g30_missing_on_disk(v: Views) -> DataFrame:
    there = v.table("image_index").select("image_id")
    return v.table("boxes").select("image_id", "box_ord", "class_id").distinct().join(there, "image_id", "left_anti")


@query(f"WITH {IMG}, n AS (SELECT dataset, image_id, row_number() OVER (PARTITION BY dataset ORDER BY md5('42:' || image_id), image_id) AS r, count(*) OVER (PARTITION BY dataset) AS n FROM img) SELECT image_id, CASE WHEN r <= CAST(round_even(n * 15e-2, 0) AS BIGINT) THEN 'valid' ELSE 'train' END AS side FROM n")
def h2_split_without_groups(v: Views) -> DataFrame:
    """Per dataset the first 15 percent in the seeded order are valid; ranks are counted across range partitions."""
    from frameloom.plans.ranks import rank_in_groups

    img = v.pick().select("image_id", "dataset").withColumn("o", S.seeded(42, F.col("image_id")))
    scratch = Scratch(v.spark, "h2")
    ranked = rank_in_groups(img, ["dataset"], ["o", "image_id"], scratch, "nth")
    n = img.groupBy("dataset").agg(F.bround(F.count(F.lit(1)) * F.lit(0.15)).cast("bigint").alias("valid"))
    return ranked.join(n, "dataset").select("image_id", F.when(F.col("nth") < F.col("valid"), "valid").otherwise("train").alias("side"))


@query(f"WITH {RUNS} SELECT run, count(*) AS epochs, count(*) FILTER (map50 IS NULL) AS unfinished FROM runs GROUP BY run")
def j7_epochs(v: Views) -> DataFrame:
    return v.runs.groupBy("run").agg(F.count(F.lit(1)).alias("epochs"), F.count_if(F.col("map50").isNull()).alias("unfinished"))


@query(f"WITH {BX}, {IMG}, c AS (SELECT image_id, xc, yc, w, h, (xc - w / 2e0 < -1e-4) OR (yc - h / 2e0 < -1e-4) OR (xc + w / 2e0 > 1.0001e0) OR (yc + h / 2e0 > 1.0001e0) AS o, greatest(xc - w / 2e0, 0e0) < least(xc + w / 2e0, 1e0) AND greatest(yc - h / 2e0, 0e0) < least(yc + h / 2e0, 1e0) AS part FROM bx) SELECT count(*) FILTER (o AND part) AS clipped, count(*) FILTER (o AND NOT part) AS removed, count(DISTINCT CASE WHEN o THEN image_id END) AS files FROM c")
def k9_clip_counts(v: Views) -> DataFrame:
    """What clipping would do, without doing it."""
    c = C.clip_boxes(v.bx)
    return c.agg(F.count_if(F.col("action") == "clipped").alias("clipped"), F.count_if(F.col("action") == "removed").alias("removed"), F.countDistinct(F.when(F.col("action") != "kept", F.col("image_id"))).alias("files"))


@query("SELECT split, lower(name) AS name, count(*) AS n FROM (SELECT DISTINCT split_part(regexp_replace(image_path, '[/\\\\]+', '/', 'g'), '/', -3) AS split, split_part(regexp_replace(image_path, '[/\\\\]+', '/', 'g'), '/', -1) AS name, split_part(regexp_replace(image_path, '[/\\\\]+', '/', 'g'), '/', -4) AS d FROM image_index) GROUP BY ALL HAVING n > 1")
def k7_taken_names(v: Views) -> DataFrame:
    """Names that a move into one folder per split would overwrite."""
    path = F.col("image_path")
    d = v.table("image_index").select(N.path_split(path).alias("split"), N.path_file(path).alias("name"), N.path_dataset(path).alias("d")).distinct()
    return d.groupBy("split", F.lower("name").alias("name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(f"WITH {LOG}, {ITEMS}, t AS (SELECT name, decision, row_number() OVER (PARTITION BY dataset ORDER BY name) AS pos, dataset FROM items LEFT JOIN decided USING (name)) SELECT dataset, name, pos::INT AS pos, (min(pos) FILTER (decision IS NULL) OVER (PARTITION BY dataset ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))::INT AS next FROM t")
def k12_next_position(v: Views) -> DataFrame:
    """Of each item of a dataset's view the position, and that of the next undecided item."""
    w = Window.partitionBy("dataset").orderBy("name")
    t = _items(v).join(R.current_decisions(v.decisions), "name", "left").withColumn("pos", F.row_number().over(w))
    after = Window.partitionBy("dataset").orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    return t.select("dataset", "name", "pos", F.min(F.when(F.col("decision").isNull(), F.col("pos"))).over(after).alias("next"))


@query(f"WITH {IMG}, {H}, d AS (SELECT image_id, bit_count(xor(phash, phash_mirror))::INT AS d FROM hs WHERE phash IS NOT NULL AND phash_mirror IS NOT NULL) SELECT image_id, d, CASE WHEN d <= 12 THEN 'low' WHEN d <= 20 THEN 'mid' ELSE 'high' END AS band FROM d")
def k15_severity(v: Views) -> DataFrame:
    d = G.hamming(F.col("phash"), F.col("phash_mirror"))
    return v.h.where("phash IS NOT NULL AND phash_mirror IS NOT NULL").select("image_id", d.alias("d"), R.severity(d).alias("band"))


@query("SELECT event_type AS run, count(*) AS n FROM events WHERE event_id % 10 >= 5 GROUP BY event_type")
def l6_incremental_anti_join(v: Views) -> DataFrame:
    """Only what a cache of earlier results doesn't hold yet."""
    e = v.table("events")
    return e.join(e.where("event_id % 10 < 5").select("event_id"), "event_id", "left_anti").groupBy(F.col("event_type").alias("run")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {IMG}, {BX}, {SB}, {DET}, {CAT}, {EFF}, e1 AS (SELECT dataset, max(variety_min) AS least FROM eff GROUP BY dataset), n AS (SELECT image_id, count(*) AS n FROM det WHERE conf >= 45e-2 AND class_id <> 80 GROUP BY image_id),
r AS (SELECT DISTINCT a.image_id FROM sb a JOIN sb b ON a.image_id = b.image_id WHERE a.class_id = 80 AND b.class_id = 0 AND {containment_sql('a', 'b')} >= 3e-1 AND (a.y2 - a.y1) > 0 AND (b.y2 - b.y1) / (a.y2 - a.y1) > 1)
SELECT image_id, coalesce(n, 0) AS n_found, CASE WHEN coalesce(n, 0) < coalesce(least, 1) THEN 'too few' WHEN image_id IN (SELECT image_id FROM r) THEN 'rider' ELSE 'kept' END AS fate FROM img LEFT JOIN n USING (image_id) LEFT JOIN e1 USING (dataset)""")
def m1_variety_filter(v: Views) -> DataFrame:
    """Detections stand for a model's; pictures of too few objects go first, then those whose target box covers a rider."""
    least = C.effective(v.cat).groupBy("dataset").agg(F.max("variety_min").alias("least"))
    found = media.enough_detections(v.pick().join(least, "dataset", "left"), v.det.where("class_id <> 80"), F.coalesce("least", F.lit(1)), 0.45)
    riders = C.rider_pairs(v.sb.where("class_id = 80"), v.sb.where("class_id = 0")).select("image_id", F.lit(True).alias("rider")).distinct()
    return found.join(riders, "image_id", "left").select("image_id", "n_found", F.when(~F.col("enough"), "too few").when(F.col("rider"), "rider").otherwise("kept").alias("fate"))


@query(f"WITH {IMG}, v AS (SELECT image_id AS video, 100 + image_id % 50 AS n_frames FROM img) SELECT video, unnest(range(0, n_frames, 30)) AS idx FROM v")
def m4_sampled_frames(v: Views) -> DataFrame:
    return media.sampled_frames(v.pick().select(F.col("image_id").alias("video"), (F.lit(100) + F.col("image_id") % 50).alias("n_frames")), 30)


@query(f"WITH {IMG}, r AS (SELECT image_id, dataset, row_number() OVER (PARTITION BY dataset ORDER BY image_id) - 1 AS r, count(*) OVER (PARTITION BY dataset) AS n FROM img WHERE split = 'test') SELECT image_id, (r // 6)::INT AS sheet_row, (r % 6)::INT AS sheet_column, (ceil(n / 6e0) * 6)::BIGINT AS cells FROM r")
def m6_contact_sheets(v: Views) -> DataFrame:
    """Places on contact sheets of six columns, one sheet per dataset; ranks are counted across range partitions."""
    from frameloom.plans.ranks import rank_in_groups

    t = v.pick().where("split = 'test'").select("image_id", "dataset")
    ranked = rank_in_groups(t, ["dataset"], ["image_id"], Scratch(v.spark, "m6"), "r")
    row, column = media.sheet_positions(F.col("r"), 6)
    return ranked.join(t.groupBy("dataset").agg(F.count(F.lit(1)).alias("n")), "dataset").select("image_id", row.alias("sheet_row"), column.alias("sheet_column"), media.sheet_cells(F.col("n"), 6).alias("cells"))


@query()
def o3_selection(v: Views) -> DataFrame:
    images = v.img.select("image_id", "dataset", "split", "clip", "frame", "width", "height")
    return select(images, v.bx, v.sb, v.h, v.cat, Scratch(v.spark, "o3"))


@query(f"WITH {RUNS} SELECT DISTINCT run, 'text of ' || run || chr(10) || 'mine' AS readme FROM runs")
def j3_readme_merge(v: Views) -> DataFrame:
    """The generated part anew, the manual part after its end marker as it was."""
    old = v.runs.select("run").distinct().withColumn("old", F.concat(F.lit("old text<!-- end -->"), F.lit("mine")))
    return old.select("run", F.concat(F.lit("text of "), F.col("run"), F.lit("\n"), T.manual_part(F.col("old"), "<!-- end -->")).alias("readme"))
