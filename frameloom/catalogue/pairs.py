"""Queries on joins of boxes and pictures, duplicates, groups and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.catalogue.registry import query
from frameloom.catalogue.views import BX, CAT, DET, EFF, H, IMG, LOG, RUNS, SB, Views, area_sql, containment_sql, greedy_sql, iou_sql, overlap_sql
from frameloom.functions import geometry as G
from frameloom.functions import names as N
from frameloom.operators import curate as C
from frameloom.operators import matching as M
from frameloom.operators import review as R
from frameloom.operators.graph import connected_components
from frameloom.operators.sampling import in_all, related_groups
from frameloom.operators.sequences import selected_frames, thin_clips
from frameloom.operators.similarity import cross_split_groups, hamming_cross_pairs, hamming_links, hamming_self_pairs, nearest, same_name_pairs
from frameloom.params import DEFAULTS
from frameloom.plans.ranks import rank_in_groups
from frameloom.plans.scratch import Scratch

COMPONENTS = """
cc(v, g) USING KEY (v) AS (
  SELECT v, min(least(u, v)) FROM e GROUP BY v
  UNION
  SELECT e.v, min(least(a.g, b.g)) FROM e JOIN recurring.cc a ON a.v = e.v JOIN recurring.cc b ON b.v = e.u GROUP BY e.v, a.g HAVING min(b.g) < a.g)"""


@query(f"""WITH {CAT}, {IMG}, c AS (SELECT dataset, bool_or(enabled) AS enabled, bool_or(pinned) AS pinned, max(workspace_id) AS ws, TRUE AS c FROM cat GROUP BY dataset),
i AS (SELECT 'dataset_' || source_id AS x, source_id AS dataset, CASE WHEN max_repeats = 1 THEN 'other' ELSE c.ws END AS iws, TRUE AS i FROM mix_targets LEFT JOIN c ON c.dataset = source_id WHERE source_kind = 'dataset'),
d AS (SELECT DISTINCT dataset, TRUE AS d FROM img WHERE split = 'test')
SELECT dataset, CASE WHEN c IS NULL THEN 'orphan' WHEN NOT pinned THEN 'unpinned' WHEN NOT enabled THEN 'disabled' WHEN i IS NULL THEN 'missing' WHEN d IS NULL THEN 'not_on_disk' WHEN ws IS DISTINCT FROM iws THEN 'workspace_mismatch' ELSE 'ok' END AS status
FROM c FULL JOIN i USING (dataset) FULL JOIN d USING (dataset)""")
def d4_reconcile(v: Views) -> DataFrame:
    ws = v.cat.groupBy("dataset").agg(F.max("workspace_id").alias("ws"))
    indexed = v.table("mix_targets").where("source_kind = 'dataset'").select(F.col("source_id").alias("dataset"), "max_repeats").join(ws, "dataset", "left").select("dataset", F.when(F.col("max_repeats") == 1, "other").otherwise(F.col("ws")).alias("workspace_id"))
    return C.reconcile(v.cat, indexed, v.pick().where("split = 'test'").select("dataset"))


@query(f"""WITH {IMG}, {BX}, {SB} SELECT DISTINCT a.image_id, a.box_ord FROM sb a JOIN sb b ON a.image_id = b.image_id
WHERE a.class_id = 80 AND b.class_id = 0 AND {containment_sql('a', 'b')} >= 3e-1 AND (a.y2 - a.y1) > 0 AND (b.y2 - b.y1) / (a.y2 - a.y1) > 1""")
def d5_rider_boxes(v: Views) -> DataFrame:
    return C.rider_pairs(v.sb.where("class_id = 80"), v.sb.where("class_id = 0"))


@query(f"""WITH {IMG}, {BX}, {SB}, {DET}, b AS (SELECT a.image_id, a.ord, coalesce(max(d.conf), 0e0) AS conf FROM sb a LEFT JOIN (SELECT * FROM det WHERE class_id = 80) d ON a.image_id = d.image_id AND {iou_sql('a', 'd')} >= 5e-1 WHERE a.class_id = 80 GROUP BY a.image_id, a.ord)
SELECT *, CASE WHEN conf = 0 THEN 'missed' WHEN conf < 25e-2 THEN 'weak' ELSE 'ok' END AS status FROM b""")
def d7_best_confidence(v: Views) -> DataFrame:
    return M.best_confidence(v.sb.where("class_id = 80").select("image_id", "ord", "b"), v.det.where("class_id = 80"))


@query(f"""WITH RECURSIVE {IMG}, {BX}, {SB}, {DET}, {greedy_sql('sb', 'det', '5e-1')}
SELECT t.image_id, t.class_id, TRUE AS is_gt, t.ord, w.gt IS NOT NULL AS matched, NULL::DOUBLE AS iou FROM sb t LEFT JOIN won w ON w.image_id = t.image_id AND w.class_id = t.class_id AND w.gt = t.ord
UNION ALL SELECT s.image_id, s.class_id, FALSE, s.ord, w.ord IS NOT NULL, round(w.iou, 9) FROM det s LEFT JOIN won w ON w.image_id = s.image_id AND w.class_id = s.class_id AND w.ord = s.ord""")
def d8_exclusive_matches(v: Views) -> DataFrame:
    m = M.exclusive_matches(v.sb, v.det)
    return m.select("image_id", "class_id", "is_gt", "ord", "matched", F.round("iou", 9).alias("iou"))


@query()
def d9_containment_matches(v: Views) -> DataFrame:
    """Between the boxes and the detections of a picture."""
    return M.containment_matches(v.sb.select("image_id", "class_id", "ord", "b"), v.det.select("image_id", "class_id", "ord", "b"), ["image_id"])


@query(f"""WITH {IMG}, {BX}, {SB}, {DET}, j AS (SELECT a.image_id, a.ord, d.conf, {iou_sql('a', 'd')} AS iou, d.ord AS dord FROM sb a JOIN det d ON a.image_id = d.image_id AND a.class_id = d.class_id)
SELECT image_id, ord, arg_max(conf, (iou, dord)) AS conf, round(max(iou), 9) AS iou FROM j WHERE iou >= 5e-1 GROUP BY image_id, ord""")
def d11_box_confidence(v: Views) -> DataFrame:
    return M.box_confidence(v.sb.select("image_id", "class_id", "ord", "b"), v.det).withColumn("iou", F.round("iou", 9))


@query(f"""WITH {IMG}, {BX}, {SB}, j AS (SELECT a.image_id, a.ord, b.ord AS tord, {overlap_sql('a', 'b')} AS shared FROM sb a JOIN sb b ON a.image_id = b.image_id WHERE a.class_id = 0 AND b.class_id = 80)
SELECT image_id, ord, arg_max(tord, (shared, -tord)) AS target, round(max(shared), 6) AS shared FROM j WHERE shared > 0 GROUP BY image_id, ord""")
def d12_largest_overlap(v: Views) -> DataFrame:
    return M.largest_overlap(v.sb.where("class_id = 0"), v.sb.where("class_id = 80")).withColumn("shared", F.round("shared", 6))


_LIMITED = f"{IMG}, {H}, {CAT}, {EFF}, e1 AS (SELECT dataset, max(phash_max) AS most FROM eff GROUP BY dataset), l AS (SELECT image_id, phash, dataset, coalesce(most, 8) AS most FROM img JOIN hs USING (image_id) LEFT JOIN e1 USING (dataset) WHERE phash IS NOT NULL)"


def _limited(v: Views) -> DataFrame:
    """Hashes with the distance up to which their dataset takes pictures for the same."""
    most = C.effective(v.cat).groupBy("dataset").agg(F.max("phash_max").alias("most"))
    return v.pick().join(v.h, "image_id").where("phash IS NOT NULL").join(most, "dataset", "left").select(F.col("image_id").alias("id"), "phash", "dataset", F.coalesce("most", F.lit(DEFAULTS.phash_distance)).alias("most"))


@query(f"""WITH {_LIMITED}, r AS (SELECT min(image_id) AS id, phash, most FROM l GROUP BY phash, most)
SELECT x.id AS a, y.id AS b, bit_count(xor(x.phash, y.phash))::INT AS distance FROM r x JOIN r y ON x.id < y.id AND bit_count(xor(x.phash, y.phash)) <= least(x.most, y.most)""")
def d13_hamming_pairs(v: Views) -> DataFrame:
    """Near pairs between representatives: the least picture of each hash and limit; d13_hash_copies has the others."""
    first = _limited(v).groupBy("phash", "most").agg(F.min("id").alias("id"))
    return hamming_self_pairs(first, Scratch(v.spark, "d13"), C.widest_distance(v.cat), limit="most", usual=DEFAULTS.phash_distance)


@query(f"WITH {_LIMITED} SELECT image_id, min(image_id) OVER (PARTITION BY phash, most) AS representative FROM l")
def d13_hash_copies(v: Views) -> DataFrame:
    rows = _limited(v)
    first = rows.groupBy("phash", "most").agg(F.min("id").alias("representative"))
    return rows.join(first, ["phash", "most"]).select(F.col("id").alias("image_id"), "representative")


@query(f"""WITH {IMG}, {H}, v AS (SELECT min(image_id) AS id, phash FROM img JOIN hs USING (image_id) WHERE split = 'valid' AND phash IS NOT NULL GROUP BY phash),
t AS (SELECT min(image_id) AS id, phash, phash_mirror FROM img JOIN hs USING (image_id) WHERE split = 'train' AND phash IS NOT NULL AND phash_mirror IS NOT NULL GROUP BY phash, phash_mirror),
j AS (SELECT v.id AS a, t.id AS b, bit_count(xor(v.phash, t.phash)) AS s, bit_count(xor(v.phash, t.phash_mirror)) AS m FROM v, t)
SELECT a, b, least(s, m)::INT AS distance, m < s AS mirrored FROM j WHERE least(s, m) <= 6""")
def d14_cross_pairs(v: Views) -> DataFrame:
    """Near pairs of valid and train pictures, between the least pictures of equal hashes on either side.

    d14_hash_copies has the others, d14_same_name_pairs the pairs of one base name that are further apart.
    """
    j = v.pick().join(v.h, "image_id")
    a = j.where("split = 'valid' AND phash IS NOT NULL").groupBy("phash").agg(F.min("image_id").alias("id"))
    b = j.where("split = 'train' AND phash IS NOT NULL AND phash_mirror IS NOT NULL").groupBy("phash", "phash_mirror").agg(F.min("image_id").alias("id"))
    return hamming_cross_pairs(a, b, Scratch(v.spark, "d14"), 6)


def _crossed(v: Views) -> tuple[DataFrame, DataFrame]:
    """Valid and train pictures that can be in pairs, with their base names."""
    j = v.pick(base=N.base_name(N.path_file(F.col("image_path")))).join(v.h, "image_id").where("phash IS NOT NULL")
    return j.where("split = 'valid'"), j.where("split = 'train' AND phash_mirror IS NOT NULL")


@query()
def d14_hash_copies(v: Views) -> DataFrame:
    """Valid and train pictures with those that stand for them: in d14_cross_pairs, and in d14_same_name_pairs."""
    one = lambda d, keys: d.groupBy(*keys).agg(F.min("image_id").alias("by_hash"))

    def side(d: DataFrame, keys: list[str]) -> DataFrame:
        named = one(d, [*keys, "base"]).withColumnRenamed("by_hash", "by_name")
        same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in (*keys, "base")]
        return d.join(one(d, keys), keys).alias("x").join(named.alias("y"), same).select("image_id", "split", "by_hash", "by_name")

    a, b = _crossed(v)
    return side(a, ["phash"]).unionByName(side(b, ["phash", "phash_mirror"]))


@query()
def d14_same_name_pairs(v: Views) -> DataFrame:
    """Valid and train pictures of one base name further apart than d14_cross_pairs has them, between the least pictures of equal hashes and base."""
    a, b = _crossed(v)
    kinds = a.groupBy("phash", "base").agg(F.min("image_id").alias("a"))
    others = b.groupBy(F.col("phash").alias("pb"), F.col("phash_mirror").alias("mb"), "base").agg(F.min("image_id").alias("b"))
    return same_name_pairs(kinds, others, 6)


@query(f"""WITH {IMG}, {H}, l AS (SELECT image_id, phash FROM img JOIN hs USING (image_id) WHERE split = 'test' AND phash IS NOT NULL), p AS (SELECT dataset || '/' || file AS name, phash FROM img JOIN hs USING (image_id) WHERE split = 'train' AND phash IS NOT NULL),
j AS (SELECT l.image_id AS id, bit_count(xor(l.phash, p.phash)) AS d, name FROM l, p WHERE d <= 12)
SELECT id, min(d)::INT AS distance, arg_min(name, (d, name)) AS nearest FROM j GROUP BY id""")
def d15_nearest(v: Views) -> DataFrame:
    scratch = Scratch(v.spark, "d15")
    j = v.pick(file=N.path_file(F.col("image_path"))).where("split IN ('test', 'train')").join(v.h, "image_id").where("phash IS NOT NULL")
    j = scratch.keep(j.select("image_id", "split", F.when(F.col("split") == "train", F.concat_ws("/", "dataset", "file")).alias("name"), "phash"))
    return nearest(j.where("split = 'test'").withColumnRenamed("image_id", "id"), j.where("split = 'train'"), scratch, 12)


@query(f"""WITH {IMG}, {BX}, k AS (SELECT image_id, list_sort(list(DISTINCT class_id)) AS classes FROM bx GROUP BY image_id)
SELECT list_aggregate(classes, 'string_agg', ',') AS classes, count(*) AS n, min(image_id) AS first FROM k GROUP BY 1""")
def d17_class_sets(v: Views) -> DataFrame:
    """Pictures blocked by equal class sets: size and first picture of each block."""
    k = v.bx.groupBy("image_id").agg(F.array_sort(F.collect_set("class_id")).alias("classes"))
    return k.groupBy(F.array_join("classes", ",").alias("classes")).agg(F.count(F.lit(1)).alias("n"), F.min("image_id").alias("first"))


@query(f"""WITH {RUNS} SELECT epoch, a.map50 AS baseline, b.map50 AS trained, round((b.map50 - a.map50) * 1e2, 6) AS delta FROM (SELECT * FROM runs WHERE run = 'view') a JOIN (SELECT * FROM runs WHERE run = 'click') b USING (epoch)""")
def d18_deltas(v: Views) -> DataFrame:
    r = v.runs
    a, b = r.where("run = 'view'").select("epoch", F.col("map50").alias("baseline")), r.where("run = 'click'").select("epoch", F.col("map50").alias("trained"))
    return a.join(b, "epoch").withColumn("delta", F.round((F.col("trained") - F.col("baseline")) * F.lit(100.0), 6))


@query("SELECT user_id FROM events GROUP BY user_id HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events)")
def d20_in_all(v: Views) -> DataFrame:
    return in_all(v.table("events").where("user_id IS NOT NULL AND event_type IS NOT NULL"), "user_id", "event_type")


@query(f"WITH {IMG}, {BX} SELECT dataset, count(*) AS n FROM img ANTI JOIN bx USING (image_id) GROUP BY dataset")
def d23_without_labels(v: Views) -> DataFrame:
    return v.pick().join(v.bx, "image_id", "left_anti").groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


@query(rf"""WITH {IMG}, f AS (SELECT image_id, dataset, split, file, regexp_replace(file, '(?i)\.rf\.[0-9a-f]+\.(jpg|jpeg|png)$', '') AS g, coalesce(width < height, FALSE) AS rotated FROM img)
SELECT image_id, row_number() OVER (PARTITION BY dataset, split, g ORDER BY rotated, file, image_id) = 1 AS keep FROM f""")
def e1_variant_keepers(v: Views) -> DataFrame:
    """Pictures higher than wide stand for rotated ones."""
    f = v.pick(file=N.path_file(F.col("image_path")), width=F.col("width"), height=F.col("height"))
    f = f.withColumns({"g": N.variant_base(F.col("file")), "rotated": F.coalesce(F.col("width") < F.col("height"), F.lit(False)), "name": F.struct("file", "image_id")})
    return C.variant_keepers(f, ["dataset", "split", "g"], "rotated", "name").select("image_id", "keep")


@query()
def e3_thinned_clips(v: Views) -> DataFrame:
    frames = v.img.where("clip IS NOT NULL").join(v.h, "image_id", "left").select("image_id", "dataset", "split", "clip", "frame", "phash")
    return thin_clips(frames)


@query(f"""WITH RECURSIVE {_LIMITED}, e AS (SELECT x.image_id AS v, y.image_id AS u FROM l x JOIN l y ON x.image_id <> y.image_id AND bit_count(xor(x.phash, y.phash)) <= least(x.most, y.most)), {COMPONENTS},
{BX}, n AS (SELECT image_id, count(*) AS n FROM bx GROUP BY image_id), r AS (SELECT v AS image_id, g, dataset, coalesce(n, 0) AS n FROM cc JOIN img ON image_id = v LEFT JOIN n USING (image_id))
SELECT image_id, g AS component, first_value(image_id) OVER w AS keeper, n AS n_boxes FROM r WINDOW w AS (PARTITION BY g ORDER BY n DESC, dataset, image_id)""")
def e5_duplicates(v: Views) -> DataFrame:
    """Components of pictures with equal or near hashes; the one of most boxes is kept, ties by dataset and image_id."""
    scratch = Scratch(v.spark, "e5")
    comp = connected_components(hamming_links(_limited(v), scratch, C.widest_distance(v.cat), limit="most", usual=DEFAULTS.phash_distance), scratch)
    n = v.bx.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    r = comp.join(v.pick().select(F.col("image_id").alias("id"), "dataset"), "id").join(n.withColumnRenamed("image_id", "id"), "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    r = scratch.keep(r)
    keeper = r.groupBy("component").agg(F.min(F.struct(-F.col("n"), F.col("dataset"), F.col("id"))).alias("k"))
    return r.join(keeper, "component").select(F.col("id").alias("image_id"), "component", F.col("k.id").alias("keeper"), F.col("n").alias("n_boxes"))


@query(f"""WITH RECURSIVE {IMG}, {H}, x AS (SELECT image_id, phash FROM img JOIN hs USING (image_id) WHERE phash IS NOT NULL), e AS (SELECT x.image_id AS v, y.image_id AS u FROM x JOIN x y ON x.image_id <> y.image_id AND bit_count(xor(x.phash, y.phash)) <= 8), {COMPONENTS},
{BX}, k AS (SELECT image_id, class_id, count(*) AS n FROM bx GROUP BY ALL), n AS (SELECT image_id, sum(n) AS n FROM k GROUP BY image_id),
r AS (SELECT v AS image_id, first_value(v) OVER (PARTITION BY g ORDER BY coalesce(n, 0) DESC, v) AS keeper FROM cc LEFT JOIN n ON n.image_id = v),
s AS (SELECT r.image_id, keeper, (SELECT sum(least(coalesce(a.n, 0), coalesce(b.n, 0)))::DOUBLE / nullif(sum(greatest(coalesce(a.n, 0), coalesce(b.n, 0))), 0)::DOUBLE FROM (SELECT * FROM k WHERE k.image_id = r.image_id) a FULL JOIN (SELECT * FROM k WHERE k.image_id = r.keeper) b USING (class_id) WHERE a.image_id IS NOT NULL OR b.image_id IS NOT NULL) AS sim,
  r.image_id IN (SELECT image_id FROM n) AND r.keeper IN (SELECT image_id FROM n) AS both_ FROM r WHERE r.image_id <> keeper)
SELECT image_id, keeper, CASE WHEN both_ THEN round(sim, 9) END AS similarity, both_ AND sim < 5e-1 AS rescued FROM s""")
def e7_rescued_duplicates(v: Views) -> DataFrame:
    """Duplicates whose boxes are unlike the keeper's are kept; where either has no boxes they stay excluded."""
    scratch = Scratch(v.spark, "e7")
    comp = connected_components(hamming_links(v.pick().join(v.h, "image_id").withColumnRenamed("image_id", "id"), scratch, DEFAULTS.phash_distance), scratch)
    k = v.bx.groupBy("image_id", "class_id").agg(F.count(F.lit(1)).alias("n"))
    k = scratch.keep(k)
    total = k.groupBy("image_id").agg(F.sum("n").alias("total"))
    r = scratch.keep(comp.join(total.withColumnRenamed("image_id", "id"), "id", "left"))
    keep = r.groupBy("component").agg(F.min(F.struct(-F.coalesce("total", F.lit(0)), F.col("id"))).alias("k")).select("component", F.col("k.id").alias("keeper"))
    pairs = r.join(keep, "component").where("id <> keeper").select(F.col("id").alias("image_id"), "keeper", "total")
    mine = pairs.join(k, "image_id").select("image_id", "keeper", "class_id", F.col("n").alias("x"), F.lit(0).cast("bigint").alias("y"))
    theirs = pairs.join(k.withColumnRenamed("image_id", "keeper"), "keeper").select("image_id", "keeper", "class_id", F.lit(0).cast("bigint").alias("x"), F.col("n").alias("y"))
    per = mine.unionByName(theirs).groupBy("image_id", "keeper", "class_id").agg(F.max("x").alias("x"), F.max("y").alias("y"))
    sim = per.groupBy("image_id", "keeper").agg((F.sum(F.least("x", "y")) / F.sum(F.greatest("x", "y"))).alias("s"), F.sum("x").alias("nx"), F.sum("y").alias("ny"))
    out = pairs.select("image_id", "keeper").join(sim, ["image_id", "keeper"], "left")
    both = F.coalesce((F.col("nx") > 0) & (F.col("ny") > 0), F.lit(False))
    return out.select("image_id", "keeper", F.when(both, F.round("s", 9)).alias("similarity"), (both & (F.col("s") < 0.5)).alias("rescued"))


@query(f"""WITH {IMG}, {BX}, {SB}, {DET}, t AS (SELECT image_id, class_id, arg_max(ord, (CASE WHEN conf > 0 THEN conf ELSE -1e0 END, {area_sql('det')}, -ord)) AS top, count(*) AS n FROM det GROUP BY ALL) SELECT * FROM t""")
def e11_signatures(v: Views) -> DataFrame:
    return M.signatures(v.det.select("image_id", "class_id", "conf", "ord", "b")).select("image_id", "class_id", F.col("top.ord").alias("top"), "n")


@query(f"""WITH {IMG}, {H}, v AS (SELECT image_id, base, phash FROM img JOIN hs USING (image_id) WHERE split = 'valid'), t AS (SELECT image_id, base, phash, phash_mirror FROM img JOIN hs USING (image_id) WHERE split = 'train'),
j AS (SELECT v.image_id AS a, t.image_id AS b, least(bit_count(xor(v.phash, t.phash)), bit_count(xor(v.phash, t.phash_mirror))) AS d FROM v, t WHERE v.phash IS NOT NULL AND t.phash IS NOT NULL AND t.phash_mirror IS NOT NULL AND (d <= 6 OR v.base = t.base)),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d, b) AS r, count(*) OVER (PARTITION BY a) AS n FROM j)
SELECT a, b, d::INT AS distance, r::INT AS rank, greatest(n - 12, 0) AS extra FROM r WHERE r <= 12""")
def e12_suspicious_groups(v: Views) -> DataFrame:
    """Of each valid picture the 12 nearest of train by hash or of the same base name, and how many more there are. The test tables have no dismissed pairs."""
    return cross_split_groups(*_crossed(v), Scratch(v.spark, "e12"), 6)


@query(f"""WITH RECURSIVE {IMG}, keyed AS (SELECT image_id, 'c' || '|' || dataset || '|' || clip AS k FROM img WHERE clip IS NOT NULL UNION ALL SELECT image_id, 'b' || '|' || base FROM img), centre AS (SELECT k, min(image_id) AS c FROM keyed GROUP BY k),
l AS (SELECT DISTINCT image_id AS a, c AS b FROM keyed JOIN centre USING (k)), e AS (SELECT a AS v, b AS u FROM l UNION SELECT b, a FROM l), {COMPONENTS} SELECT v AS image_id, g AS group_id FROM cc""")
def e14_related_groups(v: Views) -> DataFrame:
    return related_groups(v.img, Scratch(v.spark, "e14"), ["dataset", "clip"], "base").select("image_id", "group_id")


def _hard(v: Views) -> DataFrame:
    b = M.best_confidence(v.sb.where("class_id = 80").select("image_id", "ord", "b"), v.det.where("class_id = 80"))
    return b.groupBy("image_id").agg(F.count_if(F.col("status") == "missed").alias("missed"), F.count_if(F.col("status") == "weak").alias("weak"), F.min("conf").alias("min_conf"))


@query(f"""WITH {IMG}, {BX}, {SB}, {DET}, b AS (SELECT a.image_id, a.ord, coalesce(max(d.conf), 0e0) AS conf FROM sb a LEFT JOIN (SELECT * FROM det WHERE class_id = 80) d ON a.image_id = d.image_id AND {iou_sql('a', 'd')} >= 5e-1 WHERE a.class_id = 80 GROUP BY a.image_id, a.ord),
i AS (SELECT image_id, count(*) FILTER (conf = 0) AS missed, count(*) FILTER (conf > 0 AND conf < 25e-2) AS weak, min(conf) AS min_conf FROM b GROUP BY image_id) SELECT * FROM i ORDER BY missed DESC, weak DESC, min_conf, image_id LIMIT 300""")
def f1_hard_examples(v: Views) -> DataFrame:
    """The 300 pictures with most missed, then weakest boxes."""
    return _hard(v).orderBy(F.col("missed").desc(), F.col("weak").desc(), "min_conf", "image_id").limit(300)


@query()
def f2_novel_hard_examples(v: Views) -> DataFrame:
    """Greedy novelty over the hard examples: near a picture of the pool, near a kept one, kept, or over the limit.

    Every picture of a missed or weak box outside the pool has its fate.
    """
    scratch = Scratch(v.spark, "f2")
    hard = _hard(v).where("missed + weak > 0").join(v.h.select("image_id", "phash"), "image_id", "left").join(v.pick().select("image_id", "split"), "image_id")
    hard = hard.where("split IS DISTINCT FROM 'test'").select("image_id", "phash", (-F.col("missed")).alias("missed"), (-F.col("weak")).alias("weak"), "min_conf")
    ranked = scratch.keep(rank_in_groups(hard, [], ["missed", "weak", "min_conf", "image_id"], scratch))
    pool = v.pick().where("split = 'test'").join(v.h, "image_id").select(F.col("image_id").cast("string").alias("name"), "phash")
    near = nearest(ranked.select(F.col("image_id").alias("id"), "phash"), pool, scratch, DEFAULTS.mining_dedup_dist).select(F.col("id").alias("image_id"))
    return M.novel_fates(ranked, near, scratch, DEFAULTS.mining_max, DEFAULTS.mining_dedup_dist)


@query(f"""WITH {LOG}, items AS (SELECT DISTINCT 'picture_' || user_id AS name, 'ds' || (user_id % 7) AS dataset FROM events), s AS (SELECT name, dataset, CASE WHEN decision IN ('select', 'discard') THEN decision ELSE 'todo' END AS status FROM items LEFT JOIN decided USING (name))
SELECT * FROM s WHERE contains(lower(name), '1') AND status = 'todo' ORDER BY dataset DESC, name LIMIT 12 OFFSET 12""")
def f4_review_page(v: Views) -> DataFrame:
    items = v.table("events").select(F.concat(F.lit("picture_"), F.col("user_id")).alias("name"), F.concat(F.lit("ds"), F.col("user_id") % 7).alias("dataset"), F.lit(None).cast("array<int>").alias("classes")).distinct()
    return R.view(items, R.current_decisions(v.decisions), text="1", status="todo", order=["-dataset"], page=1).select("name", "dataset", "status")


@query(f"""WITH {IMG}, {BX}, n AS (SELECT split, dataset, class_id, count(*) AS n FROM bx JOIN img USING (image_id) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY split, class_id ORDER BY n DESC, dataset) AS r FROM n) SELECT split, class_id, dataset, n, r::INT AS rank FROM r WHERE r <= 5""")
def f9_top_datasets(v: Views) -> DataFrame:
    n = v.bx.join(v.pick(), "image_id").groupBy("split", "dataset", "class_id").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("split", "class_id").orderBy(F.col("n").desc(), "dataset")
    return n.withColumn("rank", F.row_number().over(w)).where("rank <= 5").select("split", "class_id", "dataset", "n", "rank")


@query(f"""WITH {IMG}, v AS (SELECT image_id, 500 + image_id % 100 AS n_frames, (24 + image_id % 7)::DOUBLE AS fps FROM img),
f AS (SELECT image_id AS video, n_frames, fps, unnest(range(0, (n_frames / (fps / 2e0))::INT + 2)) AS nth FROM v), g AS (SELECT *, CAST(round_even(nth * (fps / 2e0), 0) AS BIGINT) AS r FROM f), i AS (SELECT *, greatest(r, nth) AS idx FROM g)
SELECT video, nth::INT AS nth, idx, round(idx / fps, 9) AS seconds FROM i WHERE idx < n_frames""")
def a52_selected_frames(v: Views) -> DataFrame:
    videos = v.pick().select(F.col("image_id").alias("video"), (F.lit(500) + F.col("image_id") % 100).alias("n_frames"), (F.lit(24) + F.col("image_id") % 7).cast("double").alias("fps"))
    return selected_frames(videos, 2.0).withColumn("seconds", F.round("seconds", 9))
