"""The queries of the ten problems over the test tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import names as N
from frameloom.llm import views as V
from frameloom.llm.events import collapse_runs
from frameloom.llm.groups import hash_to_min
from frameloom.llm.mixing import mixture
from frameloom.llm.overlaps import cross_split_overlaps, overlap_counts
from frameloom.llm.packing import pack, packing_report
from frameloom.llm.proportions import proportional_sample
from frameloom.llm.repetition import mostly_repeated, repetition
from frameloom.llm.splits import assign_splits, components, scattered
from frameloom.llm.tokens import token_counts, token_ids
from frameloom.llm.variety import varied_subset
from frameloom.operators.images import current_images
from frameloom.plans.scratch import Scratch
from frameloom.sources.tables import table

SHARES = {"train": 0.8, "valid": 0.1, "test": 0.1}
CAPACITY = 2048


# 1. Repeated consecutive events


def p1_events(spark: SparkSession, sf_dir: str, least: int = 1) -> DataFrame:
    frames = V.clips(spark, sf_dir).join(V.hashes(spark, sf_dir), "image_id", "left")
    return collapse_runs(frames, Scratch(spark, "p1"), ["dataset", "split", "clip"], "frame", "image_id", "phash", max_bits=10, max_gap=60, least=least).select("start_id", F.col("n").alias("n_frames"), F.col("start_at").alias("first_frame"), F.col("end_at").alias("last_frame"), "span")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_events(spark, sf_dir, 2).select("start_id", "n_frames")


# 2. A sample of target proportions


def decimal_comma(c: str) -> F.Column:
    """DOUBLE of a percentage written with a decimal comma, perhaps with blanks or `%`; null if it is no number."""
    return F.expr(f"try_cast(replace(regexp_replace({c}, '[%\\\\s]', ''), ',', '.') AS DOUBLE)")


def _p2(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = table(spark, sf_dir, "coco_subset_20000_4000").where("list_name = 'train'")
    targets = t.groupBy(F.col("classe").alias("category")).agg(
        F.max(decimal_comma("percentuale_istanze_subset")).alias("share"), F.max("nome").alias("name"), F.max(decimal_comma("percentuale_immagini_coco")).alias("pool_percent"), F.max("immagini_subset").alias("pool_images")
    )
    boxes = table(spark, sf_dir, "boxes").select("image_id", "box_ord", "class_id", "xc", "yc", "w", "h").where("image_id IS NOT NULL AND w > 0 AND h > 0").distinct()
    return proportional_sample(boxes, targets, Scratch(spark, "p2"), "class_id", ["image_id", "box_ord", "xc", "yc", "w", "h"], size=0.1, floor=100)


def p2_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p2(spark, sf_dir)[0]


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p2(spark, sf_dir)[1]


# 3. A varied subset


def p3_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = N.with_names(table(spark, sf_dir, "image_index"))
    size = F.when((F.col("width") > 0) & (F.col("height") > 0), F.log(F.col("width") / F.col("height")))
    images = current_images(index, clip=F.col("__clip"), shape=size)
    boxes = table(spark, sf_dir, "boxes").where("image_id IS NOT NULL AND class_id IS NOT NULL AND w > 0 AND h > 0").select("image_id", "box_ord", "class_id", "xc", "yc", "w", "h").distinct().groupBy("image_id").agg(F.count(F.lit(1)).alias("boxes"))
    least = table(spark, sf_dir, "datasets_to_download").select(
        F.concat("project_id", F.lit("-v"), F.coalesce(F.trim("version"), F.lit(""))).alias("dataset"), F.expr("try_cast(trim(variety_min_instances) AS INT)").alias("least_boxes")
    ).groupBy("dataset").agg(F.max("least_boxes").alias("least_boxes"))
    records = images.join(V.hashes(spark, sf_dir), "image_id", "left").join(boxes, "image_id", "left").join(least, "dataset", "left")
    return varied_subset(records.select(F.col("image_id").alias("id"), "dataset", "clip", F.col("phash").alias("hash"), "shape", "least_boxes", "boxes"), Scratch(spark, "p3"), k=0.01).withColumnRenamed("id", "image_id")


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per dataset its images, how many were chosen, and the share of all that were chosen."""
    chosen = Scratch(spark, "p3r").keep(p3_subset(spark, sf_dir))
    n = chosen.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_chosen"))
    total = chosen.count() or 1
    images = current_images(table(spark, sf_dir, "image_index")).groupBy("dataset").agg(F.count(F.lit(1)).alias("n_images"))
    return images.join(n, "dataset", "left").select("dataset", "n_images", F.coalesce("n_chosen", F.lit(0)).alias("n_chosen"), (F.coalesce("n_chosen", F.lit(0)) / F.lit(total)).alias("share"))


# 4. Groups of pairwise matches


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    there = table(spark, sf_dir, "image_index").select("image_id").where("image_id IS NOT NULL").distinct()
    pairs = table(spark, sf_dir, "match_pairs").select(F.least("image_a", "image_b").alias("a"), F.greatest("image_a", "image_b").alias("b"), (F.col("image_a") == F.col("image_b")).alias("same")).where("NOT same").select("a", "b").distinct()
    links = pairs.join(there, pairs.a == there.image_id, "left_semi").join(there, pairs.b == there.image_id, "left_semi")
    return hash_to_min(links, Scratch(spark, "p4")).withColumnRenamed("id", "image_id")


# 5. A mixture of sources


def _p5(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    images = current_images(table(spark, sf_dir, "image_index")).where("dataset IS NOT NULL").select(F.lit("dataset").alias("source_kind"), F.col("dataset").alias("source_id"), F.col("image_id").alias("record_id"))
    classes = table(spark, sf_dir, "coco_subset_20000_4000").where("list_name = 'train' AND immagini_subset > 0 AND classe IS NOT NULL").groupBy("classe").agg(F.max("immagini_subset").alias("n"))
    of_class = classes.select(F.lit("coco_class").alias("source_kind"), F.col("classe").cast("string").alias("source_id"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("record_id"))
    return mixture(images.unionByName(of_class), table(spark, sf_dir, "mix_targets"), Scratch(spark, "p5"), total=1.0)


def p5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p5(spark, sf_dir)[0]


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p5(spark, sf_dir)[1]


# 6. Overlaps of splits


def _p6(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "image_index").withColumn("__file", N.path_file(F.col("image_path")))
    images = current_images(index, mark=N.export_mark(F.col("__file")))
    return images.join(V.hashes(spark, sf_dir), "image_id", "left").select(F.col("image_id").alias("id"), "dataset", "split", "phash", "phash_mirror", "mark")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_split_overlaps(_p6(spark, sf_dir), Scratch(spark, "p6")).select(F.least("id_train", "id_eval").alias("id_a"), F.greatest("id_train", "id_eval").alias("id_b"))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per split and dataset of the evaluation records: how many overlap with train, and in how many pairs."""
    return overlap_counts(_p6(spark, sf_dir), Scratch(spark, "p6"), ["dataset"])


# 7. Splits that keep related images together


def _p7(spark: SparkSession, sf_dir: str, scratch: Scratch) -> DataFrame:
    return components(V.related(spark, sf_dir).withColumnRenamed("image_id", "id"), scratch, ["dataset", "clip"], ["base"])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scattered(_p7(spark, sf_dir, Scratch(spark, "p7"))).select(F.col("id").alias("image_id"), "group_id")


def p7_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "p7s")
    return assign_splits(_p7(spark, sf_dir, scratch), scratch, SHARES).select(F.col("id").alias("image_id"), "group_id", "group_size", "split", "new_split")


# 8. to 10. Texts


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(table(spark, sf_dir, "documents"))


def _p9(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = token_counts(table(spark, sf_dir, "documents"))
    return pack(items.select(F.col("doc_id").alias("id"), F.col("n_tokens").alias("size")), Scratch(spark, "p9"), CAPACITY)


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p9(spark, sf_dir).withColumnRenamed("id", "doc_id")


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_report(_p9(spark, sf_dir), CAPACITY)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mostly_repeated(table(spark, sf_dir, "documents")).select("doc_id")


def p10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (p1_found, p1_events, p2_sample, p2_report, p3_subset, p3_report, p4_found, p5_mixture, p5_report, p6_found, p6_report, p7_found, p7_splits, p8_ids, p9_containers, p9_report, p10_found, p10_repetition)
    }


# The current images as the queries see them.
IMAGES_SQL = r"""
said AS (
  SELECT image_id, indexed_at, image_path, regexp_replace(image_path, '[/\\]+', '/', 'g') AS p FROM image_index WHERE image_id IS NOT NULL),
levels AS (
  SELECT image_id, indexed_at, split_part(p, '/', -4) AS dataset, split_part(p, '/', -3) AS split,
    regexp_replace(lower(split_part(p, '/', -1)), '\.[^.]*$', '') AS s FROM said),
marks AS (
  SELECT *, nullif(regexp_extract(s, '\.rf\.([0-9a-f]{32})$', 1), '') AS mark, regexp_replace(s, '(_(jpg|jpeg|png))?\.rf\.[0-9a-f]{32}$', '') AS u FROM levels),
bases AS (
  SELECT *, regexp_replace(CASE WHEN contains(u, '__') THEN substr(u, instr(u, '__') + 2) ELSE u END, '[ _-]?flip$', '') AS base FROM marks),
timed AS (
  SELECT *, regexp_matches(base, '_f[0-9]+_t[0-9]+(\.[0-9]+)?$') AS is_timed, regexp_extract(base, '[0-9]+$') AS digits FROM bases),
frames AS (
  SELECT *, CASE WHEN is_timed THEN CAST(regexp_extract(base, '_f([0-9]+)_t[0-9]+(\.[0-9]+)?$', 1) AS BIGINT)
      WHEN digits <> '' AND TRY_CAST(digits AS HUGEINT) <= 100000000 THEN TRY_CAST(digits AS BIGINT) END AS frame,
    CASE WHEN is_timed THEN regexp_replace(base, '_f[0-9]+_t[0-9]+(\.[0-9]+)?$', '')
      WHEN digits <> '' AND TRY_CAST(digits AS HUGEINT) <= 100000000 THEN regexp_replace(substr(base, 1, length(base) - length(digits)), '[ _-]$', '') END AS clip FROM timed),
images AS (
  SELECT image_id, arg_max({'dataset': dataset, 'split': split, 'mark': mark, 'base': base, 'clip': clip, 'frame': frame}, indexed_at) AS x FROM frames GROUP BY image_id),
img AS (SELECT image_id, x.dataset AS dataset, x.split AS split, x.mark AS mark, x.base AS base, x.clip AS clip, x.frame AS frame FROM images),
h AS (SELECT image_id, max(phash) AS phash, max(phash_mirror) AS phash_mirror FROM hashes GROUP BY image_id)"""

_P1_RUNS = f"""
WITH {IMAGES_SQL},
seq AS (
  SELECT dataset, split, clip, frame, image_id, phash, lag(frame) OVER w AS f0, lag(phash) OVER w AS p0
  FROM img LEFT JOIN h USING (image_id) WHERE clip IS NOT NULL WINDOW w AS (PARTITION BY dataset, split, clip ORDER BY frame, image_id)),
cut AS (
  SELECT *, sum(CASE WHEN bit_count(xor(phash, p0)) < 10 AND frame - f0 <= 60 THEN 0 ELSE 1 END) OVER (PARTITION BY dataset, split, clip ORDER BY frame, image_id) AS run FROM seq),
runs AS (
  SELECT arg_min(image_id, (frame, image_id)) AS start_id, count(*) AS n_frames, min(frame) AS first_frame, max(frame) AS last_frame, max(frame) - min(frame) + 1 AS span
  FROM cut GROUP BY dataset, split, clip, run)"""

_COMPONENTS = """
cc(v, g) USING KEY (v) AS (
  SELECT v, min(least(u, v)) FROM e GROUP BY v
  UNION
  SELECT e.v, min(least(a.g, b.g)) FROM e JOIN recurring.cc a ON a.v = e.v JOIN recurring.cc b ON b.v = e.u GROUP BY e.v, a.g HAVING min(b.g) < a.g)"""

_P6_PAIRS = f"""
WITH {IMAGES_SQL},
full_ AS (SELECT * FROM img LEFT JOIN h USING (image_id)),
pairs AS (
  SELECT t.image_id AS t, e.image_id AS e, e.split AS split, e.dataset AS dataset,
    least(bit_count(xor(t.phash, e.phash)), bit_count(xor(t.phash, e.phash_mirror)), bit_count(xor(t.phash_mirror, e.phash))) <= 4 AS by_hash, coalesce(t.mark = e.mark, FALSE) AS by_mark
  FROM full_ t JOIN full_ e ON t.split = 'train' AND e.split IN ('valid', 'test') AND (t.mark = e.mark
    OR bit_count(xor(t.phash, e.phash)) <= 4 OR bit_count(xor(t.phash, e.phash_mirror)) <= 4 OR bit_count(xor(t.phash_mirror, e.phash)) <= 4))"""

_P10_WORDS = r"""
WITH w AS (
  SELECT doc_id, i, word FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS ws FROM documents), LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i, lower(unnest(ws)) AS word)),
g AS (
  SELECT doc_id, i, concat_ws(' ', word, lead(word, 1) OVER x, lead(word, 2) OVER x, lead(word, 3) OVER x, lead(word, 4) OVER x, lead(word, 5) OVER x) AS gram, lead(i, 5) OVER x AS last
  FROM w WINDOW x AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, i FROM (SELECT *, min(i) OVER (PARTITION BY doc_id, gram) AS first FROM g WHERE last IS NOT NULL) WHERE i > first),
c AS (SELECT w.doc_id, w.i, max(s.i) OVER (PARTITION BY w.doc_id ORDER BY w.i RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) AS near FROM w LEFT JOIN s ON s.doc_id = w.doc_id AND s.i = w.i),
n AS (SELECT doc_id, count(*) AS n_words, count(near) AS n_repeated FROM c GROUP BY doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _P1_RUNS + " SELECT start_id, n_frames FROM runs WHERE n_frames >= 2",
        "p1_events": _P1_RUNS + " SELECT start_id, n_frames, first_frame, last_frame, span FROM runs",
        "p4_found": f"""
WITH RECURSIVE ids AS (SELECT DISTINCT image_id FROM image_index),
l AS (SELECT DISTINCT image_a AS a, image_b AS b FROM match_pairs WHERE image_a <> image_b AND image_a IN (SELECT image_id FROM ids) AND image_b IN (SELECT image_id FROM ids)),
e AS (SELECT a AS v, b AS u FROM l UNION SELECT b, a FROM l), {_COMPONENTS}
SELECT v AS image_id, g AS group_id FROM cc""",
        "p6_found": _P6_PAIRS + " SELECT least(t, e) AS id_a, greatest(t, e) AS id_b FROM pairs",
        "p6_report": _P6_PAIRS + """, hit AS (SELECT e, count(*) AS pairs, count_if(by_hash) AS by_hash, count_if(by_mark) AS by_mark FROM pairs GROUP BY e)
SELECT split, dataset, count(*) AS n_images, count(pairs) AS n_overlapping, coalesce(sum(pairs), 0)::BIGINT AS n_pairs, coalesce(sum(by_hash), 0)::BIGINT AS n_by_hash, coalesce(sum(by_mark), 0)::BIGINT AS n_by_mark
FROM img LEFT JOIN hit ON hit.e = image_id WHERE split IN ('valid', 'test') GROUP BY split, dataset""",
        "p7_found": f"""
WITH RECURSIVE {IMAGES_SQL},
keyed AS (SELECT image_id, 'c' || '|' || dataset || '|' || clip AS k FROM img WHERE clip IS NOT NULL UNION ALL SELECT image_id, 'b' || '|' || base FROM img),
centre AS (SELECT k, min(image_id) AS c FROM keyed GROUP BY k),
l AS (SELECT DISTINCT image_id AS a, c AS b FROM keyed JOIN centre USING (k)),
e AS (SELECT a AS v, b AS u FROM l UNION SELECT b, a FROM l), {_COMPONENTS}
SELECT image_id, g AS group_id FROM cc JOIN img ON image_id = v
WHERE g IN (SELECT g FROM cc JOIN img ON image_id = v GROUP BY g HAVING count(DISTINCT split) > 1)""",
        "p10_found": _P10_WORDS + " SELECT doc_id FROM n WHERE n_repeated >= 4e-1 * n_words",
    }
