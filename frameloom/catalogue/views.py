"""Views over the test tables that the queries share, in Spark and, of the same names, in SQL.

Detections are derived from the boxes, shifted and scaled a little, with a confidence that
depends on their numbers, so that both engines have the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import geometry as G
from frameloom.functions import names as N
from frameloom.operators.curate import catalog
from frameloom.operators.images import current_hashes, current_images
from frameloom.sources.tables import table


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.dir, name)

    @property
    def img(self) -> DataFrame:
        index = N.with_names(self.table("image_index"))
        return current_images(index, file=F.col("__file"), base=F.col("__base"), clip=F.col("__clip"), frame=F.col("__frame"), width=F.col("width"), height=F.col("height"), excluded=F.col("excluded"), stage=F.col("exclusion_stage"), reason=F.col("exclusion_reason"))

    def pick(self, **values: F.Column) -> DataFrame:
        """image_id, dataset, split and few other columns of the current images, without parsing names."""
        return current_images(self.table("image_index"), **values)

    @property
    def bx(self) -> DataFrame:
        return self.table("boxes").where("image_id IS NOT NULL AND class_id IS NOT NULL AND w > 0 AND h > 0").select("image_id", "box_ord", "class_id", "xc", "yc", "w", "h").distinct()

    @property
    def sb(self) -> DataFrame:
        """Boxes of pictures of known size, with pixel corners b and pixels."""
        img = self.pick(width=F.col("width"), height=F.col("height")).where("width > 0 AND height > 0")
        j = self.bx.join(img, "image_id")
        b = G.corners(F.col("xc"), F.col("yc"), F.col("w"), F.col("h"), F.col("width"), F.col("height"))
        return j.withColumn("b", b).withColumn("pixels", G.area(F.col("b"))).withColumn("ord", F.col("box_ord"))

    @property
    def det(self) -> DataFrame:
        s = self.sb
        shift = ((F.col("image_id") + F.col("box_ord")) % 7 - 3).cast("double") * F.lit(1e-2)
        grow = F.lit(1.0) + ((F.col("image_id") % 5) - 2).cast("double") * F.lit(2e-2)
        moved = s.withColumns({"xc": F.col("xc") + shift * F.col("w"), "w": F.col("w") * grow, "conf": ((F.col("image_id") * 31 + F.col("box_ord") * 17) % 100).cast("double") / F.lit(1e2)})
        b = G.corners(F.col("xc"), F.col("yc"), F.col("w"), F.col("h"), F.col("width"), F.col("height"))
        return moved.withColumn("b", b).withColumn("pixels", G.area(F.col("b")))

    @property
    def h(self) -> DataFrame:
        return current_hashes(self.table("hashes"))

    @property
    def cat(self) -> DataFrame:
        return catalog(self.table("datasets_to_download"))

    @property
    def decisions(self) -> DataFrame:
        """A log of review events (seq, name, decision), null decisions delete; names are numbers of events' users."""
        e = self.table("events")
        d = F.when(F.col("event_type") == "purchase", "select").when(F.col("event_type") == "error", "discard").when(F.col("event_type") == "signup", "reserve")
        return e.select(F.col("event_id").alias("seq"), F.concat(F.lit("picture_"), F.col("user_id")).alias("name"), d.alias("decision"), "value")

    @property
    def runs(self) -> DataFrame:
        """Metrics (run, epoch, time, map50, map50_95): event types as runs, days as epochs."""
        e = self.table("events").withColumn("epoch", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")))
        return e.groupBy(F.col("event_type").alias("run"), "epoch").agg((F.max("event_id").cast("double")).alias("time"), F.round(F.max("value") / F.lit(1e3), 9).alias("map50"), F.round(F.min("value") / F.lit(1e3), 9).alias("map50_95"))


IMG = r"""
said AS (SELECT *, regexp_replace(image_path, '[/\\]+', '/', 'g') AS p FROM image_index WHERE image_id IS NOT NULL),
levels AS (
  SELECT *, split_part(p, '/', -4) AS ds, split_part(p, '/', -3) AS sp, split_part(p, '/', -1) AS file, regexp_replace(lower(split_part(p, '/', -1)), '\.[^.]*$', '') AS s FROM said),
marks AS (SELECT *, regexp_replace(s, '(_(jpg|jpeg|png))?\.rf\.[0-9a-f]{32}$', '') AS u FROM levels),
bases AS (SELECT *, regexp_replace(CASE WHEN contains(u, '__') THEN substr(u, instr(u, '__') + 2) ELSE u END, '[ _-]?flip$', '') AS base FROM marks),
timed AS (SELECT *, regexp_matches(base, '_f[0-9]+_t[0-9]+(\.[0-9]+)?$') AS is_timed, regexp_extract(base, '[0-9]+$') AS digits FROM bases),
frames AS (
  SELECT *, CASE WHEN is_timed THEN CAST(regexp_extract(base, '_f([0-9]+)_t[0-9]+(\.[0-9]+)?$', 1) AS BIGINT)
      WHEN digits <> '' AND TRY_CAST(digits AS HUGEINT) <= 100000000 THEN TRY_CAST(digits AS BIGINT) END AS frame,
    CASE WHEN is_timed THEN regexp_replace(base, '_f[0-9]+_t[0-9]+(\.[0-9]+)?$', '')
      WHEN digits <> '' AND TRY_CAST(digits AS HUGEINT) <= 100000000 THEN regexp_replace(substr(base, 1, length(base) - length(digits)), '[ _-]$', '') END AS clip FROM timed),
latest AS (
  SELECT image_id, arg_max({'dataset': ds, 'split': sp, 'file': file, 'base': base, 'clip': clip, 'frame': frame, 'width': width, 'height': height, 'excluded': excluded, 'stage': exclusion_stage, 'reason': exclusion_reason}, indexed_at) AS x
  FROM frames GROUP BY image_id),
img AS (SELECT image_id, x.dataset AS dataset, x.split AS split, x.file AS file, x.base AS base, x.clip AS clip, x.frame AS frame, x.width AS width, x.height AS height, x.excluded AS excluded, x.stage AS stage, x.reason AS reason FROM latest)"""
BX = "bx AS (SELECT DISTINCT image_id, box_ord, class_id, xc, yc, w, h FROM boxes WHERE image_id IS NOT NULL AND class_id IS NOT NULL AND w > 0 AND h > 0)"
_CORNERS = "(xc - w / 2e0) * width::DOUBLE AS x1, (yc - h / 2e0) * height::DOUBLE AS y1, (xc + w / 2e0) * width::DOUBLE AS x2, (yc + h / 2e0) * height::DOUBLE AS y2"
_AREA = "greatest(x2 - x1, 0e0) * greatest(y2 - y1, 0e0) AS pixels"
SB = f"sb0 AS (SELECT *, {_CORNERS}, box_ord AS ord FROM bx JOIN img USING (image_id) WHERE width > 0 AND height > 0), sb AS (SELECT *, {_AREA} FROM sb0)"
DET = f"""
det0 AS (SELECT image_id, ord, box_ord, class_id, dataset, split, width, height, xc + ((image_id + box_ord) % 7 - 3)::DOUBLE * 1e-2 * w AS xc, yc, w * (1e0 + ((image_id % 5) - 2)::DOUBLE * 2e-2) AS w, h,
  ((image_id * 31 + box_ord * 17) % 100)::DOUBLE / 1e2 AS conf FROM sb),
det1 AS (SELECT *, {_CORNERS} FROM det0), det AS (SELECT *, {_AREA} FROM det1)"""
H = "hs AS (SELECT image_id, max(phash) AS phash, max(phash_mirror) AS phash_mirror FROM hashes WHERE image_id IS NOT NULL GROUP BY image_id)"


def _override(column: str, kind: str) -> str:
    return f"CASE WHEN trim({column}) <> '' AND lower(trim({column})) <> 'default' THEN CAST(trim({column}) AS {kind}) END"


CAT = f"""
cat AS (SELECT DISTINCT project_id || '-v' || coalesce(trim(version), '') AS dataset, enabled = '1' AS enabled, download = '1' AS download, coalesce(trim(version), '') <> '' AS pinned, workspace_id,
  string_split(escooter_class_name, '|') AS class_names, {_override('variety_min_instances', 'INT')} AS variety_min, {_override('closeup_area_threshold', 'DOUBLE')} AS closeup,
  {_override('faraway_area_threshold', 'DOUBLE')} AS faraway, {_override('phash_distance_threshold', 'INT')} AS phash_max FROM datasets_to_download)"""
EFF = "eff AS (SELECT dataset, coalesce(variety_min, 1) AS variety_min, coalesce(closeup, 4e-1) AS closeup, coalesce(faraway, 1e-3) AS faraway, coalesce(phash_max, 8) AS phash_max FROM cat)"
LOG = """
log AS (SELECT event_id AS seq, 'picture_' || user_id AS name, CASE event_type WHEN 'purchase' THEN 'select' WHEN 'error' THEN 'discard' WHEN 'signup' THEN 'reserve' END AS decision, value FROM events),
decided AS (SELECT * FROM (SELECT name, arg_max({'d': decision}, seq).d AS decision FROM log GROUP BY name) WHERE decision IS NOT NULL)"""
RUNS = """
runs AS (SELECT event_type AS run, date_diff('day', DATE '2024-01-01', ts::DATE)::INT AS epoch, max(event_id)::DOUBLE AS time, round(max(value) / 1e3, 9) AS map50, round(min(value) / 1e3, 9) AS map50_95 FROM events GROUP BY ALL)"""


def overlap_sql(a: str, b: str) -> str:
    """Area that the boxes of two aliases share."""
    return f"(greatest(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1), 0e0) * greatest(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1), 0e0))"


def area_sql(a: str) -> str:
    return f"(greatest({a}.x2 - {a}.x1, 0e0) * greatest({a}.y2 - {a}.y1, 0e0))"


def containment_sql(a: str, b: str) -> str:
    return f"coalesce({overlap_sql(a, b)} / nullif({area_sql(a)}, 0e0), 0e0)"


def iou_sql(a: str, b: str) -> str:
    return f"coalesce({overlap_sql(a, b)} / nullif({area_sql(a)} + {area_sql(b)} - {overlap_sql(a, b)}, 0e0), 0e0)"


def greedy_sql(truth: str, said: str, least: str) -> str:
    """won (image_id, class_id, gt, ord, iou): each prediction, the most confident first, takes its best free true box. Needs WITH RECURSIVE."""
    return f"""
met AS (SELECT t.image_id, t.class_id, t.ord AS gt, s.ord, s.conf, {iou_sql('t', 's')} AS iou FROM {truth} t JOIN {said} s USING (image_id, class_id)),
hits AS (SELECT image_id, class_id, ord, conf, list(gt ORDER BY iou DESC, gt) AS gts FROM met WHERE iou >= {least} GROUP BY ALL),
turns AS (SELECT *, row_number() OVER (PARTITION BY image_id, class_id ORDER BY conf DESC, ord) AS turn FROM hits),
fold AS (SELECT DISTINCT image_id, class_id, 0::BIGINT AS turn, []::INT[] AS taken, NULL::INT AS gt, NULL::INT AS ord FROM turns
  UNION ALL SELECT image_id, class_id, turn, CASE WHEN gt IS NULL THEN taken ELSE list_append(taken, gt) END, gt, ord
  FROM (SELECT r.image_id, r.class_id, r.turn, f.taken, ([x FOR x IN r.gts IF NOT list_contains(f.taken, x)])[1] AS gt, r.ord FROM fold f JOIN turns r ON r.image_id = f.image_id AND r.class_id = f.class_id AND r.turn = f.turn + 1)),
won AS (SELECT f.image_id, f.class_id, f.gt, f.ord, met.iou FROM fold f JOIN met ON met.image_id = f.image_id AND met.class_id = f.class_id AND met.gt = f.gt AND met.ord = f.ord)"""
