"""Queries through real files: tables are written as the lists, indexes, flags and results the tools keep, and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.catalogue.registry import query
from frameloom.catalogue.views import BX, DET, IMG, RUNS, SB, Views
from frameloom.functions import names as N
from frameloom.functions import text as T
from frameloom.plans.scratch import Scratch
from frameloom.sources import labels as L
from frameloom.sources import sinks


@query(f"WITH {IMG} SELECT dataset || '/' || split || '/' || file AS value, count(*) AS n FROM img GROUP BY 1")
def a13_list_lines(v: Views) -> DataFrame:
    """A list of pictures, a line each, with comments and blank lines among them, written and read."""
    path = Scratch(v.spark, "a13").folder("list")
    img = v.pick(file=N.path_file(F.col("image_path"))).select("image_id", F.concat_ws("/", "dataset", "split", "file").alias("line"))
    notes = v.spark.createDataFrame([(-1, "# pictures"), (-2, "  ")], "image_id bigint, line string")
    sinks.write_list(img.unionByName(notes), F.concat(F.lit(" "), "line"), ["line", "image_id"], path)
    return L.read_list(v.spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {IMG} SELECT image_id, dataset, split, width, excluded FROM img")
def a22_index_file(v: Views) -> DataFrame:
    """The image index as JSON lines in the order of its ids, nulls kept, written and read."""
    path = Scratch(v.spark, "a22").folder("index")
    sinks.write_index(v.pick(width=F.col("width"), excluded=F.col("excluded")).select("image_id", "dataset", "split", "width", "excluded"), "image_id", path)
    return v.spark.read.schema("image_id bigint, dataset string, split string, width int, excluded boolean").json(path)


@query(f"""WITH {IMG}, {BX}, {SB}, {DET} SELECT dataset || '/' || image_id AS name, 'class_' || class_id AS class_name, conf, round(greatest(least(5e-1, conf), 0), 2) AS containment, class_id || ' ' || ord AS label FROM det WHERE conf >= 45e-2""")
def a33_flag_lines(v: Views) -> DataFrame:
    """Flags of overlaps, the most confident first, written as tab-separated lines and read."""
    path = Scratch(v.spark, "a33").folder("flags")
    flags = v.det.where("conf >= 0.45").select(
        F.concat_ws("/", "dataset", "image_id").alias("name"), F.concat(F.lit("class_"), "class_id").alias("class_name"), "conf", F.least(F.lit(0.5), "conf").alias("containment"), F.concat_ws(" ", "class_id", "ord").alias("label"), "ord"
    )
    sinks.write_list(flags, sinks.overlap_flags(flags), [F.col("conf").desc(), "name", "ord"], path)
    return L.read_flags(v.spark, path)


@query(f"WITH {RUNS} SELECT run, epoch, map50, map50_95 FROM runs")
def a53_results_files(v: Views) -> DataFrame:
    """Results of runs, a CSV with blanks before its header names, written and read."""
    path = Scratch(v.spark, "a53").folder("results")
    runs = v.runs.select("run", "epoch", "map50", "map50_95")
    runs.toDF("run", "   epoch", " metrics/mAP50(B)", " metrics/mAP50-95(B)").write.option("header", "true").csv(path)
    got = L.run_metrics(v.spark, path)
    return got.select("run", F.col("epoch").cast("int").alias("epoch"), F.col("`metrics/mAP50(B)`").cast("double").alias("map50"), F.col("`metrics/mAP50-95(B)`").cast("double").alias("map50_95"))


@query(f"""WITH {BX} SELECT image_id, count(*) AS boxes, count(DISTINCT class_id) AS classes, round(sum(w), 6) AS widths FROM bx GROUP BY image_id""")
def a3_label_files(v: Views) -> DataFrame:
    """Label lines as text, written in parts and read leniently."""
    path = Scratch(v.spark, "a3").folder("labels")
    v.bx.select(F.concat_ws("\t", "image_id", F.concat_ws(" ", *(F.col(c).cast("string") for c in ("class_id", "xc", "yc", "w", "h")))).alias("value")).write.text(path)
    lines = v.spark.read.text(path).select(F.split_part("value", F.lit("\t"), F.lit(1)).cast("bigint").alias("image_id"), F.split_part("value", F.lit("\t"), F.lit(2)).alias("raw"))
    got = L.parse_boxes(lines.withColumn("line_no", F.lit(1)), ["image_id"])
    return got.groupBy("image_id").agg(F.count(F.lit(1)).alias("boxes"), F.countDistinct("class_id").alias("classes"), F.round(F.sum("w"), 6).alias("widths"))


@query(f"WITH {RUNS} SELECT run, printf('%.1f%%', 1e2 * avg((map50 >= 5e-1)::INT)) AS share FROM runs GROUP BY run")
def c26_percent_lines(v: Views) -> DataFrame:
    return v.runs.groupBy("run").agg(F.count_if(F.col("map50") >= 0.5).alias("k"), F.count(F.lit(1)).alias("n")).select("run", T.percent(F.col("k"), F.col("n")).alias("share"))
