"""Label text files, lists and caches as DataFrames.

Label lines are rows (path, line_no, raw): read from files by `label_lines`, or from any table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def label_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, line_no, raw) of text files; line numbers start at 1; an empty file gives one row of raw ''.

    Each file is read whole by one task, as label files hold one picture's boxes. Scans leave
    out files of no bytes, so these come from the listing that every scan makes anyway.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    lines = F.split(F.regexp_replace(F.decode("content", "UTF-8"), r"\r?\n\z", ""), r"\r?\n")
    read = files.select("path", F.posexplode(lines).alias("at", "raw")).select("path", (F.col("at") + 1).alias("line_no"), "raw")
    same = lambda p: F.regexp_replace(p, "^file:/+", "file:/")
    listed = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string")
    empty = listed.join(files.select(same(F.col("path")).alias("p")), same(F.col("path")) == F.col("p"), "left_anti")
    return read.unionByName(empty.select("path", F.lit(1).alias("line_no"), F.lit("").alias("raw")))


def label_path(image_path: Column) -> Column:
    """The label file of a picture: the last /images/ becomes /labels/, the extension .txt."""
    return F.regexp_replace(F.regexp_replace(image_path, r"^(.*)/images/", "$1/labels/"), r"\.[^./]*$", ".txt")


def fields(raw: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(raw, r"\s+", " ")), " ")


def parse_boxes(lines: DataFrame, key: list[str], mode: str = "lenient") -> DataFrame:
    """Boxes of label lines: key, box_ord, class_id, xc, yc, w, h, error.

    lenient: lines of other than five fields are ignored, the class must be an integer;
    tolerant: likewise, the class may be written 80.0; first: any line that isn't blank counts,
    only its class is read; strict: five fields or more, all finite numbers, an integral
    class: else error names the place. Lines that can't be read have an error in strict mode
    and are left out in the others.
    """
    p = lines.withColumn("__p", fields(F.col("raw"))).withColumn("__blank", F.trim("raw") == "")
    n = F.size("__p")
    number = lambda i: F.get("__p", F.lit(i)).try_cast("double")
    as_double = number(0)
    whole = F.when(as_double == F.floor(as_double), as_double.cast("int")) if mode in ("strict", "tolerant", "first") else F.get("__p", F.lit(0)).try_cast("int")
    if mode == "tolerant":
        whole = as_double.cast("int")
    values = [number(i) for i in range(1, 5)]
    finite = [v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")) for v in values]
    good = whole.isNotNull()
    if mode != "first":
        for v in values:
            good = good & v.isNotNull()
    if mode == "strict":
        for f in finite:
            good = good & f
        good = good & (n >= 5)
    elif mode in ("lenient", "tolerant"):
        good = good & (n == 5)
    error = F.when(~F.col("__blank") & ~F.coalesce(good, F.lit(False)), F.concat_ws(":", *key, F.col("line_no").cast("string")))
    out = p.where(~F.col("__blank")).select(*key, F.col("line_no").alias("box_ord"), whole.alias("class_id"), *(v.alias(c) for v, c in zip(values, ("xc", "yc", "w", "h"))), error.alias("error"))
    return out if mode == "strict" else out.where("error IS NULL").drop("error")


def fail_on_errors(boxes: DataFrame) -> DataFrame:
    """The boxes of a strict parse; raises at run time, naming the first bad line met."""
    return boxes.where(F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("bad label line "), F.col("error"))).cast("boolean")).otherwise(F.lit(True))).drop("error")


def read_list(spark: SparkSession, path: str, comments: bool = True, limit: int | None = None) -> DataFrame:
    """(ord, value) of the lines of a text file that aren't blank or `#` comments, trimmed, repeats kept."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("ord", "value")).withColumn("value", F.trim("value")).where("value <> ''")
    if comments:
        lines = lines.where("NOT value LIKE '#%'")
    return lines.orderBy("ord").limit(limit) if limit is not None else lines


def read_flags(spark: SparkSession, path: str) -> DataFrame:
    """(name, class_name, conf, containment, label) of a tab-separated flag list."""
    p = F.split("value", "\t")
    after = lambda i: F.split_part(F.get("p", F.lit(i)), F.lit("="), F.lit(2)).try_cast("double")
    return spark.read.text(path).where("trim(value) <> ''").withColumn("p", p).select(F.get("p", F.lit(0)).alias("name"), F.get("p", F.lit(1)).alias("class_name"), after(2).alias("conf"), after(3).alias("containment"), F.get("p", F.lit(4)).alias("label"))


def catalog_lines(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of raw CSV lines (line_no, raw), with `error` where a line has more or fewer fields."""
    p = F.split("raw", ",", -1)
    bad = F.when(F.size(p) != len(columns), F.format_string("line %d: %d fields, %d wanted", F.col("line_no"), F.size(p), F.lit(len(columns))))
    return lines.select("line_no", *(F.get(p, F.lit(i)).alias(c) for i, c in enumerate(columns)), bad.alias("error"))


def override(text: Column, kind: str) -> Column:
    """A parameter override: null for empty or `default` in any case; an error for what is no number."""
    t = F.trim(text)
    return F.when(~((t == "") | (F.lower(t) == "default")), t.cast(kind))


DETECTIONS = "map<string, struct<mtime: double, size: bigint, capture_conf: double, orig_shape: array<int>, detections: map<string, array<array<double>>>>>"


def cached_detections(cache: DataFrame, raw: str = "raw", with_conf: bool = True) -> DataFrame:
    """Rows (key, det_ord, class_id, conf, x1, y1, x2, y2, height, width) of JSON caches, orientation 0.

    Keys beginning with two underscores are notes on the cache, not pictures.
    """
    entries = cache.select(F.explode(F.map_filter(F.from_json(F.col(raw), DETECTIONS), lambda k, v: ~k.startswith("__"))).alias("key", "e"))
    each = entries.select("key", "e.orig_shape", F.posexplode(F.coalesce(F.element_at("e.detections", "0"), F.array())).alias("det_ord", "d"))
    at = 1 if with_conf else 0
    conf = F.get("d", F.lit(1)) if with_conf else F.lit(None).cast("double")
    return each.select("key", "det_ord", F.get("d", F.lit(0)).cast("int").alias("class_id"), conf.alias("conf"), *(F.get("d", F.lit(at + i)).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"), 1)), F.get("orig_shape", F.lit(0)).alias("height"), F.get("orig_shape", F.lit(1)).alias("width"))


def stale(files: DataFrame, cache: DataFrame, conf: float | None = None) -> DataFrame:
    """Files (key, mtime, size) whose cached entry is missing, of another mtime or size, or captured above `conf`."""
    fresh = cache if conf is None else cache.where(F.col("capture_conf") <= F.lit(conf))
    return files.join(fresh.select("key", "mtime", "size"), ["key", "mtime", "size"], "left_anti")


def run_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A results.csv with blanks in its header names trimmed."""
    df = spark.read.csv(path, header=True, inferSchema=True, ignoreLeadingWhiteSpace=True)
    return df.withColumnsRenamed({c: c.strip() for c in df.columns})


EVAL_REPORT = "map<string, map<string, struct<precision: double, recall: double, mAP50: double, `mAP50-95`: double, size_breakdown: struct<recall_by_gt_size: map<string, struct<tp: bigint, fn: bigint>>, false_positives_by_pred_size: map<string, bigint>>>>>"


def eval_reports(reports: DataFrame, raw: str = "raw", names: list[str] | None = None) -> DataFrame:
    """(weights, testset, precision, recall, map50, map50_95, recall_by_size, false_by_size) of JSON reports.

    `names`: only of weights with one of these among the levels of their path.
    """
    w = reports.select(F.explode(F.from_json(F.col(raw), EVAL_REPORT)).alias("weights", "of"))
    if names is not None:
        w = w.where(F.arrays_overlap(F.split("weights", "/"), F.array(*map(F.lit, names))))
    e = w.select("weights", F.explode("of").alias("testset", "r"))
    return e.select("weights", "testset", "r.precision", "r.recall", F.col("r.mAP50").alias("map50"), F.col("r.`mAP50-95`").alias("map50_95"), F.col("r.size_breakdown.recall_by_gt_size").alias("recall_by_size"), F.col("r.size_breakdown.false_positives_by_pred_size").alias("false_by_size"))
