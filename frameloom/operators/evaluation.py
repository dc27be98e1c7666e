"""Detection metrics from matched boxes: size-bucketed recall, average precision, curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.functions.geometry import size_bucket
from frameloom.plans.ranks import running_totals
from frameloom.plans.scratch import Scratch

IOU_THRESHOLDS = tuple(x / 100 for x in range(50, 100, 5))


def size_breakdown(matched: DataFrame) -> DataFrame:
    """(bucket, tp, fn, fp, recall): true boxes by their own size, false predictions by theirs; recall null of none."""
    b = matched.withColumn("bucket", size_bucket(F.col("pixels")))
    out = b.groupBy("bucket").agg(F.count_if(F.col("is_gt") & F.col("matched")).alias("tp"), F.count_if(F.col("is_gt") & ~F.col("matched")).alias("fn"), F.count_if(~F.col("is_gt") & ~F.col("matched")).alias("fp"))
    return out.withColumn("recall", F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0)))


def _curve(steps: DataFrame, groups: list[str], scratch: Scratch) -> DataFrame:
    """steps (groups, conf, t, n, positives) with tp, all_, recall, precision and precision's envelope, any number of rows per group."""
    down = scratch.keep(steps.withColumn("__down", -F.col("conf")))
    run = running_totals(down, ["__down"], "t", scratch, "tp", groups)
    run = running_totals(run, ["__down"], "n", scratch, "all_", groups).withColumns({"tp": (F.col("tp") + F.col("t")).cast("bigint"), "all_": (F.col("all_") + F.col("n")).cast("bigint")})
    run = run.withColumns({"recall": F.col("tp") / F.col("positives"), "precision": F.col("tp") / F.col("all_")})
    return running_totals(run, ["conf"], "precision", scratch, "envelope", groups, greatest=True).drop("__down")


def precision_recall(matched: DataFrame, scratch: Scratch) -> DataFrame:
    """Per class and distinct confidence: recall, precision, and precision's envelope (greatest at this recall or more)."""
    truth = matched.where("is_gt").groupBy("class_id").agg(F.count(F.lit(1)).alias("positives"))
    steps = matched.where("NOT is_gt").groupBy("class_id", "conf").agg(F.count_if("matched").alias("t"), F.count(F.lit(1)).alias("n"))
    curve = _curve(steps.join(truth, "class_id"), ["class_id"], scratch)
    return curve.select("class_id", "conf", "t", "tp", (F.col("all_") - F.col("tp")).alias("fp"), "positives", "recall", "precision", "envelope")


def average_precision(matched: DataFrame, scratch: Scratch) -> DataFrame:
    """(class_id, positives, ap): area under the precision envelope over recall; classes without predictions have 0."""
    area = precision_recall(matched, scratch).groupBy("class_id").agg(F.sum(F.col("t") / F.col("positives") * F.col("envelope")).alias("ap"))
    truth = matched.where("is_gt").groupBy("class_id").agg(F.count(F.lit(1)).alias("positives"))
    return truth.join(area, "class_id", "left").withColumn("ap", F.coalesce("ap", F.lit(0.0)))


def mean_average_precision(truth: DataFrame, predictions: DataFrame, matches: DataFrame, scratch: Scratch, thresholds: tuple[float, ...] = IOU_THRESHOLDS) -> DataFrame:
    """(class_id, positives, ap50, ap50_95): average precision at the first of the thresholds, and its mean over all.

    matches: `matching.matches_by_threshold`. Per threshold as `average_precision`.
    """
    positives = truth.groupBy("class_id").agg(F.count(F.lit(1)).alias("positives"))
    at = F.explode(F.array(*(F.lit(float(x)) for x in thresholds))).alias("iou_min")
    said = predictions.groupBy("class_id", "conf").agg(F.count(F.lit(1)).alias("n")).select("class_id", "conf", "n", at)
    hit = matches.groupBy("class_id", "iou_min", "conf").agg(F.count(F.lit(1)).alias("t"))
    steps = said.join(hit, ["class_id", "iou_min", "conf"], "left").join(positives, "class_id").withColumn("t", F.coalesce("t", F.lit(0)))
    run = _curve(steps, ["class_id", "iou_min"], scratch)
    ap = run.groupBy("class_id", "iou_min").agg(F.sum(F.col("t") / F.col("positives") * F.col("envelope")).alias("ap"))
    both = ap.groupBy("class_id").agg(F.max(F.when(F.col("iou_min") == float(thresholds[0]), F.col("ap"))).alias("ap50"), (F.sum("ap") / F.lit(len(thresholds))).alias("ap50_95"))
    return positives.join(both, "class_id", "left").select("class_id", "positives", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("ap50", "ap50_95")))


def at_confidence(curve: DataFrame, conf: float) -> DataFrame:
    """(class_id, precision, recall) at a confidence, linearly between the neighbouring points of the curve.

    Above the greatest confidence recall is 0 and precision 1; below the least the last point holds.
    """
    point = F.struct("conf", "precision", "recall")
    ends = curve.groupBy("class_id").agg(F.max(F.when(F.col("conf") <= conf, point)).alias("lo"), F.min(F.when(F.col("conf") > conf, point)).alias("hi"))
    t = (F.lit(conf) - F.col("lo.conf")) / (F.col("hi.conf") - F.col("lo.conf"))

    def value(c: str, top: float) -> F.Column:
        lo, hi = F.col(f"lo.{c}"), F.col(f"hi.{c}")
        return F.when(F.col("lo").isNull(), hi).when(F.col("hi").isNotNull(), lo + t * (hi - lo)).when(F.col("lo.conf") == conf, lo).otherwise(F.lit(top))

    return ends.select("class_id", value("precision", 1.0).alias("precision"), value("recall", 0.0).alias("recall"))


def class_means(metrics: DataFrame, by: list[str], value: str = "ap") -> DataFrame:
    """Unweighted mean over classes."""
    return metrics.groupBy(*by).agg(F.avg(value).alias(f"mean_{value}"), F.count(F.lit(1)).alias("classes"))


def compare_classes(baseline: DataFrame, trained: DataFrame, value: str = "ap") -> DataFrame:
    """Per class both values and the difference in percentage points."""
    b, t = baseline.select("class_id", F.col(value).alias("baseline")), trained.select("class_id", F.col(value).alias("trained"))
    return b.join(t, "class_id").withColumn("delta", (F.col("trained") - F.col("baseline")) * F.lit(100.0))
