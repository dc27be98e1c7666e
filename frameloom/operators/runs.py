"""Training runs: metrics by epoch, comparisons, milestones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_epoch(metrics: DataFrame, run: str = "run") -> DataFrame:
    """Per run the row of the greatest map50_95 (missing counts as 0), the first of equals, and the last epoch and hours."""
    m = F.coalesce("map50_95", F.lit(0.0))
    return metrics.groupBy(run).agg(F.max_by("epoch", F.struct(m, -F.col("epoch"))).alias("best_epoch"), F.max(m).alias("best_map50_95"), F.max("epoch").alias("last_epoch"), (F.max_by("time", "epoch") / F.lit(3600.0)).alias("hours"), F.count(F.lit(1)).alias("epochs"))


def compare_curves(run: DataFrame, baseline: DataFrame) -> DataFrame:
    """Per epoch of a run its metrics, the baseline's and the difference; `state` where the baseline had stopped."""
    b = baseline.select("epoch", F.col("map50").alias("base_map50"), F.col("map50_95").alias("base_map50_95"))
    j = run.select("epoch", "map50", "map50_95").join(b, "epoch", "left")
    return j.withColumns({"delta50": F.col("map50") - F.col("base_map50"), "delta50_95": F.col("map50_95") - F.col("base_map50_95"), "state": F.when(F.col("base_map50").isNull(), "(baseline stopped)").otherwise("compared")})


def recall_table(reports: DataFrame) -> DataFrame:
    """(weights, testset, bucket, tp, fn, recall) of evaluation reports; recall null of nothing."""
    e = reports.select("weights", "testset", F.explode("recall_by_size").alias("bucket", "c"))
    return e.select("weights", "testset", "bucket", "c.tp", "c.fn", (F.col("c.tp") / F.nullif(F.col("c.tp") + F.col("c.fn"), F.lit(0))).alias("recall"))


def latest(files: DataFrame, by: str, path: str = "path", mtime: str = "mtime") -> DataFrame:
    """Per group the path of the latest mtime; of equals the greatest path."""
    return files.groupBy(by).agg(F.max_by(path, F.struct(mtime, path)).alias(path), F.max(mtime).alias(mtime))


def preferred_version(versions: DataFrame) -> DataFrame:
    """Per project the greatest version without augmentation, else the greatest of all."""
    return versions.groupBy("project_id").agg(F.max(F.struct(~F.col("augmented"), F.col("version"))).alias("m")).select("project_id", F.col("m.version").alias("version"))
