"""Tables written to the cluster's shared checkpoint folder to cut lineage.

A written table survives the loss of executors, is columnar and compressed, and
can be read again by several branches of a plan without recomputing it.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset, and only in a local session."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="frameloom-checkpoint-")
        spark.sparkContext.setCheckpointDir(named)
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def spread(spark: SparkSession) -> int:
    """Partitions for a stage whose work is in no proportion to its bytes: the session's number, two per core at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 2 * spark.sparkContext.defaultParallelism)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Written intermediate tables of one query.

    `keep` writes a frame and returns it as read back; `drop` deletes a table that
    no later step reads. What is still there is deleted when the application ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/frameloom-{label}-{uuid.uuid4().hex}"
        self._n = 0
        self._paths: dict[int, str] = {}
        atexit.register(self._clear)

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self._n:04d}"
        self._n += 1
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = path
        back._frameloom_path = path
        return back

    def folder(self, name: str) -> str:
        """A path for files of one's own, deleted with the tables."""
        return f"{self.root}/{name}"

    def drop(self, *frames: DataFrame | None) -> None:
        for df in frames:
            path = getattr(df, "_frameloom_path", None)
            if path:
                _delete(self.spark, path)

    def _clear(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None and not self.spark.sparkContext._jsc.sc().isStopped():
                _delete(self.spark, self.root)
        except Exception:  # the session may be gone already
            pass
