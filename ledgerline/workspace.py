"""Where jobs keep files between steps: the shared folder the cluster names, never a machine's own disk."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# The temporary folder of each local session that names none.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only for a local session that names none."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if context.applicationId not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="ledgerline-")
        root = _LOCAL_ROOTS[context.applicationId]
    return root.rstrip("/")


class Workspace:
    """One run's folder and database below the shared root. Runs meet only if they are given the same name."""

    def __init__(self, spark: SparkSession, label: str, run: str | None = None):
        self.spark = spark
        self.run = f"{label}_{run or uuid.uuid4().hex[:12]}"
        self.root = f"{shared_root(spark)}/{self.run}"

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def database(self) -> str:
        """A database whose managed tables live in this run's folder."""
        name = f"ledgerline_{self.run}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{self.path('tables')}'")
        return name

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once as Parquet and go on from the file: later steps neither re-parse nor recompute it."""
        df.write.mode("overwrite").parquet(self.path("kept", name))
        return self.spark.read.schema(df.schema).parquet(self.path("kept", name))

    def discard(self, *parts: str) -> None:
        """Delete one of this run's folders once nothing reads it any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(*parts))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Have Spark delete the shuffle files of steps that are over: it does so when the driver collects its garbage."""
        self.spark._jvm.System.gc()
