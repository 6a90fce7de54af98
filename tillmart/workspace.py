"""Durable intermediate tables.

Tables that several jobs read are written once as Parquet below the cluster's shared
checkpoint folder. A lost executor then costs a re-read, not a recomputation, and every
reader sees the same rows.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tillmart-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


@dataclass
class Workspace:
    """A folder of this run. ``rows`` holds the row count of every table written."""

    spark: SparkSession
    location: str = ""
    rows: dict[str, int] = field(default_factory=dict)
    _tries: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.location:
            self.location = f"{shared_folder(self.spark).rstrip('/')}/tillmart-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        """Folder of the latest attempt to write ``name``."""
        tries = self._tries.get(name, 1)
        return f"{self.location}/{name}" + (f"-{tries}" if tries > 1 else "")

    def store(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and return the written table. Every attempt has a folder of its own, so a
        failed one can be repeated.

        Counts are observed in the writing stage, above the last shuffle: Spark adds up the
        updates of a result task once, so a task run twice does not count twice.
        """
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        self._tries[name] = self._tries.get(name, 0) + 1
        folder = self.path(name)
        observed.write.option("compression", "zstd").parquet(folder)
        self.rows[name] = seen.get["rows"]
        return self.spark.read.schema(df.schema).parquet(folder)

    def discard(self) -> None:
        """Delete the tables of this run; call it once nothing reads them any more."""
        self._delete(self.location)

    def drop(self, name: str) -> None:
        """Delete the latest attempt's table ``name``; call it once nothing reads it any more."""
        self._delete(self.path(name))

    def _delete(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
