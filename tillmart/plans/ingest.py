"""Counting what a scan brings, and storing what didn't fit."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillmart.sources.csv_feed import REJECTED, reject_rows
from tillmart.sources.tables import Target

_PART, _PLACE = "_part", "_place"
_PLACE_BITS = (1 << 33) - 1  # of monotonically_increasing_id: the row's place in its partition


class Ingest:
    """Rows of a scan with ``rejects``, counted while whoever reads ``rows`` first reads them.

    The counts are observed in a stage that writes a shuffle. If Spark repeats tasks of such a stage, because
    an executor was lost with their output, their rows are observed again. So the partitions are observed
    too: how many were begun, and which. If more were begun than there are, some counted twice, and
    the scan is counted anew by a query of its own, whose result doesn't depend on repeated tasks.
    """

    def __init__(self, scan: DataFrame):
        self.scan = scan
        self._seen = Observation(f"ingest-{uuid.uuid4().hex}")
        self._counts: dict[str, int] | None = None
        place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS))
        marked = scan.select("*", F.spark_partition_id().alias(_PART), place.alias(_PLACE))
        observed = marked.observe(
            self._seen, *self._wanted(),
            F.count(F.when(F.col(_PLACE) == 0, 1)).alias("begun"),
            F.collect_set(_PART).alias("parts"),
        )
        self.rows = observed.drop(REJECTED, _PART, _PLACE)

    @staticmethod
    def _wanted() -> list:
        rejected = F.coalesce(F.sum(F.size(REJECTED)), F.lit(0)).cast("bigint")
        return [F.count(F.lit(1)).alias("loaded"), rejected.alias("rejected")]

    @property
    def repeated(self) -> bool:
        """Whether a partition was observed more than once."""
        return self._seen.get["begun"] != len(self._seen.get["parts"])

    @property
    def counts(self) -> dict[str, int]:
        if self._counts is None:
            exact = self.scan.agg(*self._wanted()).first().asDict() if self.repeated else self._seen.get
            self._counts = {name: exact[name] for name in ("loaded", "rejected")}
        return self._counts

    @property
    def loaded(self) -> int:
        return self.counts["loaded"]

    @property
    def rejected(self) -> int:
        """Values that were not taken over as they are."""
        return self.counts["rejected"]

    def store_rejects(self, folder: str) -> int:
        """Write one row per rejected value: file, id, column, text, reason. Reads the feed again."""
        return Target(folder).write(reject_rows(self.scan), "rejects")
