"""Versions of a folder of tables: a log of commits, leases on what is still being written.

``versions/log`` holds one small file per published version, numbered from 1; its text is the name of the
version's folder, the highest number is the current version. A loader remembers the number it started
from and publishes by creating the next one, by a rename that does not overwrite: of two loaders that
started from one version the second one finds the number taken and learns that it was superseded.

While a version is staged its folder holds a lease, a file that the loader touches again and again.
Cleaning deletes a folder only if it is neither one of the last two published ones nor under a lease that is
still running, so it never takes another loader's half-written tables. Ages are measured by the store's
own clock.

The rename that does not overwrite is atomic on HDFS and stores like it. On a local disk there is a moment
between the look and the rename.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from threading import Event, Thread

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

VERSIONS, LOG, LEASE = "versions", "log", "_lease"
#: The pointer file of stars that were published before there was a log.
POINTER = "current"
#: Seconds after which a lease that was not renewed has run out, and between renewals.
LEASE_SECONDS, RENEW_SECONDS = 3600, 300


class Superseded(RuntimeError):
    """Another load published a version since this one began."""


class LeaseLost(RuntimeError):
    """The lease ran out and the staged version was cleaned away."""


class Versions:
    """The versions below ``location``."""

    def __init__(self, spark: SparkSession, location: str, lease_seconds: int = LEASE_SECONDS):
        self.spark = spark
        self.location = location.rstrip("/")
        self.lease_seconds = lease_seconds
        self._jvm = spark._jvm.org.apache.hadoop.fs
        path = self._jvm.Path(self.location)
        self._files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, *names: str):
        return self._jvm.Path("/".join([self.location, VERSIONS, *names]))

    def folder(self, name: str) -> str:
        return f"{self.location}/{VERSIONS}/{name}"

    def _write(self, path, text: str) -> None:
        out = self._files.create(path, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _read(self, path) -> str:
        return self.spark.read.text(path.toString()).first()[0]

    # --- published versions ---------------------------------------------------------------

    def number(self) -> int:
        """Number of the current version; 0 if none was published."""
        if not self._files.exists(self._path(LOG)):
            return 0
        names = [f.getPath().getName() for f in self._files.listStatus(self._path(LOG))]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def named(self, number: int) -> str | None:
        """Name of the folder that was published under ``number``."""
        if number > 0:
            return self._read(self._path(LOG, f"{number:012d}"))
        return self._read(self._path(POINTER)) if number == 0 and self._files.exists(self._path(POINTER)) else None

    def current(self) -> str | None:
        """Name of the current version's folder; None if none was published."""
        return self.named(self.number())

    def holds(self, name: str, table: str) -> bool:
        """Whether the version has the table."""
        return self._files.exists(self._path(name, table))

    def commit(self, name: str, started: int) -> int:
        """Publish the staged folder ``name`` as the version after ``started`` and return its number."""
        if not self._files.exists(self._path(name, LEASE)):
            raise LeaseLost(f"{name} was not renewed for {self.lease_seconds} seconds and is gone")
        if self.number() != started:
            raise Superseded(f"version {self.number()} was published after this load began with {started}")
        fresh = self._path(f"{name}.commit")
        self._write(fresh, name)
        self._files.mkdirs(self._path(LOG))
        context = self._jvm.FileContext.getFileContext(self._files.getUri(), self._files.getConf())
        none = self.spark.sparkContext._gateway.new_array(self._jvm.Options.Rename, 1)
        none[0] = self._jvm.Options.Rename.NONE
        target = self._path(LOG, f"{started + 1:012d}")
        try:
            context.rename(self._files.makeQualified(fresh), self._files.makeQualified(target), none)
        except Exception as error:
            if not self._files.exists(target):
                raise
            self._files.delete(fresh, False)
            raise Superseded(f"version {started + 1} was published by another load") from error
        self._files.delete(self._path(name, LEASE), False)
        return started + 1

    # --- staging --------------------------------------------------------------------------

    def stage(self) -> str:
        """Name of a fresh folder under a lease."""
        name = uuid.uuid4().hex
        self.renew(name)
        return name

    def renew(self, name: str) -> None:
        self._write(self._path(name, LEASE), name)

    @contextmanager
    def leased(self, name: str, every: float = RENEW_SECONDS):
        """Renew the lease in the background while the body runs."""
        ended = Event()

        def keep() -> None:
            while not ended.wait(every):
                self.renew(name)

        thread = Thread(target=inheritable_thread_target(self.spark)(keep), daemon=True)
        thread.start()
        try:
            yield
        finally:
            ended.set()
            thread.join()

    def discard(self, name: str) -> None:
        self._files.delete(self._path(name), True)

    def clean(self) -> list[str]:
        """Delete folders that are neither published lately nor under a running lease; returns their names."""
        now = self._clock()
        last = self.number()
        kept = {self.named(n) for n in (last, last - 1)}
        gone = []
        for found in self._files.listStatus(self._path()):
            name = found.getPath().getName()
            if not found.isDirectory() or name in kept or name == LOG:
                continue
            lease = self._path(name, LEASE)
            if self._files.exists(lease) and now - self._files.getFileStatus(lease).getModificationTime() < self.lease_seconds * 1000:
                continue
            self._files.delete(found.getPath(), True)
            gone.append(name)
        return gone

    def _clock(self) -> int:
        """The store's time, in milliseconds."""
        mark = self._path(f"{uuid.uuid4().hex}.clock")
        self._write(mark, "")
        now = self._files.getFileStatus(mark).getModificationTime()
        self._files.delete(mark, False)
        return now
