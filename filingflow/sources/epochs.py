"""Tables that grow by numbered writes and are merged from time to time.

A write goes to a folder of its own, ``root/epoch_id=N``; the same number written
again replaces that folder, so a retried write adds nothing twice.  A merge reduces
the present content to a new base folder and then puts a manifest in place by one
rename; it names the base and the last number that it holds.  Readers take the
manifest with the highest number, its base, and the folders after it:

* a merge that ends before its manifest leaves an unused folder and no other trace;
* a reader never lists more folders than two merges are apart;
* what a merge replaced is removed by the next one, so that a reader which began
  with the older manifest still finds its files.

One writer at a time appends and merges, as Structured Streaming's sinks do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Writes after which they are merged.
MERGE_EVERY = 50
_MANIFEST, _BASE, _EPOCH = "_manifest", "_base", "epoch_id"


class EpochTable:
    """``merge`` gives the rows that stand for those it gets, which carry ``epoch_id``
    (it keeps the column): merging twice, or merging parts first, must not differ."""

    def __init__(self, spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame], every: int = MERGE_EVERY):
        self.spark, self.root, self.merge, self.every = spark, root.rstrip("/"), merge, every
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # What is there ------------------------------------------------------------------
    def _names(self, pattern: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.globStatus(self._path(f"{self.root}/{pattern}")) or ())

    def _manifests(self) -> list[str]:
        return [n for n in self._names(f"{_MANIFEST}/*") if n.isdigit()]

    def state(self) -> dict:
        """The present manifest: ``base`` (folder name or none) and ``merged`` (last number in it)."""
        found = self._manifests()
        if not found:
            return {"base": None, "merged": None}
        stream = self._fs.open(self._path(f"{self.root}/{_MANIFEST}/{found[-1]}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def epochs(self, after: int | None = None) -> list[int]:
        """Numbers of the folders written after the one given."""
        found = sorted(int(n.split("=", 1)[1]) for n in self._names(f"{_EPOCH}=*"))
        return [n for n in found if after is None or n > after]

    def paths(self) -> list[str]:
        """The folders that a read touches."""
        now = self.state()
        base = [f"{self.root}/{_BASE}/{now['base']}"] if now["base"] else []
        return base + [f"{self.root}/{_EPOCH}={n}" for n in self.epochs(now["merged"])]

    def _read(self, upto: int | None = None) -> DataFrame | None:
        now, parts = self.state(), []
        if now["base"]:
            parts.append(self.spark.read.parquet(f"{self.root}/{_BASE}/{now['base']}"))
        newer = [n for n in self.epochs(now["merged"]) if upto is None or n <= upto]
        if newer:
            part = self.spark.read.option("basePath", self.root).parquet(*[f"{self.root}/{_EPOCH}={n}" for n in newer])
            parts.append(part.withColumn(_EPOCH, F.col(_EPOCH).cast("bigint")))
        return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def rows(self) -> DataFrame | None:
        """The merged rows with ``epoch_id``; none if nothing was ever written."""
        found = self._read()
        return None if found is None else self.merge(found)

    # Changes --------------------------------------------------------------------------
    def write(self, rows: DataFrame, epoch: int) -> None:
        """Writes number ``epoch``.  Before it, if enough have gathered, all earlier
        ones are merged: a number that is written has been committed by the caller
        once a later one comes, so only the last is ever written again."""
        now = self.state()
        if now["merged"] is not None and epoch <= now["merged"]:
            raise ValueError(f"write {epoch} is already merged (up to {now['merged']})")
        if len([n for n in self.epochs(now["merged"]) if n < epoch]) >= self.every:
            self.compact(epoch - 1)
        rows.write.mode("overwrite").parquet(f"{self.root}/{_EPOCH}={epoch}")

    def compact(self, upto: int | None = None) -> None:
        """Merges the writes up to a number (all) into a new base."""
        before = self.state()
        newer = [n for n in self.epochs(before["merged"]) if upto is None or n <= upto]
        if not newer:
            return
        base = uuid.uuid4().hex
        self.merge(self._read(upto)).write.parquet(f"{self.root}/{_BASE}/{base}")
        self._commit({"base": base, "merged": newer[-1]})
        # What the manifest before this one no longer needed goes now.
        for n in self.epochs():
            if before["merged"] is not None and n <= before["merged"]:
                self._drop(f"{_EPOCH}={n}")
        for name in self._names(f"{_BASE}/*"):
            if name not in (base, before["base"]):
                self._drop(f"{_BASE}/{name}")
        for name in self._manifests()[:-2]:
            self._drop(f"{_MANIFEST}/{name}")

    def _commit(self, manifest: dict) -> None:
        """A manifest appears whole, by one rename."""
        found = self._manifests()
        number = int(found[-1]) + 1 if found else 0
        aside = self._path(f"{self.root}/{_MANIFEST}/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._fs.rename(aside, self._path(f"{self.root}/{_MANIFEST}/{number:010d}")):
            raise OSError(f"manifest {number} was not put in place: another writer was faster")

    def _drop(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{name}"), True)
