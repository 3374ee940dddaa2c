"""Tables that are replaced by key, in one step that readers see whole or not at all.

A publication writes its rows to a folder of their own, checks what was written, and then adds a manifest that names, for every
partition value, the folder that holds it now. The manifest appears by one rename, so a writer that dies before it leaves the
last snapshot as it was; its rows are never read. Two writers that start from the same snapshot cannot both add
the next manifest: the second one fails, and may publish again.

Only partitions that the new rows touch are rewritten. Within them, rows with a new key are replaced and others kept, or, where the
caller says so, the whole partition is replaced.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"


class DuplicateKeys(RuntimeError):
    """The new rows hold a key more than once; nothing was published."""


class Conflict(RuntimeError):
    """Somebody else published since this writer read the table; nothing was published."""


class PublishedTable:
    """One table below `path` with unique `keys`, of which `partition` names the folder."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], partition: str = "as_of"):
        self.spark, self.path, self.keys, self.partition = spark, path.rstrip("/"), list(keys), partition
        # partition columns come last in what Spark reads
        fields = [f for f in schema if f.name != partition]
        self.schema = StructType([*fields, schema[partition]])
        if partition not in keys:
            raise ValueError(f"{partition} must be one of the keys")

    # -- manifests

    def _hadoop(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _files(self):
        return self._hadoop().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """Number of the newest snapshot, 0 of a table that was never published."""
        files, folder = self._files(), self._hadoop(MANIFESTS)
        if not files.exists(folder):
            return 0
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_"))), default=0)

    def manifest(self, version: int | None = None) -> dict[str, str]:
        """Partition value -> batch that holds it, of the newest snapshot or an earlier one."""
        version = self.version() if version is None else version
        if not version:
            return {}
        row = self.spark.read.text(f"{self.path}/{MANIFESTS}/{version:010d}.json", wholetext=True).first()
        return json.loads(row[0])

    def _commit(self, version: int, manifest: dict[str, str]) -> None:
        """Add a manifest under its number, which must be free."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        waiting, final = self._hadoop(MANIFESTS, f".{uuid.uuid4().hex}"), self._hadoop(MANIFESTS, f"{version:010d}.json")
        out = self._files().create(waiting, False)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf)
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(waiting, final, options)
        except Py4JJavaError as e:
            self._files().delete(waiting, False)
            if "FileAlreadyExists" in str(e.java_exception.getClass()):
                raise Conflict(f"snapshot {version} of {self.path} was published by somebody else") from e
            raise

    # -- rows

    def _rows(self, manifest: dict[str, str]) -> DataFrame:
        if not manifest:
            return self.spark.createDataFrame([], self.schema)
        folders = [f"{self.path}/batch={batch}/{value}" for value, batch in sorted(manifest.items())]
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders).select(*self.schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest snapshot, or an earlier one. Filters on the partition column choose folders."""
        return self._rows(self.manifest(version))

    def publish(
        self, rows: DataFrame, audit: Callable[[DataFrame], None] | None = None, whole_partitions: bool = False
    ) -> int:
        """Replace the rows of the same keys, or of the same partitions, and return the number of the new snapshot.

        `audit` sees the rows as they were written, and raises to refuse them.
        """
        version = self.version()
        before = self.manifest(version)
        written = self._write(rows.select(*self.schema.names))
        fresh = self._rows(written)
        if audit:
            audit(fresh)
        doubled = fresh.groupBy(*self.keys).count().filter("count > 1").limit(1).collect()
        if doubled:
            raise DuplicateKeys(f"{self.path}: {', '.join(f'{k}={doubled[0][k]}' for k in self.keys)}")
        touched = {value: batch for value, batch in before.items() if value in written and not whole_partitions}
        if touched:
            kept = self._rows(touched).join(fresh.select(*self.keys), self.keys, "left_anti")
            written = self._write(kept.unionByName(fresh))
        self._commit(version + 1, before | written)
        return version + 1

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Rows in a batch of their own, and its partitions. A partition's rows stay spread over the tasks that hold them."""
        batch = uuid.uuid4().hex
        folder = self._hadoop(f"batch={batch}")
        rows.write.partitionBy(self.partition).parquet(f"{self.path}/batch={batch}")
        names = [status.getPath().getName() for status in self._files().listStatus(folder) if status.isDirectory()]
        return {name: batch for name in names if name.startswith(f"{self.partition}=")}

    def vacuum(self, keep: int = 1) -> int:
        """Delete batches that none of the newest `keep` snapshots reads, and their manifests; returns how many batches went.

        Batches of writers at work are not named anywhere yet: call it when nobody publishes.
        """
        newest, files = self.version(), self._files()
        kept = range(max(newest - keep, 0) + 1, newest + 1)
        live = {batch for v in kept for batch in self.manifest(v).values()}
        gone = 0
        for status in files.listStatus(self._hadoop()):
            name = status.getPath().getName()
            if name.startswith("batch=") and name.removeprefix("batch=") not in live:
                files.delete(status.getPath(), True)
                gone += 1
        for status in files.listStatus(self._hadoop(MANIFESTS)):
            name = status.getPath().getName()
            if name.endswith(".json") and name[0].isdigit() and int(name.removesuffix(".json")) not in kept:
                files.delete(status.getPath(), False)
        return gone


def stamped(rows: DataFrame, column: str, at=None) -> DataFrame:
    """`rows` with the time of publication, a wall-clock time without zone; `at` gives it for a replay."""
    when = F.localtimestamp() if at is None else at
    return rows.withColumn(column, when.cast("timestamp_ntz"))
