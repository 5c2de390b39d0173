"""Versions of a group of stored tables, switched all at once.

Tables live under ``<root>/<table>/load=<id>``; a load only writes new folders.
``<root>/_versions/<n>.json`` lists the folders that make up version ``n`` of
every table (for a partitioned table: the folder of each partition value), and
is put in place by one rename that fails if the version exists.  Readers take
the highest version.  So a load that dies between two tables leaves the version
before it, a retry adds nothing twice, two loads at once cannot both win, and a
frame read earlier keeps its files until ``vacuum``.

The lists hold one entry per load and partition value, not per file or row.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class VersionConflict(RuntimeError):
    """Another load has published the version this one was about to write."""


class TableGroup:
    """``schemas``: table -> StructType; ``partitions``: table -> partition
    column (text), for tables whose partitions are replaced by a load."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType], partitions: dict[str, str] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas, self.partitions = schemas, partitions or {}

    # ------------------------------------------------------------- files
    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    @property
    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, p = self._fs, self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("_versions") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> tuple[int, dict]:
        """(version, table -> folders or partition value -> folder); version 0
        has no rows."""
        have = self.versions()
        version = (have[-1] if have else 0) if version is None else version
        if version == 0:
            return 0, {t: {} if t in self.partitions else [] for t in self.schemas}
        text = self.spark.sparkContext.wholeTextFiles(f"{self.root}/_versions/{version}.json").first()[1]
        return version, json.loads(text)

    def publish(self, after: int, tables: dict) -> int:
        """Makes ``tables`` version ``after + 1``."""
        jvm, fs = self.spark._jvm, self._fs
        fs.mkdirs(self._path("_versions"))
        draft, final = self._path(f"_versions/.draft-{uuid.uuid4().hex}"), self._path(f"_versions/{after + 1}.json")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
        out.close()
        option = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(option, 1)
        options[0] = option.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(final), options)
        except Exception as e:
            fs.delete(draft, False)
            if fs.exists(final):
                raise VersionConflict(f"version {after + 1} of {self.root} is taken: load again") from e
            raise
        return after + 1

    # ------------------------------------------------------------- tables
    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self.frame(table, self.manifest(version)[1][table])

    def read_all(self, version: int | None = None) -> dict[str, DataFrame]:
        """Every table of one version (the list is read once)."""
        _, tables = self.manifest(version)
        return {t: self.frame(t, tables[t]) for t in self.schemas}

    def frame(self, table: str, folders) -> DataFrame:
        schema, by = self.schemas[table], self.partitions.get(table)
        if by:
            paths = [f"{self.root}/{table}/load={load}/{by}={value}" for value, load in folders.items()]
        else:
            paths = [f"{self.root}/{table}/load={load}" for load in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
        return (self.spark.read.schema(full).option("basePath", f"{self.root}/{table}").parquet(*paths)
                .select(*schema.fieldNames()))

    def write(self, table: str, df: DataFrame):
        """Writes ``df`` into a new folder that no version holds yet; returns
        what to put into the manifest: [load] or {partition value: load}."""
        schema, by, load = self.schemas[table], self.partitions.get(table), uuid.uuid4().hex
        shaped = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        writer = shaped.write.mode("errorifexists")
        (writer.partitionBy(by) if by else writer).parquet(f"{self.root}/{table}/load={load}")
        if not by:
            return [load]
        # one folder per partition value; names are as the writer escaped them
        return {n.split("=", 1)[1]: load for n in self._names(f"{table}/load={load}") if n.startswith(f"{by}=")}

    def compact(self, table: str) -> int:
        """Rewrites an unpartitioned table whose loads have piled up into one
        folder."""
        version, tables = self.manifest()
        return self.publish(version, tables | {table: self.write(table, self.frame(table, tables[table]))})

    def vacuum(self, keep: int = 1, older_than_hours: float = 24.0) -> list[str]:
        """Deletes folders that none of the last ``keep`` versions lists and
        that are old enough not to belong to a load still running, and the
        versions before those kept."""
        fs, have = self._fs, self.versions()
        kept = have[-keep:]
        live = {(t, load) for v in kept for t, f in self.manifest(v)[1].items() for load in (f.values() if isinstance(f, dict) else f)}
        limit, gone = (time.time() - 3600 * older_than_hours) * 1000, []
        for v in have[:-keep]:
            fs.delete(self._path(f"_versions/{v}.json"), False)
        for t in self.schemas:
            for name in self._names(t):
                p = self._path(f"{t}/{name}")
                if (t, name.split("=", 1)[-1]) not in live and fs.getFileStatus(p).getModificationTime() <= limit:
                    fs.delete(p, True)
                    gone.append(f"{t}/{name}")
        return gone
