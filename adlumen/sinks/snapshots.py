"""Partitioned Parquet tables with versions: a commit is seen whole or not at all.

A version is a manifest, a Parquet table of the files that are live in it. Data files are
written first, below a folder of their own for each attempt, and mean nothing until a
manifest lists them. The commit itself is one rename that fails where the next version
already exists. So a broken-off attempt changes nothing, a commit under an operation name
that is already in the history changes nothing either, and a reader keeps the version it
started with. Files are never changed in place; those no kept version lists can be deleted.

Manifests are tables and are worked on as such. Only the paths that a scan reads come to
the driver, which is what Spark's own file index holds for any scan.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from adlumen.operators.windows import first_per_key
from adlumen.sinks.tables import exists

_NULL = "__HIVE_DEFAULT_PARTITION__"
_FILES = "path string, url string, base string, size long, modified timestamp"


class Conflict(RuntimeError):
    """Another commit came first; what was computed may rest on files that are gone."""


@dataclass(frozen=True)
class Table:
    """A table at ``root``; files already below it belong to it once :meth:`adopt` ran.

    ``schema`` has all columns, ``levels`` names those that are Hive partition folders.
    """

    spark: SparkSession
    root: str
    schema: StructType
    levels: tuple[str, ...] = ()

    @property
    def _home(self) -> str:
        return f"{self.root.rstrip('/')}_snapshots"

    @property
    def _data(self) -> str:
        return f"{self._home}/data"

    # ---- versions ----------------------------------------------------------------

    def version(self) -> int | None:
        """The latest version: one listing of a small folder."""
        found = [int(name.removesuffix(".json")) for name in self._names(f"{self._home}/versions")]
        return max(found, default=None)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        return [s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().endswith(".json")]

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def history(self) -> DataFrame:
        """version, operation, manifest, added and removed files of every kept version."""
        kind = "version long, operation string, manifest string, added long, removed long"
        if not self._names(f"{self._home}/versions"):
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).json(f"{self._home}/versions")

    def version_of(self, operation: str) -> int | None:
        """The version that the named operation made, if it was ever committed."""
        row = self.history().where(F.col("operation") == operation).agg(F.max("version").alias("v")).head()
        return row.v

    def files(self, version: int | None = None) -> DataFrame:
        """Live files of a version (default: the latest) with partition levels as columns.

        ``path`` opens the file, ``url`` is the form that ``_metadata.file_path`` has,
        ``prefix`` spells the partition.
        """
        version = self.version() if version is None else version
        if version is None:
            return self._with_levels(self.spark.createDataFrame([], _FILES))
        entry = self.history().where(F.col("version") == version).head()
        if entry is None:
            raise ValueError(f"no version {version} of {self.root}")
        return self._with_levels(self.spark.read.schema(_FILES).parquet(entry.manifest))

    def _with_levels(self, files: DataFrame) -> DataFrame:
        def value(level: str) -> Column:
            text = F.regexp_extract("path", f"/{level}=([^/]*)/", 1)
            plain = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
            return F.when(text != _NULL, plain).cast(self.schema[level].dataType)

        # one spelling for a partition, however its folder is written (month=1, month=01)
        parts = [F.concat(F.lit(f"{x}="), F.coalesce(F.col(x).cast("string"), F.lit(_NULL)), F.lit("/")) for x in self.levels]
        return files.withColumns({x: value(x) for x in self.levels}).withColumn("prefix", F.concat(F.lit("/"), *parts))

    # ---- reading -----------------------------------------------------------------

    def scan(self, files: DataFrame, url: str | None = None) -> DataFrame:
        """Rows of the given files, with the file's url as a column if a name is given."""
        listed = files.select("base", "path").collect()
        columns = [F.col(f"`{c}`") for c in self.schema.fieldNames()]
        out = None
        for base in sorted({r.base for r in listed}):
            rows = self.spark.read.schema(self.schema).option("basePath", base).parquet(*[r.path for r in listed if r.base == base])
            rows = rows.select(*columns, *([F.col("_metadata.file_path").alias(url)] if url else []))
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            out = self.spark.createDataFrame([], self.schema)
            out = out.withColumn(url, F.lit(None).cast("string")) if url else out
        return out

    def read(self, version: int | None = None, where: Column | None = None) -> DataFrame:
        """Rows of a version (default: the latest); ``where`` is on partition levels and leaves files out."""
        files = self.files(version)
        return self.scan(files if where is None else files.where(where))

    # ---- writing -----------------------------------------------------------------

    def folder(self) -> str:
        """A fresh folder for the files of one attempt."""
        return f"{self._data}/attempt={uuid.uuid4().hex}"

    def write(self, rows: DataFrame, folder: str | None = None) -> DataFrame:
        """Write rows below a fresh folder; returns its files, which no reader sees yet."""
        folder = folder or self.folder()
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        writer = rows.hint("rebalance", *self.levels).write.option("compression", "snappy")
        (writer.partitionBy(*self.levels) if self.levels else writer).parquet(folder)
        return self.written(folder)

    def written(self, folder: str) -> DataFrame:
        """The data files below a folder of an attempt."""
        return self._listed(folder, self._data)

    def _listed(self, folder: str, base: str) -> DataFrame:
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
        return self._with_levels(files.select(
            "path", F.col("_metadata.file_path").alias("url"), F.lit(base).alias("base"),
            F.col("length").alias("size"), F.col("modificationTime").alias("modified")))

    def commit(self, operation: str, added: DataFrame | None = None, removed: DataFrame | None = None,
               since: int | None = None) -> int:
        """Make the next version: the live files of ``since`` without ``removed``, with ``added``.

        ``since`` is the version that the change was computed from (None: the table had
        none). If the operation is in the history its version is returned and nothing
        happens; if another operation came first, :class:`Conflict` is raised.
        """
        done = self.version_of(operation)
        if done is not None:
            return done
        if self.version() != since:
            raise Conflict(f"{self.root} is at {self.version()}, {operation} at {since}")
        columns = ["path", "url", "base", "size", "modified"]
        live = self.files(since).select(*columns)
        if removed is not None:
            live = live.join(removed.select("path").distinct(), "path", "left_anti").select(*columns)
        if added is not None:
            live = live.unionByName(added.select(*columns))
        manifest = f"{self._home}/manifests/{uuid.uuid4().hex}"
        live.write.parquet(manifest)
        version = 1 if since is None else since + 1
        self._publish(version, {
            "version": version, "operation": operation, "manifest": manifest,
            "added": 0 if added is None else added.count(), "removed": 0 if removed is None else removed.select("path").distinct().count()})
        return version

    def _publish(self, version: int, entry: dict) -> None:
        """The one step that makes a version: a rename that does not replace."""
        fs = self._path(self._home).getFileSystem(self.spark._jsc.hadoopConfiguration())
        prepared = self._path(f"{self._home}/prepared/{uuid.uuid4().hex}")
        out = fs.create(prepared, True)
        try:
            out.write(bytearray((json.dumps(entry) + "\n").encode()))
        finally:
            out.close()
        target = self._path(f"{self._home}/versions/{version:012d}.json")
        fs.mkdirs(target.getParent())
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        keep = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(prepared), fs.makeQualified(target), keep)
        except Exception as problem:
            if fs.exists(target):
                raise Conflict(f"version {version} of {self.root} exists") from problem
            raise

    # ---- operations --------------------------------------------------------------

    def adopt(self) -> int:
        """Version of the files that lie below ``root`` already; once."""
        if not exists(self.spark, self.root):
            return self.commit("adopt", since=self.version())
        return self.commit("adopt", self._listed(self.root, self.root), since=self.version())

    def append(self, rows: DataFrame, operation: str) -> int:
        if (done := self.version_of(operation)) is not None:
            return done
        return self.commit(operation, self.write(rows), since=self.version())

    def replace(self, rows: DataFrame, scope: Column, operation: str) -> int:
        """Everything in ``scope``, a condition on partition levels, becomes ``rows``.

        Partitions of the scope that the rows do not have any more are gone as well. Rows
        outside the scope are refused.
        """
        if (done := self.version_of(operation)) is not None:
            return done
        since = self.version()
        added = self.write(rows)
        if not added.where(~F.coalesce(scope, F.lit(False))).isEmpty():
            raise ValueError(f"{operation}: rows outside the scope")
        return self.commit(operation, added, self.files(since).where(scope), since)

    def merge(self, updates: DataFrame, keys: list[str], order: str, operation: str, scope: Column | None = None) -> int:
        """One row per key, the one of the highest ``order``; an update wins a tie.

        Only files that hold a key of the updates are written anew (copy on write). They
        are found by reading the key columns alone; all their other rows are carried over.
        Keys may be null. With ``scope``, a condition on partition levels, the updates are
        all there is in it: older rows of the scope that have no update vanish.
        """
        if (done := self.version_of(operation)) is not None:
            return done
        since, url = self.version(), "_url"
        live = self.files(since)
        touched = live.join(self._touched(live, updates, keys).distinct(), "url", "left_semi")
        if scope is not None:
            touched = touched.unionByName(live.where(scope)).distinct()
        current = self.scan(touched).withColumn("_new", F.lit(0))
        both = current.unionByName(updates.select(*self.schema.fieldNames()).withColumn("_new", F.lit(1)))
        if scope is not None:
            # older rows of the scope without an update, unless they are newer than all updates
            newest = updates.agg(F.max(order)).scalar()
            updated = F.max("_new").over(Window.partitionBy(*keys)) == 1
            both = both.withColumn("_keep", updated | ~F.coalesce(scope, F.lit(False)) | ~(
                newest.isNull() | F.col(order).isNull() | (F.col(order) <= newest))).where("_keep").drop("_keep")
        best = first_per_key(both, keys, [F.col(order).desc_nulls_last(), F.col("_new").desc()])
        return self.commit(operation, self.write(best.drop("_new")), touched, since)

    def _touched(self, live: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
        """Urls of live files with a key of the updates; partitions without any are not opened."""
        wanted = updates.select(*keys).distinct()
        levels = [k for k in keys if k in self.levels]
        if levels:
            partitions = wanted.select(*[F.col(k).cast(self.schema[k].dataType).alias(f"_{k}") for k in levels]).distinct()
            live = live.join(partitions, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in levels], "left_semi")
        held = self.scan(live, "url").select("url", *keys)
        other = wanted.toDF(*[f"_{k}" for k in keys])
        return held.join(other, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_semi").select("url")

    def expire(self, keep: int) -> DataFrame:
        """Forget all but the last ``keep`` versions; returns the files that none of them lists.

        The caller may delete those (path, size). What can be deleted is written down before
        a version is forgotten, so a call that breaks off loses nothing: the next one gives
        the same files again. Operation names of forgotten versions are no longer known.
        """
        if keep < 1:
            raise ValueError("the latest version stays")
        known = self.history().select("version", "manifest").orderBy(F.desc("version")).collect()
        old, alive = known[keep:], self._manifests([r.manifest for r in known[:keep]])
        retired = f"{self._home}/retired"
        if old:
            self._manifests([r.manifest for r in old]).join(alive, "path", "left_anti").write.mode("append").parquet(retired)
            fs = self._path(self._home).getFileSystem(self.spark._jsc.hadoopConfiguration())
            for row in old:
                fs.delete(self._path(f"{self._home}/versions/{row.version:012d}.json"), False)
        if not exists(self.spark, retired):
            return self.spark.createDataFrame([], "path string, size long")
        return self.spark.read.schema("path string, size long").parquet(retired).distinct().join(alive, "path", "left_anti")

    def _manifests(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], "path string, size long")
        return self.spark.read.schema(_FILES).parquet(*names).select("path", "size").distinct()

    def orphans(self) -> DataFrame:
        """Files of attempts that no kept version lists: broken off, or still under way."""
        if not exists(self.spark, self._data):
            return self.spark.createDataFrame([], "path string, size long")
        live = self._manifests([r.manifest for r in self.history().select("manifest").collect()])
        return self._listed(self._data, self._data).select("path", "size").join(live, "path", "left_anti")
