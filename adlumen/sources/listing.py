"""File inventories made by the executors: folder by folder, level by level.

Spark's own listing brings every file's status to the driver. Here a round takes the folders
of one level, dealt over tasks, and writes what is in them; the next round takes the folders
found. There are as many rounds as the tree has levels, and only counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from adlumen.session import shared_dir
from adlumen.sources.inventory import shaped

#: Objects handed on at a time, and folders that one task lists.
PAGE, FOLDERS_A_TASK = 10_000, 200
_FOUND = "path string, folder boolean, size long, modified timestamp"
_ARROW = pa.schema([("path", pa.string()), ("folder", pa.bool_()), ("size", pa.int64()), ("modified", pa.timestamp("us", "UTC"))])


def _opened(path: str):
    """File system of a path, the path in it, and what stands before it in full names."""
    from pyarrow import fs

    scheme = urlsplit(path).scheme
    if not scheme or scheme == "file":
        inside = "/" + path.removeprefix("file:").lstrip("/")
        return fs.LocalFileSystem(), inside, "file:"
    system, inside = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system, inside, path[:len(path) - len(inside.rstrip("/"))] if path.rstrip("/").endswith(inside.rstrip("/")) else f"{scheme}://"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, inside, before = _opened(path)
            found = system.get_file_info(fs.FileSelector(inside, allow_not_found=True))
            for at in range(0, len(found), PAGE):
                # hidden as Spark hides them: working folders and markers
                page = [x for x in found[at:at + PAGE] if not (x.base_name.startswith(".") or x.base_name.startswith("_") and "=" not in x.base_name)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([before + x.path for x in page], pa.string()), pa.array([x.type == fs.FileType.Directory for x in page], pa.bool_()),
                    pa.array([x.size or 0 for x in page], pa.int64()),
                    # to the millisecond, as Spark's listing tells it
                    pa.array([x.mtime_ns // 1_000_000 * 1_000 if x.mtime_ns else None for x in page], pa.int64()).cast(pa.timestamp("us", "UTC"))],
                    schema=_ARROW)


def list_files_in_tasks(spark: SparkSession, roots: str | list[str], suffix: str = ".parquet") -> DataFrame:
    """Files below the given folders, as :func:`adlumen.sources.inventory.list_files` gives them.

    A folder is listed by one task; folders are dealt over tasks anew at every level, so a
    deep or uneven tree keeps all of them busy. Folders that do not exist hold nothing.
    The executors open the store through Arrow: local paths, s3, gs, hdfs and abfs.
    """
    roots = [roots] if isinstance(roots, str) else roots
    folders = spark.createDataFrame([(r,) for r in roots], "path string")
    rounds, open_ = [], len(roots)
    while open_:
        target = shared_dir(spark, "listing")
        dealt = folders.repartition(max(1, -(-open_ // FOLDERS_A_TASK)), "path") if open_ > 1 else folders
        dealt.mapInArrow(_listed, _FOUND).write.parquet(target)
        found = spark.read.schema(_FOUND).parquet(target)
        rounds.append(found.where(~F.col("folder")))
        folders = found.where("folder").select("path")
        open_ = folders.count()
    files = reduce(DataFrame.unionByName, rounds) if rounds else spark.createDataFrame([], _FOUND)
    return shaped(files.where(F.col("path").endswith(suffix)).select("path", "size", "modified"))
