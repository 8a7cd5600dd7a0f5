"""Rebuilding only what is stale (S8 + K4).

A table of days is built from a folder of files. Beside it lies a manifest: each
source file's size and modification time, and the days it held. An anti join of the
files as they are with the manifest finds those that are new or changed, a second
one those that are gone; the days they hold or held are built again from the files
that hold rows of them, and written over the old ones as partitions. Nothing else is
read or written.

The manifest is written last, as a version of its own: a run that fails before has
done work that the next one repeats, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.session import delete_path, is_written, written

MANIFEST = "file string, path string, size long, modified timestamp, day date"
_STATE = ["file", "size", "modified"]


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, path, size, modified)`` of the files below a folder; their content is
    not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), "path",
                        F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def _newest(spark: SparkSession, manifest: str) -> int:
    """The newest complete version of the manifest (0: none)."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(manifest)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return 0
    found = [int(x.getPath().getName().split("=")[1]) for x in fs.listStatus(fs_path)]
    return max((v for v in found if is_written(spark, f"{manifest}/version={v}")), default=0)


def rebuild(spark: SparkSession, source: str, out: str,
            read: Callable[[SparkSession, Sequence[str]], DataFrame],
            build: Callable[[DataFrame], DataFrame], day: str = "day") -> list:
    """Bring the table at ``out`` up to date with the files below ``source``; the days
    that were built again.

    ``read`` gives the rows of some files, with their ``day``; ``build`` turns rows of
    whole days into the table's rows, which keep ``day`` (it must not mix days). The
    table is a folder for each day; a day that no file holds any more loses its
    folder. Rows without a day are left out. File names and days pass through the
    driver, rows do not.
    """
    manifest = f"{out}-manifest"
    version = _newest(spark, manifest)
    old = (spark.read.schema(MANIFEST).parquet(f"{manifest}/version={version}") if version
           else spark.createDataFrame([], MANIFEST))
    now = written(source_files(spark, source), "source-files")
    fresh = now.join(old.select(*_STATE), _STATE, "left_anti")
    stale = old.join(now.select(*_STATE), _STATE, "left_anti")
    paths = [r[0] for r in fresh.select("path").collect()]
    if not paths and not stale.limit(1).count():
        return []
    held = stale.select("day").where("day IS NOT NULL")
    if paths:
        days = (read(spark, paths).select(F.col("_metadata.file_path").alias("file"), F.col(day).alias("day"))
                .distinct())
        added = fresh.join(days, "file", "left").select("file", "path", "size", "modified", "day")
    else:
        added = old.limit(0)
    kept = old.join(now.select(*_STATE), _STATE, "left_semi").select("file", "path", "size", "modified", "day")
    manifest_now = written(kept.unionByName(added), "manifest")
    held = held.unionByName(manifest_now.join(fresh.select("file"), "file", "left_semi")
                            .select("day").where("day IS NOT NULL"))
    affected = sorted(r[0] for r in held.distinct().collect())
    needed = [r[0] for r in manifest_now.where(F.col("day").isin(affected)).select("path").distinct().collect()] \
        if affected else []
    filled = set()
    if needed:
        rows = read(spark, needed).where(F.col(day).isin(affected))
        (build(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(day).parquet(out))
        filled = {r[0] for r in manifest_now.where(F.col("day").isin(affected)).select("day").distinct().collect()}
    for d in affected:
        if d not in filled:
            delete_path(spark, f"{out}/{day}={d}")
    manifest_now.write.mode("overwrite").parquet(f"{manifest}/version={version + 1}")
    delete_path(spark, f"{manifest}/version={version - 1}")
    return affected
