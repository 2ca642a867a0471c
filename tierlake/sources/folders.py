"""Folder listings through the Hadoop file system Spark itself uses."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct subfolders, sorted; empty when the folder is absent."""
    system, target = _open(spark, path)
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory())


def empty_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """URIs of the zero-length files that paths, globs or folders name; Spark's readers skip those."""
    found = []
    for path in paths:
        system, target = _open(spark, path)
        for status in system.globStatus(target) or []:
            listed = system.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [
                s.getPath().toUri().toString() for s in listed
                if s.isFile() and s.getLen() == 0 and not s.getPath().getName().startswith(("_", "."))
            ]
    return found


def source_folders(spark: SparkSession, base: str, source: str, start: date | None, end: date | None) -> list[str]:
    """Day folders of one source within the inclusive range, found by walking its folders only.

    Without this a read lists every partition of the table before it prunes.
    """
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    level = [(f"{base}/source={escape(source)}", ())]
    for name in ("year", "month", "day"):
        deeper = []
        for folder, parts in level:
            for child in subfolders(spark, folder):
                if not child.startswith(f"{name}="):
                    continue
                grown = (*parts, int(child.split("=")[1]))
                low = (start.year, start.month, start.day)[:len(grown)] if start else grown
                high = (end.year, end.month, end.day)[:len(grown)] if end else grown
                if low <= grown <= high:
                    deeper.append((f"{folder}/{child}", grown))
        level = deeper
    return [folder for folder, _ in level]
