"""Results kept until the files they came from change.

A snapshot is named by a digest over path, length and change time of every file
below some paths; the file system's listing gives all three, no data is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from functools import wraps
from threading import RLock
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from keepwell.sources import tables


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """Digest of the files below ``paths`` (files or folders; a path that is not
    there counts as empty). Hidden files are skipped, as Spark skips them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    digest = hashlib.sha256()
    for path in sorted(paths):
        top = jvm.org.apache.hadoop.fs.Path(path)
        fs = top.getFileSystem(conf)
        entries = []
        if fs.exists(top):
            files = fs.listFiles(top, True)
            while files.hasNext():
                f = files.next()
                name = f.getPath().getName()
                if not name.startswith(("_", ".")):
                    entries.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        digest.update(repr((path, sorted(entries))).encode())
    return digest.hexdigest()


class SnapshotCache:
    """One result per name, replaced when its snapshot is another. A replaced
    result is handed to ``drop``, so cached tables leave memory."""

    def __init__(self, drop: Callable[[Any], None] = lambda old: None):
        self._held: dict[Any, tuple[str, Any]] = {}
        self._drop = drop
        self._lock = RLock()

    def get(self, name: Any, snapshot: str, make: Callable[[], Any]) -> Any:
        with self._lock:
            held = self._held.get(name)
            if held and held[0] == snapshot:
                return held[1]
            made = make()
            self._held[name] = (snapshot, made)
            if held:
                self._drop(held[1])
            return made

    def clear(self) -> None:
        with self._lock:
            for _, value in self._held.values():
                self._drop(value)
            self._held.clear()


def _unpersist(df: DataFrame) -> None:
    df.unpersist()


_artifacts = SnapshotCache(_unpersist)


def cached_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A stage table kept in executor storage until its files change. The rows are
    read when the table is first asked for, so what a caller holds stays what it
    was until it asks again."""
    path = tables.table_path(root, name)
    app = spark.sparkContext.applicationId

    def read() -> DataFrame:
        table = tables.read_table(spark, root, name, fmt).persist()
        table.count()
        return table

    return _artifacts.get((app, path, fmt), fingerprint(spark, [path]), read)


def per_snapshot(sources: Callable[[str], Iterable[str]]):
    """Decorator for functions (spark, folder) -> result: made once per session and
    state of the files ``sources(folder)`` names."""
    def decorate(make):
        cache = SnapshotCache()

        @wraps(make)
        def kept(spark: SparkSession, folder: str):
            name = (spark.sparkContext.applicationId, folder)
            return cache.get(name, fingerprint(spark, sources(folder)), lambda: make(spark, folder))

        return kept
    return decorate
