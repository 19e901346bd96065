"""Versioned table folders and single files on Spark's file system (L-03, L-05).

A table is a folder ``root/name`` of version folders and a small file
``_current`` that names the one to read. A write fills a new version folder; only
when its job has succeeded is the pointer replaced, by one rename. A job that
fails or is killed half-way leaves the pointer, and so the table, as it was.
``KEEP`` versions stay for readers that resolved the pointer before the swap.

All access goes through Hadoop's file system interface, so paths may be local,
HDFS or an object store.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

POINTER = "_current"
#: Versions kept: the current one and those a running reader may still hold.
KEEP = 2


class Store:
    """Hadoop file operations for one path's file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self.path(path).getFileSystem(self._conf)

    def path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self.path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self.path(path), True)

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(path)))

    def size(self, path: str) -> int:
        """Bytes of a file or folder (0 if there is none)."""
        return self._fs.getContentSummary(self.path(path)).getLength() if self.exists(path) else 0

    def read(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self._fs.open(self.path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self.path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self.path(source), self.path(target)):
            raise OSError(f"can't rename {source} to {target}")

    def replace(self, source: str, target: str) -> None:
        """Rename over an existing file, in one step where the store has one."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._jvm.java.lang.reflect.Array.newInstance(kind.OVERWRITE.getClass(), 1)
        self._jvm.java.lang.reflect.Array.set(options, 0, kind.OVERWRITE)
        context.rename(self.path(source), self.path(target), options)

    def join(self, parts: Iterable[str], target: str) -> None:
        """Append files to ``target`` in order: by the store's own
        concatenation where it has one, else in one streaming copy."""
        parts = list(parts)
        try:
            array = self._jvm.java.lang.reflect.Array.newInstance(self.path(target).getClass(), len(parts))
            for i, part in enumerate(parts):
                self._jvm.java.lang.reflect.Array.set(array, i, self.path(part))
            self._fs.concat(self.path(target), array)
            return
        except Exception as e:
            if "UnsupportedOperation" not in f"{type(e).__name__} {e}":
                raise
        whole = f"{target}.joining"
        out = self._fs.create(self.path(whole), True)
        try:
            for part in [target, *parts]:
                stream = self._fs.open(self.path(part))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
                finally:
                    stream.close()
        finally:
            out.close()
        self.delete(target)
        self.rename(whole, target)


def table_folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def current_path(spark: SparkSession, root: str, name: str) -> str:
    """The folder that holds the table's rows: the version its pointer names,
    or ``root/name`` itself for a folder written without versions."""
    folder = table_folder(root, name)
    version = Store(spark, folder).read(f"{folder}/{POINTER}")
    return f"{folder}/{version.strip()}" if version else folder


def publish(spark: SparkSession, root: str, name: str, write: Callable[[str], None]) -> str:
    """Run ``write(path)`` on a new version folder and make it the current one;
    returns its path. If ``write`` fails the table is left as it was."""
    folder = table_folder(root, name)
    store = Store(spark, folder)
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = f"{folder}/{version}"
    try:
        write(path)
    except BaseException:
        store.delete(path)
        raise
    plain = store.read(f"{folder}/{POINTER}") is None
    fresh = f"{folder}/{POINTER}.{uuid.uuid4().hex[:8]}"
    store.write(fresh, version)
    store.replace(fresh, f"{folder}/{POINTER}")
    versions = [v for v in store.names(folder) if v.startswith("v") and v <= version]
    for old in versions[:-KEEP]:
        store.delete(f"{folder}/{old}")
    if plain:  # files of a write without versions are no longer read
        for rest in store.names(folder):
            if not rest.startswith(("v", POINTER)):
                store.delete(f"{folder}/{rest}")
    return path
