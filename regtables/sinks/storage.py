"""Small files on the storage that driver and executors share."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    is_folder: bool
    modified: float  # seconds since 1970


class Storage:
    """A folder by Hadoop's file systems, so any that Spark reads. Paths are relative to it."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{path}" if path else self.folder)

    def entries(self, path: str = "") -> list[Entry]:
        """What a folder holds; nothing if there is no such folder."""
        if not self._fs.exists(self._path(path)):
            return []
        found = self._fs.listStatus(self._path(path))
        return [Entry(s.getPath().getName(), s.isDirectory(), s.getModificationTime() / 1000) for s in found]

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def read(self, path: str) -> bytes:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, path: str, data: bytes) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(data)
        finally:
            stream.close()

    def put_if_absent(self, path: str, data: bytes) -> bool:
        """Writes a whole file, or nothing if there is one of that name; of several writers one succeeds.

        The data goes to a file of its own first. A local file system then links it, which fails if the name is
        taken; others rename without overwriting, which must be one step there, as in HDFS."""
        folder, _, name = path.rpartition("/")
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        self.write(draft, data)
        if self._fs.getScheme() == "file":
            local = lambda p: self._path(p).toUri().getPath()
            try:
                os.link(local(draft), local(path))
                return True
            except FileExistsError:
                return False
            finally:
                self.delete(draft)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        no_options = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(self._path(draft), self._path(path), no_options)
            return True
        except Exception:
            if not self.exists(path):
                raise
            self.delete(draft)
            return False

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
