"""Folders of a Hadoop file system: the few operations that commits need."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


class Folder:
    """File system calls for paths below one table."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """The names in a folder; none if it is not there."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path))) if self.exists(path) else []

    def move(self, source: str, target: str) -> None:
        """Rename; an error if the file system refuses."""
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        try:
            out.write(text.encode())
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a one-machine master without that setting (tests, a laptop) gets a folder of its own,
    removed when the process ends; a cluster without it is an error.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    path = tempfile.mkdtemp(prefix="lumenrec-shared-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def new_folder(spark: SparkSession, what: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
