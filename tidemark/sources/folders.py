"""Folders and small files on whatever file system Spark writes to."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folders:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def changed_at(self, path: str) -> int:
        """When a file or folder was last changed, in milliseconds."""
        return self._fs(path).getFileStatus(self._path(path)).getModificationTime()

    def make(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none when it does not exist."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs(path).listStatus(self._path(path)))

    def move(self, source: str, target: str) -> None:
        """Rename; an existing target is an error."""
        fs = self._fs(target)
        fs.mkdirs(self._path(target).getParent())
        if fs.exists(self._path(target)) or not fs.rename(self._path(source), self._path(target)):
            raise FileExistsError(target)

    def remove(self, path: str) -> None:
        """Remove a file or folder with all it holds, if it is there."""
        self._fs(path).delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Create a file; of two writers of one path the file system lets one pass, the other fails."""
        try:
            stream = self._fs(path).create(self._path(path), False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName() or self.exists(path):
                raise FileExistsError(path) from error
            raise
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
