"""A folder of any file system Spark writes to: listing, moving, and small text files."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """One folder and what lies below it; paths are relative to it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._jvm = spark._jvm
        root = self._path("")
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, relative: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{relative}".rstrip("/"))

    def at(self, relative: str) -> str:
        return f"{self.folder}/{relative}"

    def exists(self, relative: str) -> bool:
        return self._fs.exists(self._path(relative))

    def names(self, relative: str = "", prefix: str = "") -> list[str]:
        """The sorted names in a folder; none where there is no such folder."""
        if not self.exists(relative):
            return []
        return sorted(n for s in self._fs.listStatus(self._path(relative)) if (n := s.getPath().getName()).startswith(prefix))

    def move(self, source: str, target: str) -> None:
        """Rename; the target must not exist, its parents are made."""
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"can't move {self.at(source)} to {self.at(target)}")

    def drop(self, relative: str) -> None:
        self._fs.delete(self._path(relative), True)

    def write(self, relative: str, text: str) -> None:
        """Create a file; one that exists already is an error, so only one of two writers gets through."""
        out = self._fs.create(self._path(relative), False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def read(self, relative: str) -> str:
        stream = self._fs.open(self._path(relative))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
