"""Small files and folders in whatever store a path names, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """The file system of ``path`` under the session's settings."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        settings = spark._jsparkSession.sessionState().newHadoopConf()
        self._system = self._path(path).getFileSystem(settings)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """What lies directly in ``folder``; nothing if there is none."""
        if not self.exists(folder):
            return []
        return sorted(entry.getPath().getName() for entry in self._system.listStatus(self._path(folder)))

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A whole new file at once: readers see none or all of it. An existing one is an error."""
        if self.exists(path):
            raise FileExistsError(path)
        unfinished = f"{path}.unfinished"
        stream = self._system.create(self._path(unfinished), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._system.rename(self._path(unfinished), self._path(path)):
            raise FileExistsError(path)

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)
