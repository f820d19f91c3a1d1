"""Small files and folders of any file system that Spark reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder by its path, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.path = path.rstrip("/")

    def _at(self, name: str = ""):
        return self._fs.Path(f"{self.path}/{name}" if name else self.path)

    def _system(self):
        return self._at().getFileSystem(self._conf)

    def names(self) -> list[str]:
        """What lies in the folder; nothing if it does not exist."""
        system, here = self._system(), self._at()
        if not system.exists(here):
            return []
        return sorted(one.getPath().getName() for one in system.listStatus(here))

    def read(self, name: str) -> str:
        stream = self._system().open(self._at(name))
        try:
            return self._gateway.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file whole or not at all; an existing one stays and is an error."""
        draft = self._at(f".{name}.{uuid.uuid4().hex}")
        stream = self._system().create(draft, False)
        stream.write(text.encode())
        stream.close()
        context = self._fs.FileContext.getFileContext(draft.toUri(), self._conf)
        rename = self._gateway.jvm.org.apache.hadoop.fs.Options.Rename
        try:
            context.rename(draft, self._at(name), self._gateway.new_array(rename, 0))
        except Exception as error:
            self._system().delete(draft, False)
            raise FileExistsError(f"{self.path}/{name}") from error

    def delete(self, name: str = "") -> None:
        self._system().delete(self._at(name), True)
