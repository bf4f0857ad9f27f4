"""Small file operations on whatever store a path lies on."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """The file system of one folder; names are relative to it."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._root = self._path(folder)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(self._root, name)

    def names(self, pattern: str) -> list[str]:
        """Paths below the folder that match a glob, in order; none where the folder is missing."""
        found = self._files.globStatus(self._path(self._root, pattern)) or []
        base = self._files.makeQualified(self._root).toUri().getPath().rstrip("/") + "/"
        return sorted(f.getPath().toUri().getPath().removeprefix(base) for f in found)

    def exists(self, name: str) -> bool:
        return self._files.exists(self._at(name))

    def move(self, name: str, to: str) -> None:
        """Rename; the new name must be free. Its folder is made if it is missing."""
        self._files.mkdirs(self._at(to).getParent())
        if self.exists(to) or not self._files.rename(self._at(name), self._at(to)):
            raise OSError(f"cannot rename {name} to {to}")

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)

    def create(self, name: str) -> bool:
        """Create an empty file; of all callers that want a name exactly one gets True."""
        at = self._at(name)
        if self._files.getUri().getScheme() == "file":  # Hadoop's check and creation are two steps here
            local = at.toUri().getPath()
            os.makedirs(os.path.dirname(local), exist_ok=True)
            try:
                os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            except FileExistsError:
                return False
            return True
        try:
            self._files.create(at, False).close()
        except Py4JJavaError:
            if self.exists(name):
                return False
            raise
        return True

    def claim_number(self, folder: str, above: int = 0) -> int:
        """The next number of a folder, given to one caller only; numbers may be left out."""
        taken = [int(n.rsplit("/", 1)[1]) for n in self.names(f"{folder}/*")]
        number = max([above, *taken]) + 1
        while not self.create(f"{folder}/{number}"):
            number += 1
        return number
