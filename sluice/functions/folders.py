"""Files and folders on any file system that Spark can reach."""

from __future__ import annotations

import json
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folders:
    """Looks at, moves and removes files by their paths, in the JVM's file systems."""

    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._configuration = spark._jsc.hadoopConfiguration()
        self._jvm = spark._jvm

    def _at(self, path: str):
        where = self._path(path)
        return where.getFileSystem(self._configuration), where

    def exists(self, path: str) -> bool:
        files, where = self._at(path)
        return files.exists(where)

    def is_folder(self, path: str) -> bool:
        files, where = self._at(path)
        return files.exists(where) and files.getFileStatus(where).isDirectory()

    def names(self, path: str) -> list[str]:
        """What is right below a folder; nothing if there is none."""
        files, where = self._at(path)
        if not files.exists(where):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(where))

    def matching(self, folder: str, *patterns: str) -> list[str]:
        """Names right below a folder that fit one of the patterns. Only these reach the driver."""
        found = set()
        for pattern in patterns:
            files, where = self._at(folder)
            # The folder's own name may hold characters that mean something in a pattern.
            start = files.globStatus(self._path(self._path(escaped(where.toString())), pattern))
            found.update(status.getPath().getName() for status in start or [])
        return sorted(found)

    def data_files(self, folder: str, below: str = "") -> Iterator[str]:
        """Paths of all files below a folder, relative to it, but for hidden ones."""
        files, where = self._at(folder)
        root = files.makeQualified(where).toUri().getPath().rstrip("/")
        found = files.listFiles(where, True)
        while found.hasNext():
            name = found.next().getPath().toUri().getPath()[len(root) + 1 :]
            if not any(is_hidden(part) for part in name.split("/")):
                yield name

    def move(self, old: str, new: str) -> None:
        """Everything at ``old`` is at ``new`` afterwards. What another attempt has left there gives
        way, so this may be repeated until it succeeds."""
        files, source = self._at(old)
        if not files.exists(source):
            return
        _, target = self._at(new)
        if not files.exists(target):
            files.mkdirs(target.getParent())
            if not files.rename(source, target):
                raise OSError(f"'{old}' could not be moved to '{new}'")
        elif files.getFileStatus(source).isDirectory():
            for name in self.names(old):
                self.move(f"{old}/{name}", f"{new}/{name}")
            files.delete(source, True)
        else:
            files.delete(target, False)
            if not files.rename(source, target):
                raise OSError(f"'{old}' could not be moved to '{new}'")

    def delete(self, path: str) -> None:
        files, where = self._at(path)
        files.delete(where, True)

    def delete_empty(self, path: str) -> None:
        """Removes a folder if there is nothing in it."""
        files, where = self._at(path)
        try:
            files.delete(where, False)
        except Py4JJavaError:  # something is, or was until now
            pass

    def create(self, path: str, content: dict) -> bool:
        """A new file with this content; False if there is one, of two callers for all but one."""
        files, where = self._at(path)
        if files.exists(where):
            return False
        files.mkdirs(where.getParent())
        try:
            out = files.create(where, False)
        except Py4JJavaError as error:
            if files.exists(where):
                return False
            raise error
        try:
            out.write(json.dumps(content).encode())
        finally:
            out.close()
        return True

    def read(self, path: str) -> dict | None:
        """The content of a file that ``create`` made; None if there is none, or if it broke off."""
        files, where = self._at(path)
        if not files.exists(where):
            return None
        stream = files.open(where)
        try:
            text = bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None


def is_hidden(name: str) -> bool:
    """Whether Spark's readers pass by a file or folder of this name."""
    return name.startswith(".") or name.startswith("_") and "=" not in name


def escaped(name: str) -> str:
    """A name as a pattern that fits just it."""
    return "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in name)
