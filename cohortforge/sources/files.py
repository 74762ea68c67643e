"""Small files and folders on the storage Spark uses, through Hadoop's file systems."""

from __future__ import annotations

import hashlib
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


SMALL = 1 << 20  # bytes of a list that is compared by its rows


class Files:
    """Files by path, on any file system Spark can reach."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        path = self._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self._conf), path

    def exists(self, path: str) -> bool:
        system, path = self._at(path)
        return system.exists(path)

    def delete(self, path: str) -> bool:
        system, path = self._at(path)
        return system.delete(path, True)

    def text(self, path: str) -> str:
        system, path = self._at(path)
        stream = system.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> bool:
        """Make a small file that is there as a whole or not at all; whether this call made it.

        It is written aside and renamed. Where another run was first, its file stays.
        """
        system, target = self._at(path)
        _, aside = self._at(f"{path}.{uuid.uuid4().hex}")
        stream = system.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        made = not system.exists(target) and system.rename(aside, target)
        if not made:
            system.delete(aside, False)
        return made

    def replace(self, path: str, text: str) -> None:
        """Make a small file anew: readers see the old one or the new one, or for a moment none."""
        self.delete(path)
        if not self.publish(path, text):
            raise FileExistsError(path)

    def listed(self, folder: str) -> list[tuple[str, int, int]]:
        """(path, bytes, time of change) of the files in a folder, by name."""
        system, path = self._at(folder)
        found = [s for s in system.listStatus(path) if s.isFile()]
        return sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found)

    def folders(self, folder: str) -> list[str]:
        system, path = self._at(folder)
        return sorted(s.getPath().toString() for s in system.listStatus(path) if s.isDirectory())

    def delete_empty(self, folder: str) -> bool:
        """Delete a folder that holds no file, in folders of its own either; whether it went."""
        system, path = self._at(folder)
        if not system.exists(path):
            return True
        held = [not self.delete_empty(f) for f in self.folders(folder)]
        if any(held) or any(not s[0].rpartition("/")[2].startswith(".") for s in self.listed(folder)):
            return False
        return system.delete(path, True)

    def print_of(self, df: DataFrame) -> str | None:
        """What a table's files are: a digest of their paths, sizes, times and the table's layout.

        Of a small table that is not read from files, a list in the plan, its rows; else None.
        """
        paths = set(df.inputFiles())
        digest = hashlib.sha256(df.schema.json().encode())
        if not paths:
            if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SMALL:
                return None
            digest.update(repr(sorted(str(tuple(r)) for r in df.collect())).encode())
        for folder in sorted({unquote(p.rpartition("/")[0]) for p in paths}):
            digest.update(repr(self.listed(folder)).encode())
        return digest.hexdigest()
