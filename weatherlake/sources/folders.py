"""Folders on the file system that the driver and all executors share: names, whole renames and small marker files."""

from __future__ import annotations

from pyspark.sql import SparkSession

SUCCESS = "_SUCCESS"


class Folder:
    """A folder by its path or URI. Nothing here reads data files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._system = self._at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, pattern: str = "*") -> list[str]:
        """The names in the folder that match, in order; none if the folder does not exist."""
        return sorted(status.getPath().getName() for status in self._system.globStatus(self._at(pattern)) or [])

    def has(self, name: str) -> bool:
        return self._system.exists(self._at(name))

    def numbered(self, label: str) -> dict[int, str]:
        """The complete outputs named <label>=<number>, by number."""
        found = [name for name in self.names(f"{label}=*") if self.has(f"{name}/{SUCCESS}")]
        return {int(name.split("=")[1]): f"{self.path}/{name}" for name in found}

    def data_files(self) -> list[str]:
        """The files below the folder, by their path in it, without hidden files and folders."""
        if not self._system.exists(self._at()):
            return []
        root = self._system.resolvePath(self._at()).toUri().getPath().rstrip("/") + "/"
        found, walk = [], self._system.listFiles(self._at(), True)
        while walk.hasNext():
            name = walk.next().getPath().toUri().getPath().removeprefix(root)
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                found.append(name)
        return sorted(found)

    def delete(self, name: str) -> bool:
        """Whether there was something to delete."""
        return self._system.delete(self._at(name), True)

    def move(self, name: str, to: str) -> None:
        """Moves a file or folder to a name in this folder; the folders on the way are made."""
        self._system.mkdirs(self._at(to).getParent())
        if not self._system.rename(self._at(name), self._at(to)):
            raise OSError(f"{name} could not be moved to {to} in {self.path}")

    def write(self, name: str, text: str) -> None:
        """Writes a small file that is there as a whole or not at all."""
        part = f"_{name.rsplit('/', 1)[-1]}.part"
        stream = self._system.create(self._at(part), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.move(part, name)

    def read(self, name: str) -> str:
        stream = self._system.open(self._at(name))
        text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text
