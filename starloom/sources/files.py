"""Small files on the file system that Spark writes to, through Hadoop's interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Names, texts, renames and deletes under any path that Spark can write."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        where, system = self._at(path)
        return system.exists(where)

    def names(self, path: str) -> list[str]:
        """Names of what lies directly under ``path``; none if it is absent."""
        where, system = self._at(path)
        return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []

    def read(self, path: str) -> str:
        where, system = self._at(path)
        stream = system.open(where)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A new file; an existing one is an error."""
        where, system = self._at(path)
        stream = system.create(where, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename_new(self, source: str, target: str) -> bool:
        """Rename in one step; False if ``target`` exists already."""
        fs = self._jvm.org.apache.hadoop.fs
        begin, end = fs.Path(source), fs.Path(target)
        context = fs.FileContext.getFileContext(begin.getFileSystem(self._conf).makeQualified(begin).toUri(), self._conf)
        none = self._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            context.rename(begin, end, none)
        except Exception as error:  # noqa: BLE001 - told apart by its Java class below
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        where, system = self._at(path)
        system.delete(where, True)
