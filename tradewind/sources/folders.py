"""Names below a folder of whatever file system Spark writes to."""

import uuid

from pyspark.sql import SparkSession


class Folder:
    """Lists, deletes and replaces names below ``path``, through the file system of the session's own settings."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._settings = spark._jsc.hadoopConfiguration()

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _files(self):
        return self._at().getFileSystem(self._settings)

    def names(self) -> list[str]:
        """Sorted; none where the folder is not there."""
        if not self._files().exists(self._at()):
            return []
        return sorted(status.getPath().getName() for status in self._files().listStatus(self._at()))

    def delete(self, name: str) -> None:
        self._files().delete(self._at(name), True)

    def read(self, name: str) -> str | None:
        if not self._files().exists(self._at(name)):
            return None
        stream = self._files().open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Readers see the old text or the new one, never a part: the file is written aside and renamed."""
        aside = f".{name}-{uuid.uuid4().hex}"
        stream = self._files().create(self._at(aside), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        over = self._gateway.new_array(kind, 1)
        over[0] = kind.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files().getUri(), self._settings)
        context.rename(self._at(aside), self._at(name), over)
