"""Small files on the store that the cluster shares: listing, whole reads, creation that fails if the name is taken.

Names without a scheme or with ``file:`` are handled by the operating system, others by the session's Hadoop file system.
Only metadata goes through here (commit entries, folder names); table data is read and written by Spark.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _local(self, path: str) -> str | None:
        if path.startswith("file:"):
            return "/" + path.removeprefix("file:").lstrip("/")
        if "://" in path or not str(self.spark.conf.get("spark.hadoop.fs.defaultFS", "file:")).startswith("file:"):
            return None
        return path

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return jvm, p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        local = self._local(path)
        if local is not None:
            return os.path.exists(local)
        _, p, fs = self._fs(path)
        return bool(fs.exists(p))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        local = self._local(folder)
        if local is not None:
            return sorted(os.listdir(local)) if os.path.isdir(local) else []
        _, p, fs = self._fs(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def age(self, path: str, now: float) -> float:
        """Seconds since the last change of a file or folder."""
        local = self._local(path)
        if local is not None:
            return now - os.path.getmtime(local)
        _, p, fs = self._fs(path)
        return now - fs.getFileStatus(p).getModificationTime() / 1000

    def read(self, path: str) -> str:
        local = self._local(path)
        if local is not None:
            with open(local, encoding="utf-8") as f:
                return f.read()
        jvm, p, fs = self._fs(path)
        stream = fs.open(p)
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Publish a file whole; False, and nothing changed, if the name is taken."""
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"  # hidden from readers
        local = self._local(path)
        if local is not None:
            folder, draft = self._local(folder), self._local(draft)
            os.makedirs(folder, exist_ok=True)
            with open(draft, "w", encoding="utf-8") as f:
                f.write(text)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(draft, local)  # atomic, and fails if the name exists
                return True
            except FileExistsError:
                return False
            finally:
                os.remove(draft)
        jvm, p, fs = self._fs(path)
        d = jvm.org.apache.hadoop.fs.Path(draft)
        stream = fs.create(d, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(d, p, options)  # without OVERWRITE: fails if the name exists
            return True
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            return False
        finally:
            fs.delete(d, False)

    def remove(self, path: str) -> None:
        """Delete a file or a folder with all in it."""
        jvm, p, fs = self._fs(path)
        fs.delete(p, True)
