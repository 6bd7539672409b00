"""Small file operations on the cluster file system (any Hadoop-supported URI).

Used only for metadata: log entries of keyed tables, folders and the progress
log location.  Data is always read and written by Spark.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class FileSystem:
    def __init__(self, spark: SparkSession, root: str):
        jvm = spark._jvm
        self._jvm, self._gateway = jvm, spark.sparkContext._gateway
        self._path_cls = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path_cls(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _p(self, path: str):
        return self._path_cls(path)

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._p(path)))

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._p(path))

    def list_names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._p(path))]

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._p(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def is_file(self, path: str) -> bool:
        return self.exists(path) and bool(self._fs.getFileStatus(self._p(path)).isFile())

    def create_new(self, path: str, text: str) -> bool:
        """Create ``path`` with ``text`` in one step; False if it exists.

        The text is written under another name first.  On a local disk a hard
        link then claims the name; elsewhere a rename that never overwrites
        does, which the file system must carry out atomically (HDFS does; an
        object store needs a committer that does).
        """
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        out = self._fs.create(self._p(tmp), False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                local = [self._p(x).toUri().getPath() for x in (tmp, path)]
                os.link(*local)
                return True
            rename = self._jvm.org.apache.hadoop.fs.Options.Rename
            options = self._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
            context.rename(context.makeQualified(self._p(tmp)), context.makeQualified(self._p(path)), options)
            return True
        except FileExistsError:
            return False
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                return False
            raise
        finally:
            self._fs.delete(self._p(tmp), False)

    def delete(self, path: str, recursive: bool = True) -> bool:
        return bool(self._fs.delete(self._p(path), recursive))
