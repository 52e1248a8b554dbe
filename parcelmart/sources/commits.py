"""Files that are created once: of two writers of one name, the second is told."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with all of its content and return True, or return False if it exists.

    The content is written beside it first, so a reader never sees half of it, and then given its name in one step that
    fails if the name is taken: a rename on HDFS and file systems like it, a hard link on a local disk, where a rename
    would replace. A store whose rename replaces gives no such guarantee.
    """
    hadoop, nio = spark._jvm.org.apache.hadoop.fs, spark._jvm.java.nio.file
    target = hadoop.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = hadoop.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getUri().getScheme() != "file":
            return not files.exists(target) and bool(files.rename(draft, target))
        name, content = (nio.Paths.get(files.makeQualified(p).toUri()) for p in (target, draft))
        nio.Files.createLink(name, content)
        return True
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        files.delete(draft, False)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds; False if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]
