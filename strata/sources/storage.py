"""Small files on any Hadoop file system: markers that are written once and never replaced."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as the JVM sees it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; a folder that is not there has none."""
    fs, p = file_system(spark, folder)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def add_marker(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write ``folder/name`` once, complete from the moment that its name is visible.

    The text goes to a hidden name first, so a crash leaves a hidden file that no
    reader looks at. Of several writers of one name exactly one succeeds, the
    others get FileExistsError: a local file is linked to its name, elsewhere the
    rename that refuses to overwrite decides.
    """
    jvm, fs, hidden = spark.sparkContext._jvm, *file_system(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    _, final = file_system(spark, f"{folder}/{name}")
    hidden, final = fs.makeQualified(hidden), fs.makeQualified(final)
    try:
        if fs.getUri().getScheme() == "file":
            path = jvm.java.nio.file.Paths.get
            jvm.java.nio.file.Files.createLink(path(final.toUri()), path(hidden.toUri()))
        else:
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(hidden, final, options)
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" in str(exc.java_exception):
            raise FileExistsError(f"{folder}/{name} is there already") from exc
        raise
    finally:
        if fs.exists(hidden):
            fs.delete(hidden, False)


def read_marker(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)
