"""The few things that jobs do to files themselves: list, move, delete, and note a short text."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The file system that holds a path, and the path; a URI, as Spark reports it, is one too."""
    jvm = spark._jvm
    uri = ":/" in path
    found = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if uri else path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def child(spark: SparkSession, folder: str, name: str) -> str:
    """The URI of a name inside a folder, which may be given as a path or a URI."""
    jvm = spark._jvm
    system, found = _at(spark, folder)
    return system.makeQualified(jvm.org.apache.hadoop.fs.Path(found, name)).toUri().toString()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, one level deep; none if there is no folder."""
    system, found = _at(spark, folder)
    if not system.exists(found):
        return []
    return [status.getPath().getName() for status in system.listStatus(found)]


def files_below(spark: SparkSession, folder: str) -> list[str]:
    """URIs of all files below a folder; none if there is no folder."""
    system, found = _at(spark, folder)
    if not system.exists(found):
        return []
    listed, files = system.listFiles(found, True), []
    while listed.hasNext():
        files.append(listed.next().getPath().toUri().toString())
    return files


def move(spark: SparkSession, source: str, folder: str) -> None:
    """Move a file into a folder, which is made if need be."""
    system, found = _at(spark, source)
    _, into = _at(spark, folder)
    system.mkdirs(into)
    target = spark._jvm.org.apache.hadoop.fs.Path(into, found.getName())
    if not system.rename(found, target):
        raise OSError(f"{source} could not be moved into {folder}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all in it; one that is gone already is no error."""
    system, found = _at(spark, path)
    system.delete(found, True)


def write_lines(spark: SparkSession, path: str, lines: list[str]) -> None:
    """Write a small text file; it appears whole, by a rename."""
    system, found = _at(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(found.getParent(), f".{found.getName()}.part")
    out = system.create(part, True)
    try:
        out.write(bytearray("".join(f"{line}\n" for line in lines).encode()))
    finally:
        out.close()
    if not system.rename(part, found):
        raise OSError(f"{path} could not be written")


def read_lines(spark: SparkSession, path: str) -> list[str] | None:
    """The lines of a small text file, or None if there is no such file."""
    system, found = _at(spark, path)
    if not system.exists(found):
        return None
    stream = system.open(found)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text.splitlines()
