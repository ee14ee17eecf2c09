"""What a job needs to know about the files of a store, on any file system that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The file system that holds a path, and the path for it."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """What matches a pattern, in the order of the names."""
    fs, there = _at(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(there) or [])


def names(spark: SparkSession, pattern: str) -> list[str]:
    return [path.rsplit("/", 1)[1] for path in folders(spark, pattern)]


def size_of(spark: SparkSession, pattern: str) -> tuple[int, int]:
    """(files, bytes) below all folders that match: asked of the file system, nothing is read."""
    n_files = n_bytes = 0
    fs, _ = _at(spark, pattern)
    for path in folders(spark, pattern):
        said = fs.getContentSummary(_at(spark, path)[1])
        n_files, n_bytes = n_files + said.getFileCount(), n_bytes + said.getLength()
    return n_files, n_bytes


def state_of(spark: SparkSession, path: str) -> tuple:
    """(bytes, newest change) of a file or of the files of a folder: another state if they were written anew."""
    fs, there = _at(spark, path)
    if not fs.exists(there):
        return ()
    listed = fs.listStatus(there)
    return sum(s.getLen() for s in listed), max([s.getModificationTime() for s in listed], default=0)


def exists(spark: SparkSession, path: str) -> bool:
    fs, there = _at(spark, path)
    return fs.exists(there)


def delete(spark: SparkSession, path: str) -> None:
    fs, there = _at(spark, path)
    fs.delete(there, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, there = _at(spark, path)
    stream = fs.open(there)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file at once: readers see all of it or nothing. An error if it is there already."""
    fs, there = _at(spark, path)
    draft = there.suffix(f".{spark.sparkContext._jvm.java.util.UUID.randomUUID()}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(draft, there):
        fs.delete(draft, False)
        raise FileExistsError(path)
