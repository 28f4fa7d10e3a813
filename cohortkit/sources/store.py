"""Small files on the shared store, by Hadoop's file systems: any path that Spark can write."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def files(spark: SparkSession, path: str) -> list[str]:
    """The file at a path, or the files in a folder that Spark's readers see."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    found = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(p) if s.isFile()]
    return sorted(f for name, f in found if not name.startswith(("_", ".")))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode())


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes a small file; one that is there is replaced."""
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A file's text, or None where there is none."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where it is not there."""
    fs, p = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Gives a file its name; False where that name is taken."""
    fs, p = _path(spark, source)
    q = _path(spark, target)[1]
    return not fs.exists(q) and fs.rename(p, q)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)
