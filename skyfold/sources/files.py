"""Small files through Spark's own file systems: markers and headers, never data."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none when it does not exist."""
    fs, p = _at(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files under ``path`` (or the one there) that Spark would read."""
    fs, p = _at(spark, path)
    found = fs.globStatus(p) or []
    out = []
    for s in found:
        for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s]):
            if f.isFile() and not f.getPath().getName().startswith(("_", ".")):
                out.append(f.getPath().toString())
    return sorted(out)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    jvm = spark._jvm.java.io
    stream = jvm.BufferedReader(jvm.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return stream.readLine() or ""
    finally:
        stream.close()


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file so that it is there complete or not at all.

    Written beside its place and renamed; what a writer that died left beside
    it is replaced.
    """
    fs, p = _at(spark, path)
    _, beside = _at(spark, path.rsplit("/", 1)[0] + "/." + path.rsplit("/", 1)[1])
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(beside, p):
        raise FileExistsError(path)
