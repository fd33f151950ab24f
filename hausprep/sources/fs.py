"""File-system metadata through Hadoop's FileSystem API (works for local
paths, HDFS and object stores alike).  Only names cross to the driver,
never file contents."""

from __future__ import annotations

from py4j.java_gateway import is_instance_of
from pyspark.sql import SparkSession


#: What Spark's writers leave beside the data.
SPARK_MARKERS = ("_SUCCESS", "_temporary", "_metadata", "_common_metadata")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.getFileStatus(p).isFile())


def list_names(spark: SparkSession, directory: str) -> list[tuple[str, str]]:
    """``(name, full path)`` of the entries of a directory, sorted by name.
    A Spark output directory (``x.csv/part-*``) counts as one entry."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        raise FileNotFoundError(directory)
    out = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith(".") or name in SPARK_MARKERS:
            continue
        out.append((name, status.getPath().toString()))
    return sorted(out)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def _codecs(spark: SparkSession):
    """Finds by a file's name how it is compressed, as Spark's text reader does."""
    return spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())


def first_lines(spark: SparkSession, path: str, enough) -> str:
    """The first lines of a text file (of the first file with text in a directory), as many as ``enough(text)`` asks for.
    A line ends at a line feed only.  This reads a file's header, not its rows.  A file may be compressed."""
    fs, p = _fs(spark, path)
    status = fs.getFileStatus(p)
    if status.isDirectory():
        for name, inner in list_names(spark, path):
            if not name.startswith("_"):
                text = first_lines(spark, inner, enough)
                if text:
                    return text
        return ""
    jvm = spark.sparkContext._jvm
    codec = _codecs(spark).getCodec(p)
    stream = codec.createInputStream(fs.open(p)) if codec else fs.open(p)
    scanner = jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\n")
    try:
        lines: list[str] = []
        while scanner.hasNext():
            lines.append(scanner.next())
            text = "\n".join(lines)
            if text.strip("\r\n\ufeff") and enough(text.lstrip("\r\n\ufeff")):
                break
        return "\n".join(lines).lstrip("\r\n\ufeff").rstrip("\r")
    finally:
        scanner.close()


def sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of a file, or of the files of a directory."""
    fs, p = _fs(spark, path)
    status = fs.getFileStatus(p)
    return [s.getLen() for s in fs.listStatus(p)] if status.isDirectory() else [status.getLen()]


def split_sizes(spark: SparkSession, path: str) -> list[int]:
    """:func:`sizes` without the files of which each is read by one task whatever its size, as it is compressed in one piece."""
    fs, p = _fs(spark, path)
    status = fs.getFileStatus(p)
    factory = _codecs(spark)
    found = []
    for s in fs.listStatus(p) if status.isDirectory() else [status]:
        codec = factory.getCodec(s.getPath())
        if codec is None or is_instance_of(spark.sparkContext._gateway, codec, "org.apache.hadoop.io.compress.SplittableCompressionCodec"):
            found.append(s.getLen())
    return found
