"""Files of any file system Spark can reach, through Hadoop's interface."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(path, file system) as Java objects."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there. Any other storage error is raised, not read as 'missing'."""
    hadoop_path, fs = file_system(spark, path)
    return fs.exists(hadoop_path)


def iterate_names(spark: SparkSession, path: str) -> Iterator[str]:
    """Names in a folder, each fetched when it is asked for; none if it does not exist."""
    hadoop_path, fs = file_system(spark, path)
    if fs.exists(hadoop_path):
        for status in fs.listStatus(hadoop_path):
            yield status.getPath().getName()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    return list(iterate_names(spark, path))


def list_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Visible folders ``depth`` levels below ``path``, as paths relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{parent}{name}/" for parent in found for name in list_names(spark, f"{path}/{parent}") if name[0] not in "._"]
    return [f.rstrip("/") for f in found]


def remove_files(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files or folders; those already gone are skipped."""
    for path in paths:
        hadoop_path, fs = file_system(spark, path)
        fs.delete(hadoop_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a file or folder in a place that is free, below folders made for it."""
    destination, fs = file_system(spark, target)
    fs.mkdirs(destination.getParent())
    if not fs.rename(file_system(spark, source)[0], destination):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    hadoop_path, fs = file_system(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    hadoop_path, fs = file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
