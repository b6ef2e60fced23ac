"""Small files and folders on whatever file system a path lies on, through Hadoop's interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _on(spark, path)
    return system.exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; none if there is no such folder."""
    system, place = _on(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; an existing target is an error, as is a rename that the file system refuses."""
    system, place = _on(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(to.getParent())
    if system.exists(to) or not system.rename(place, to):
        raise FileExistsError(f"cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    system, place = _on(spark, path)
    system.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, place = _on(spark, path)
    out = system.create(place, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _on(spark, path)
    source = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
