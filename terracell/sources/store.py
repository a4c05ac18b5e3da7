"""Small files and paths in whatever store Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a written table is whole: its folder, or one of a model's, has the mark of success; a plain file exists."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return False
    if not fs.getFileStatus(place).isDirectory():
        return True
    return any(fs.exists(_at(spark, f"{path.rstrip('/')}/{inner}_SUCCESS")[1]) for inner in ("", "metadata/"))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is none."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file: written beside it, then renamed, so a reader finds the old or the new."""
    fs, place = _at(spark, path)
    _, draft = _at(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(place):
        fs.delete(place, False)
    if not fs.rename(draft, place):
        raise OSError(f"could not replace {path}")


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def first_known(spark: SparkSession, *candidates: str | None) -> str | None:
    """The first candidate that is given and exists, else None: an option, what an earlier step recorded, a default."""
    return next((c for c in candidates if c and exists(spark, c)), None)
