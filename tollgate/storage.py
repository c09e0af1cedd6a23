"""Files of tables, through Spark's own file systems (any path Spark can write)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none when it does not exist."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file in one step: whole under its name, or not at all.  False
    when the name is taken."""
    fs, where = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{_unique()}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(where).toUri(), spark._jsc.hadoopConfiguration()
    )
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.NONE  # never onto an existing file
    try:
        files.rename(fs.makeQualified(draft), fs.makeQualified(where), options)
    except Exception:
        fs.delete(draft, False)
        if fs.exists(where):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def _unique() -> str:
    import uuid

    return uuid.uuid4().hex
