"""Markdown files as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import DOCUMENT


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a pattern, names anything in whatever store it is in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, text``: a row per file, whole, in UTF-8, with line ends as \\n; the file's path is its id. One file, a
    folder or a pattern. A path that names nothing raises FileNotFoundError."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("doc_id"), F.regexp_replace("value", r"\r\n?", "\n").alias("text"))


def load_markdown(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """As ``read_markdown``, but a missing input gives an empty table and a message."""
    try:
        return read_markdown(spark, path), []
    except FileNotFoundError as e:
        return spark.createDataFrame([], DOCUMENT), [f"load_markdown: FileNotFoundError: {e}"]
