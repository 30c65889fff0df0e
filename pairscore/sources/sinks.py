"""Results as JSON lines, JSON and Markdown."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.evaluate import errors_by_kind
from ..operators.report import kind_order
from ..schemas import ERROR_TYPES, LEVELS

METRICS = [f"{level}_{m}" for level in LEVELS for m in ("precision", "recall", "f1")]


def json_line(row: Column) -> Column:
    """Compact JSON that keeps nulls."""
    return F.to_json(row, {"ignoreNullFields": "false"})


def pair_eval_json(evaluated: DataFrame) -> DataFrame:
    """``doc_id, chunk_idx, value``: a line per chunk with metrics, counts, errors by kind and the judge's word."""
    judged = F.col("llm_judgement") if "llm_judgement" in evaluated.columns else F.lit(None).cast("string")
    head = json_line(F.struct("chunk_id", "reference_source", F.struct(*METRICS).alias("metrics"), F.struct(*LEVELS).alias("counts"), errors_by_kind(F.col("errors")).alias("errors")))
    # the judgement is JSON already
    line = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"llm_judgement":'), F.coalesce(judged, F.lit("null")), F.lit("}"))
    return evaluated.select("doc_id", "chunk_idx", line.alias("value"))


def chunk_json(chunks: DataFrame) -> DataFrame:
    return chunks.select("doc_id", "chunk_idx", json_line(F.struct("chunk_id", "page_hint", "title_path", "text")).alias("value"))


def extraction_json(extractions: DataFrame) -> DataFrame:
    fields = ("chunk_id", "page_hint", "title_path", "entities", "raw_response", "error", "model_name")
    return extractions.select("doc_id", "chunk_idx", json_line(F.struct(*fields)).alias("value"))


def chunk_error_json(counted: DataFrame) -> DataFrame:
    """A line per chunk and kind of error: ids, kind and count."""
    return counted.select("doc_id", "chunk_idx", json_line(F.struct("doc_id", "chunk_id", "error_type", "count")).alias("value"))


def write_lines(lines: DataFrame, path: str, one_file: bool = False) -> None:
    """Lines (doc_id, chunk_idx, value) in order, as a folder of text files in which each file goes on where the one before
    it ends, or as one file."""
    if one_file:
        write_one_file(lines, path, "doc_id", "chunk_idx")
    else:
        lines.orderBy("doc_id", "chunk_idx").select("value").write.mode("overwrite").text(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration())


def write_one_file(lines: DataFrame, path: str, *order: str) -> None:
    """The lines in ``value``, ordered by the columns ``order``, as one text file at ``path``, in place of what is there.

    Sorted parts are written beside it first. A file system that can concatenate (HDFS) then makes one file of them
    without reading them; on any other, a single task writes the sorted partitions one after another, so that its memory
    does not grow with them. The file appears by a rename once it is whole. No line passes through the driver."""
    spark = lines.sparkSession
    files, at = file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    beside = f"{path.rstrip('/')}._parts"
    joins = files.hasPathCapability(at(path).getParent(), "fs.capability.paths.concat")
    ordered = lines.orderBy(*order).select("value")
    (ordered if joins else ordered.coalesce(1)).write.mode("overwrite").text(beside)
    gateway = spark.sparkContext._gateway

    def path_array(paths):
        array = gateway.new_array(at, len(paths))
        for i, p in enumerate(paths):
            array[i] = p
        return array

    commit_parts(files, at, path_array, beside, path)


def commit_parts(files, at, path_array, folder: str, path: str) -> None:
    """Make the part files of a folder, in the order of their names, the file ``path``; only names go through here.
    ``files`` is a Hadoop file system, ``at`` its class of paths and ``path_array`` makes an array of them."""
    parts = sorted((s.getPath() for s in files.listStatus(at(folder)) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    if len(parts) > 1:
        files.concat(parts[0], path_array(parts[1:]))
    files.delete(at(path), True)
    if not files.rename(parts[0], at(path)):
        raise OSError(f"cannot rename {parts[0]} to {path}")
    files.delete(at(folder), True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file through Hadoop's file system, so that it lands where the tables do."""
    out = file_system(spark, path).create(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def report_json(summary: dict) -> str:
    return json.dumps(summary, ensure_ascii=False, indent=2)


def report_lines(spark: SparkSession, summary: dict, chunk_errors: DataFrame) -> DataFrame:
    """``part, doc_id, chunk_idx, kind, value``: the report as one JSON object, line by line: the totals, then the list
    ``chunk_errors`` in order of document, chunk and kind of error. Only the list's first key is read here."""
    keyed = chunk_errors.withColumn("kind", kind_order())
    first = keyed.orderBy("doc_id", "chunk_idx", "kind").select("doc_id", "chunk_idx", "kind").head()
    is_first = F.lit(False) if first is None else F.col("doc_id").eqNullSafe(F.lit(first[0])) & F.col("chunk_idx").eqNullSafe(F.lit(first[1])) & F.col("kind").eqNullSafe(F.lit(first[2]))
    item = json_line(F.struct("chunk_id", "error_type", "count"))
    items = keyed.select(F.lit(1).alias("part"), "doc_id", "chunk_idx", "kind", F.concat(F.when(is_first, "    ").otherwise("   ,"), item).alias("value"))
    head = report_json(summary).removesuffix("\n}") + ',\n  "chunk_errors": ['
    ends = spark.createDataFrame([(0, head), (2, "  ]\n}")], "part int, value string")
    return items.unionByName(ends, allowMissingColumns=True)


def write_report(spark: SparkSession, path: str, summary: dict, chunk_errors: DataFrame) -> None:
    """The report's JSON file; see ``report_lines`` and ``write_one_file``."""
    write_one_file(report_lines(spark, summary, chunk_errors), path, "part", "doc_id", "chunk_idx", "kind")


def report_markdown(summary: dict) -> str:
    head = [f"- {k}: {summary[k]}" for k in ("input_md", "model_a", "model_b", "reference_source", "chunk_count")]
    metrics = [f"- {k}: {summary['metrics'][k]:.6f}" for k in METRICS]
    errors = [f"- {k}: {summary['errors_by_type'][k]}" for k in ERROR_TYPES if k in summary["errors_by_type"]]
    return "\n".join(["# Extraction Summary", "", *head, "", "## Metrics", "", *metrics, "", "## Errors", "", *errors]) + "\n"
