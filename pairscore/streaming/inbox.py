"""Documents that arrive in a folder, chunked and scored as they come.

Every step up to the scores of a chunk looks at one document only, so a stream runs the batch functions unchanged on each
micro-batch. The report's counts are sums: they are kept as the state of a streaming aggregation, which its checkpoint
makes exact, also after a batch that is run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.chunking import chunk_documents
from ..operators.report import error_sums, summary_counts
from ..schemas import ERROR_TYPES, LEVELS


def read_inbox(spark: SparkSession, folder: str, pattern: str = "*.md", max_files: int = 1000) -> DataFrame:
    """A stream of ``doc_id, text``: each new file once."""
    files = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files).load(folder)
    return files.select(F.col("_metadata.file_path").alias("doc_id"), F.regexp_replace("value", r"\r\n?", "\n").alias("text"))


def stream_chunks(docs: DataFrame) -> DataFrame:
    return chunk_documents(docs)


def score_stream(chunks: DataFrame, score: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write ``score(batch of chunks)`` under ``output``, one folder a batch. A batch that is run again, after a failure,
    overwrites its own folder, so nothing is counted twice."""

    def each(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return chunks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def total_counts(scores: DataFrame) -> DataFrame:
    """The summed counts of all batches, one row, as ``report.summary_counts`` gives them."""
    return summary_counts(scores.select(*LEVELS))


def read_table_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """A Parquet table, a file or a folder of them, as a stream of its files."""
    schema = spark.read.parquet(path).schema
    # a pattern that fits the name alone is listed whether it is a file or a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{path[:-1]}[{path[-1]}]")


def summary_stream(scores: DataFrame, output: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The report's sums over all scores (``evaluate.score_lists``) so far, one row under ``output`` for each batch: the counts
    of each level, ``chunks``, and a sum for each kind of error. The state is a row of numbers whatever has streamed."""
    totals = scores.agg(F.count("*").alias("chunks"), *[F.sum(f"{level}.{p}").alias(f"{level}_{p}") for level in LEVELS for p in ("tp", "fp", "fn")], *error_sums())

    def each(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch_no", F.lit(number)).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return totals.writeStream.outputMode("complete").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def latest_summary(spark: SparkSession, output: str) -> DataFrame:
    """The sums after the last batch, one row."""
    rows = spark.read.parquet(output)
    return rows.join(rows.agg(F.max("batch_no").alias("batch_no")), "batch_no").drop("batch", "batch_no")


def summary_errors(summary: DataFrame, kinds: Iterable[str] = ERROR_TYPES) -> DataFrame:
    """``error_type, count`` from the sums, as ``report.errors_by_type``."""
    return summary.where("chunks > 0").select(F.inline(F.array(*[F.struct(F.lit(k).alias("error_type"), F.col(k).alias("count")) for k in kinds])))
