"""The report over all chunks: micro-averages and error counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.metrics import level_metrics
from ..schemas import ERROR_TYPES, LEVELS


def summary_counts(evaluated: DataFrame) -> DataFrame:
    """One row: for each level the struct of summed counts."""
    total = lambda level, part: F.coalesce(F.sum(f"{level}.{part}"), F.lit(0)).cast("bigint").alias(part)
    return evaluated.agg(*[F.struct(*[total(level, p) for p in ("tp", "fp", "fn")]).alias(level) for level in LEVELS])


def summary_metrics(evaluated: DataFrame) -> DataFrame:
    """One row: counts and the nine metrics, from the sums and not from the chunks' metrics."""
    return summary_counts(evaluated).select(*LEVELS, *[m for level in LEVELS for m in level_metrics(level, F.col(level))])


def observed_sums() -> list[Column]:
    """What ``report_of`` needs, as sums over scores, to be observed while these are written: the number of chunks, the counts
    of each level, the errors of each kind, and the first chunk's reference_source."""
    counts = [F.sum(f"{level}.{p}").alias(f"{level}_{p}") for level in LEVELS for p in ("tp", "fp", "fn")]
    label = F.min_by("reference_source", F.struct("doc_id", "chunk_idx")).alias("reference_source")
    return [F.count(F.lit(1)).alias("rows"), *counts, *error_sums(), label]


def kind_order() -> Column:
    """The place of ``error_type`` in the report."""
    return F.array_position(F.array(*map(F.lit, ERROR_TYPES)), F.col("error_type")).cast("int")


def error_sums() -> list[Column]:
    """A sum for each kind of error, of the lists in ``errors``."""
    of = lambda kind: F.size(F.filter("errors", lambda e: e["error_type"] == kind))
    return [F.sum(of(k)).cast("bigint").alias(k) for k in ERROR_TYPES]


def errors_by_type(evaluated: DataFrame) -> DataFrame:
    """``error_type, count`` with zeros kept, unless there is no chunk at all. One pass: a sum a kind, then a row a kind."""
    sums = evaluated.agg(F.count("*").alias("chunks"), *error_sums())
    rows = F.array(*[F.struct(F.lit(k).alias("error_type"), F.col(k).alias("count")) for k in ERROR_TYPES])
    return sums.where("chunks > 0").select(F.inline(rows))


def chunk_errors(errors: DataFrame, keys=("doc_id", "chunk_idx", "chunk_id")) -> DataFrame:
    """``keys, error_type, count``, without zeros."""
    return errors.groupBy(*keys, "error_type").agg(F.count("*").alias("count"))


def reference_label(evaluated: DataFrame, keys=("doc_id", "chunk_idx")) -> DataFrame:
    """One row: the first chunk's reference_source."""
    first = F.min_by("reference_source", F.struct(*keys))
    return evaluated.agg(F.coalesce(first, F.lit("model_a_pseudo_gold")).alias("reference_source"))


def ordered_chunk_errors(counted: DataFrame) -> DataFrame:
    """In report order: by chunk, then kind."""
    return counted.orderBy("doc_id", "chunk_idx", kind_order())
