"""Precision, recall and F1 from counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(part: Column, whole: Column) -> Column:
    """0.0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def measures(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F1, to 6 digits by the half-even rule; F1 comes from the unrounded two."""
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    f1 = ratio(2 * precision * recall, precision + recall)
    return tuple(F.bround(x, 6) for x in (precision, recall, f1))


def level_metrics(level: str, counts: Column) -> list[Column]:
    """Three columns of a level from its struct of counts."""
    names = (f"{level}_precision", f"{level}_recall", f"{level}_f1")
    return [m.alias(n) for m, n in zip(measures(counts["tp"], counts["fp"], counts["fn"]), names, strict=True)]
