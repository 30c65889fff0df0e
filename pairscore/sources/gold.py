"""Hand-labelled entities as JSON lines."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.parsing import valid_entity
from ..schemas import ENTITY, GOLD
from .markdown import exists
from .shared import parts_by_size

_LINE = f"doc_id string, chunk_id string, file string, block long, place long, entities array<{ENTITY}>"

#: Bytes of gold files whose lines are grouped in one task.
PART_BYTES = 8 << 20


def read_gold(spark: SparkSession, path: str | None) -> DataFrame:
    """``doc_id, chunk_id, entities``, one row a chunk: of lines with the same ids the last counts, of files the last by
    name. ``doc_id`` may be left out (null) where there is one document. No path, or a missing one, gives an empty table.
    Blank lines are skipped; a line that is no JSON object with a chunk_id, or has an invalid entity, fails the query that
    reads it.

    Large files are read in splits. A line's place is its file, where its split begins in the file, and its number in the
    order of reading, which within a split is the order of lines."""
    if not path or not exists(spark, path):
        return spark.createDataFrame([], GOLD)

    def parse(batches):
        for pdf in batches:
            rows = []
            for line, file, block, place in zip(pdf["value"], pdf["file"], pdf["block"], pdf["place"]):
                item = json.loads(line)
                entities = []
                for given in item.get("entities", []):
                    entity = valid_entity(given) if isinstance(given, dict) else None
                    if entity is None:
                        raise ValueError(f"invalid gold entity in {file}, in the split from byte {block}: {given!r}")
                    entities.append(entity)
                doc_id = item.get("doc_id")
                rows.append((None if doc_id is None else str(doc_id), str(item["chunk_id"]), file, block, place, entities))
            yield pd.DataFrame(rows, columns=["doc_id", "chunk_id", "file", "block", "place", "entities"])

    parsed = gold_lines(spark, path).mapInPandas(parse, _LINE)
    # the same paths in all rows compress so well that partitions of few bytes, of which larger ones are made, are long to sort
    parsed = parsed.repartition(parts_by_size(spark.read.text(path), PART_BYTES), "doc_id", "chunk_id")
    return parsed.groupBy("doc_id", "chunk_id").agg(F.max_by("entities", F.struct("file", "block", "place")).alias("entities"))


def gold_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, block, place``: lines that are not blank, with what they are ordered by."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    return lines.where(F.trim("value") != "")
