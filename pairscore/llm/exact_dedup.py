"""Exact dedup by content sort (DataFrame functions only).

Sampled splitters range-partition the normalised texts, an external sort puts equal texts next to each other, and a
pass over neighbours compares the whole texts and settles each run. The ranges go by the first HEAD characters, then a
hash, so that the samples on the driver stay small however long the texts are; the sort goes on to the whole text.

A text that many rows have would fill one range. Those of more than HOT_ROWS rows, or of a share of HOT_SHARE in a small
table, get as many salts as they have times so many rows, dealt by the number of the row; their runs are settled salt by
salt, and the group's size and smallest or largest id come from a plain aggregate by the whole text, which is combined
before it is shuffled. There are at most max(1 / HOT_SHARE, rows / HOT_ROWS) such texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import ascii_lower

#: A text is salted from so many rows on, or from so large a share of a table's rows, if that is less.
HOT_ROWS, HOT_SHARE = 100_000, 0.002
#: Rows of a small table: it is one range or a few, where nothing is gained by salts.
SMALL = 32_000
HEAD = 32


def exact_dedup(docs: DataFrame, keep: str = "min", partitions: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, and empty texts are equal to each
    other. ``keep`` is ``min`` or ``max``: which doc_id of a group stays. Rows without doc_id count in ``group_size``
    and stay only if no row of their group has one (keep_id is null then). Rows that repeat the same doc_id and text
    are one document given twice: each row comes back, and both are ``kept`` if that doc_id stays. Other columns of
    ``docs`` are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    best = F.max if keep == "max" else F.min
    rows = docs.select(F.col("doc_id"), ascii_lower(F.coalesce(F.col("text"), F.lit(""))).alias("norm"))
    keyed = rows.select("doc_id", "norm", F.substring("norm", 1, HEAD).alias("head"), F.xxhash64("norm").alias("print"))
    n_rows = docs.count()
    bound = max(2, min(HOT_ROWS, int(n_rows * HOT_SHARE)))
    found = []
    if n_rows >= SMALL:
        counted = rows.select(F.xxhash64("norm").alias("print")).groupBy("print").agg(F.count("*").alias("n")).where(F.col("n") >= bound)
        found = counted.select("print", F.ceil(F.col("n") / bound).cast("int").alias("salts")).collect()  # 12 bytes a text, see above
    hot = spark.createDataFrame(found, "print long, salts int")
    # the number of a row within its split: rows that are equal in everything are told apart too
    salted = keyed.join(F.broadcast(hot), "print", "left").withColumn("salt", F.coalesce(F.monotonically_increasing_id() % F.col("salts"), F.lit(0)))
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = salted.repartitionByRange(n, "head", "print", "salt").sortWithinPartitions("head", "print", "salt", "norm")
    run = Window.partitionBy("head", "print", "salt", "norm")  # the ranges and the sort above serve it: no further exchange
    settled = ranged.select("doc_id", F.sha2(F.col("norm"), 256).alias("text_sha256"), best("doc_id").over(run).alias("run_id"), F.count("*").over(run).alias("run_n"))
    merged = (
        keyed.join(F.broadcast(hot), "print", "left_semi").groupBy("norm").agg(best("doc_id").alias("all_id"), F.count("*").alias("all_n"))
        .select(F.sha2("norm", 256).alias("all_sha"), "all_id", "all_n")
    )
    keep_id, size = F.col("run_id"), F.col("run_n")
    if found:
        settled = settled.join(F.broadcast(merged), F.col("text_sha256") == F.col("all_sha"), "left")  # a row a hot text
        keep_id, size = F.when(F.col("all_n").isNull(), keep_id).otherwise(F.col("all_id")), F.coalesce("all_n", "run_n")
    return settled.select("doc_id", keep_id.alias("keep_id"), size.cast("long").alias("group_size"), "text_sha256").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
