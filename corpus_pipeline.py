"""A training-corpus pipeline: quality filter, exact dedup, near dedup, packing. Each stage reads what the one before it
wrote; all but the last return the columns of ``documents``, which may be any besides doc_id and text, under any names:
rows go through a stage as one value, so that no column of its own can clash with theirs. Every stage takes null ids and
texts, repeated rows and empty tables, as its docstring says."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pairscore.llm.common import Staged, ascii_lower, dropping, table
from pairscore.llm.exact_dedup import exact_dedup
from pairscore.llm.near_dup import near_duplicates
from pairscore.llm.packing import pack
from pairscore.llm.quality import fit_quality, score_quality
from pairscore.llm.queries import KEEP_SCORE, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject. Null texts are judged as
    empty ones; rows with null or repeated ids stay or go by their own texts."""
    forest = fit_quality(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    return score_quality(rows, forest, ["row"]).where(F.col("score") >= KEEP_SCORE).select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts the row with the largest doc_id, a null one only if it is alone; null texts are equal
    to empty ones. Of rows that repeat id and text one stays, the least by its columns' hash."""
    kept = exact_dedup(docs, keep="max").where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha")).distinct()
    told = docs.select("doc_id", F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256).alias("sha"), F.struct(*docs.columns).alias("row"))
    own = told.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha")), "left_semi")
    once = F.row_number().over(Window.partitionBy("doc_id", "sha").orderBy(F.xxhash64("row")))
    return own.withColumn("n", once).where("n = 1").select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row, with the smallest doc_id; null is the largest. Texts without words are no
    duplicates of any. Rows are told apart by a 64-bit hash of doc_id and text, as ids may repeat or be null."""
    key = F.xxhash64("doc_id", "text")
    staged = Staged(spark)
    found = staged.keep(near_duplicates(docs.select(key.alias("doc_id"), "text")).where("n_shingles > 0").groupBy("doc_id", "component_id").agg(F.count("*").alias("n")))
    # only groups of several rows matter: those of several keys, or of a key on several rows
    several = found.groupBy("component_id").agg(F.sum("n").alias("rows")).where("rows > 1")
    members = found.join(several, "component_id").select(F.col("doc_id").alias("_key"), "component_id")
    ids = docs.select("doc_id", key.alias("_key")).distinct()
    order = Window.partitionBy("component_id").orderBy(F.col("doc_id").asc_nulls_last(), "_key")
    first = members.join(ids, "_key").withColumn("_first", F.row_number().over(order) == 1).select("_key", "_first")
    marked = docs.select(key.alias("_key"), F.struct(*docs.columns).alias("row")).join(staged.keep(first), "_key", "left")
    once = marked.where("_first").groupBy("_key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return marked.where(F.col("_first").isNull()).select("row").unionByName(once.select("row")).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences; null texts are empty, repeated rows are documents each."""
    return pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("packing", packing)]

#: Gradient-boosted trees, near-duplicate classes and tokenization have no SQL form; tests hold the pipeline against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Tables that a stage has made for itself are deleted once its result is written, and a
    stage's result once the next one's is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        own = Staged(spark)
        with dropping():
            docs = own.keep(stage(spark, docs, sf_dir))
        if before:
            before.drop()
        before = own
    return docs
