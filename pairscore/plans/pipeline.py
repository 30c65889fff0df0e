"""The two runs: evaluating two extraction models on Markdown documents, and generating question sets."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from ..functions.metrics import level_metrics
from ..operators import evaluate as ev, generate, report
from ..operators.chunking import MAX_CHARS, MIN_CHARS, chunk_documents
from ..operators.merge import KEYS, normalize_extractions
from ..schemas import ERROR_TYPES, LEVELS, RESPONSE
from ..sources import sinks
from ..sources.gold import read_gold
from ..sources.markdown import load_markdown
from ..sources.models import Model, ask_model, generate_answers, judge, parse_responses, score_answers
from ..sources.store import Store, best_by
from .log import driver_logger
from .prompts import EXTRACTION_SYSTEM, extraction_prompt_column

_PROMPT = "prompt_sha"
_ANSWERS = f"{RESPONSE}, {_PROMPT} string, asked_at timestamp"
#: Files a bucket of the answers from which on they are compacted.
MOST_FILES = 16


class Tables:
    """The tables of a run under one folder, each logged with its rows and the time it took. What is counted or summed up of
    a table is observed while it is written; no table is read again for it. ``seen`` has what was observed, by table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.log = spark, folder, driver_logger()
        self.seen: dict[str, dict] = {}

    def keep(self, df: DataFrame, name: str, *sums: Column) -> DataFrame:
        began, observed = time.perf_counter(), Observation()
        told = sums or (F.count(F.lit(1)).alias("rows"),)
        df.observe(observed, *told).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        self.seen[name] = {"rows": 0, **observed.get}
        self.log.info(f"{name}: {self.seen[name]['rows']} rows in {time.perf_counter() - began:.1f} s")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")


def kept_answers(chunks: DataFrame, model: Model, path: str, concurrency: int | None = None) -> DataFrame:
    """The model's raw answers to ``chunks``, schemas.RESPONSE, from a table at ``path`` to which those that it lacks are
    added first: an answer is paid for once, whatever is recomputed or run again.

    An answer belongs to its whole prompt, told by a hash: a changed chunk is asked for anew, chunks that are gone give
    no rows, and chunks of equal prompts share one. A failed request is no answer, so the next run asks again."""
    store = Store(chunks.sparkSession, path, _ANSWERS, _PROMPT)
    prompt = F.sha2(F.concat(F.lit(EXTRACTION_SYSTEM + "\n"), extraction_prompt_column()), 256)
    wanted = chunks.withColumn(_PROMPT, prompt)
    asked = ask_model(unanswered(wanted, store, model.name), model, concurrency, (_PROMPT,)).withColumn("asked_at", F.current_timestamp())
    store.append(asked)
    if store.files() > MOST_FILES * store.buckets:
        told = [c.split(" ")[0] for c in _ANSWERS.split(", ")]
        # answers of other models stay, each model's best by itself
        by_model = Window.partitionBy(_PROMPT, "model_name").orderBy(F.col("error").isNull().desc(), F.col("asked_at").desc(), F.col("raw_response").desc())
        store.compact(store.rows().withColumn("_nth", F.row_number().over(by_model)).where("_nth = 1").select(*told))
    # one answer a prompt: any that did not fail before one that did, then the latest
    order = F.struct(F.col("error").isNull(), "asked_at", "raw_response")
    answers = best_by(store.rows().where(F.col("model_name") == model.name), _PROMPT, order, "raw_response", "error", "model_name")
    return wanted.join(answers, _PROMPT).select(*[c.split(" ")[0] for c in RESPONSE.split(", ")])


def unanswered(wanted: DataFrame, store: Store, model: str) -> DataFrame:
    """A chunk for each prompt to which the store has no answer of the model that did not fail. Only the chunks are dealt."""
    known = store.rows().where((F.col("model_name") == model) & F.col("error").isNull()).select(_PROMPT)
    return wanted.join(known, _PROMPT, "left_anti").dropDuplicates([_PROMPT])


def judge_candidates(evaluated: DataFrame, chunks: DataFrame, a: DataFrame, b: DataFrame, gold: DataFrame | None = None) -> DataFrame:
    """Chunks with any error: ``doc_id, chunk_idx, text, reference_json, prediction_json``."""
    faulty = evaluated.where(F.size("errors") > 0).select(*KEYS)
    chosen = ev.choose_reference(b, a, gold).join(faulty, list(KEYS), "left_semi")
    texts = chunks.select(*KEYS, "text")
    return chosen.join(texts, list(KEYS), "left").select(
        *KEYS, F.coalesce("text", F.lit("")).alias("text"),
        F.to_json("ref_entities", {"ignoreNullFields": "false"}).alias("reference_json"), F.to_json("entities", {"ignoreNullFields": "false"}).alias("prediction_json"),
    )


def summarize(evaluated: DataFrame, chunks: DataFrame, **head: str) -> dict:
    """The report's totals as a dictionary, of a size that does not depend on the number of chunks."""
    totals = report.summary_metrics(evaluated).first().asDict(recursive=True)
    by_type = {r["error_type"]: r["count"] for r in report.errors_by_type(evaluated).collect()}
    return {
        **head,
        "reference_source": report.reference_label(evaluated).first()["reference_source"],
        "chunk_count": chunks.count(),
        "metrics": {k: totals[k] for k in sinks.METRICS},
        "counts": {level: totals[level] for level in LEVELS},
        "errors_by_type": {k: by_type[k] for k in ERROR_TYPES if k in by_type},
    }


def summarize_seen(spark: SparkSession, seen: dict, chunk_count: int, **head: str) -> dict:
    """As ``summarize``, from the sums that were observed while the scores were written (``report.observed_sums``)."""
    number = lambda name: seen.get(name) or 0
    counts = {level: {p: number(f"{level}_{p}") for p in ("tp", "fp", "fn")} for level in LEVELS}
    one = spark.range(1).select(*[m for level in LEVELS for m in level_metrics(level, F.struct(*[F.lit(counts[level][p]).alias(p) for p in ("tp", "fp", "fn")]))]).first()
    return {
        **head,
        "reference_source": seen.get("reference_source") or "model_a_pseudo_gold",
        "chunk_count": chunk_count,
        "metrics": {k: one[k] for k in sinks.METRICS},
        "counts": counts,
        "errors_by_type": {k: number(k) for k in ERROR_TYPES} if seen["rows"] else {},
    }


def run_eval(
    spark: SparkSession, input_md: str, output_dir: str, model_a: Model, model_b: Model, gold_jsonl: str | None = None,
    judge_model: Model | None = None, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS, concurrency: int | None = None, one_file: bool = False,
) -> tuple[dict, list[str]]:
    """Chunk, extract with both models, normalise, score B against gold or A, report. Returns the report's totals and
    messages of what failed; writes five tables of JSON lines, the report as JSON and Markdown, and the raw answers.

    Steps are cut at tables, so that no answer is asked for twice: chunks, the two models' answers, the scores. The errors
    of each chunk are a table, and the report is written from it by the executors: nothing of the corpus's size passes
    through here. ``one_file`` makes one file of each table of lines."""
    tables = Tables(spark, f"{output_dir.rstrip('/')}/_tables")
    docs, errors = load_markdown(spark, input_md)
    for error in errors:
        tables.log.warning(error)
    chunks = tables.keep(chunk_documents(docs, min_chars, max_chars), "chunks")
    a, b = (tables.keep(normalize_extractions(parse_responses(kept_answers(chunks, m, f"{tables.folder}/answers_{side}", concurrency))), f"extractions_{side}") for side, m in (("a", model_a), ("b", model_b)))
    gold = read_gold(spark, gold_jsonl) if gold_jsonl else None
    if gold is not None:
        gold = tables.keep(gold, "gold")  # an invalid gold line fails the run here
    evaluated = tables.keep(ev.evaluate_pairs(b, a, gold), "pair_eval", *report.observed_sums())
    if judge_model is not None:
        verdicts = tables.keep(judge(judge_candidates(evaluated, chunks, a, b, gold), judge_model, concurrency), "judgements")
        evaluated = evaluated.join(verdicts, list(KEYS), "left")
    chunk_errors = tables.keep(report.chunk_errors(ev.error_rows(evaluated)), "chunk_errors")
    for name, lines in (("chunks", sinks.chunk_json(chunks)), ("model_a_entities", sinks.extraction_json(a)), ("model_b_entities", sinks.extraction_json(b)), ("pair_eval", sinks.pair_eval_json(evaluated)), ("chunk_errors", sinks.chunk_error_json(chunk_errors))):
        sinks.write_lines(lines, f"{output_dir}/{name}.jsonl", one_file)
    summary = summarize_seen(spark, tables.seen["pair_eval"], tables.seen["chunks"]["rows"], input_md=input_md, output_dir=output_dir, model_a=model_a.name, model_b=model_b.name)
    sinks.write_report(spark, f"{output_dir}/summary_report.json", summary, chunk_errors)
    sinks.write_text(spark, f"{output_dir}/summary_report.md", sinks.report_markdown(summary))
    tables.log.info(f"report of {summary['chunk_count']} chunks in {output_dir}")
    return summary, errors


def run_generation(
    spark: SparkSession, model: Model, output: str | None = None, max_tasks: int | None = 1, concurrency: int = generate.MAX_CONCURRENCY, judge_model: Model | None = None,
) -> DataFrame:
    """Questions for the catalogue's tasks: ``category, question, score``. With ``output``, the answers are written there
    before they are split, and not asked for again by later reads of the result. ``judge_model`` scores each question
    from 0 to 9; without one all scores are 0. It needs ``output``, since it is asked about answers that must not change."""
    if judge_model and not output:
        raise ValueError("judging needs an output folder, where the answers are kept")
    batches = generate.task_batches(generate.catalogue_tasks(spark), max_tasks=max_tasks)
    answers = generate_answers(batches, model, concurrency)
    if output:
        tables = Tables(spark, output.rstrip("/"))
        answers = tables.keep(answers, "answers")
    if judge_model:
        scores = tables.keep(score_answers(answers, judge_model, concurrency), "scores")
        return generate.judged_questions(generate.numbered_questions(answers), scores)
    return generate.question_rows(answers)
