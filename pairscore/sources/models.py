"""Models that answer prompts, and the operators that ask them.

A model is anything with ``name`` and ``open()``, which gives a function from (system, user) to the answer's text. It is
opened once a task, on the executor, so clients need not be sent, and asked by several threads there. How many requests
are in flight at once, and how often one is tried, ``asking.Limits`` says; a number stands for that many at once. Answers cost money and may differ the next time: write
them to a table before they are used twice (``plans.pipeline`` does).
"""

from __future__ import annotations

import json
import re
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.batches import by_bytes, in_parts
from ..functions.parsing import find_object, parse_answer
from ..functions.text import answer_lines
from ..plans.prompts import EXTRACTION_SYSTEM, JUDGE_SYSTEM, extraction_prompt, judge_prompt, judge_questions_prompt, question_prompt
from ..schemas import ENTITY, RESPONSE
from .asking import Limits, all_answers, answers, shared_out

#: A response's columns: where the chunk stands, and what the model said.
_PLACE, _REPLY = RESPONSE[: RESPONSE.index(", raw_response")], RESPONSE[RESPONSE.index("raw_response") :]
Ask = Callable[[str, str], str]


class Model(Protocol):
    name: str

    def open(self) -> Ask: ...


@dataclass(frozen=True)
class ChatModel:
    """A chat-completions endpoint. ``temperature`` None leaves it to the server."""

    base_url: str
    api_key: str = field(repr=False)
    name: str = ""
    temperature: float | None = 0
    timeout: float = 120.0

    def open(self) -> Ask:
        def ask(system: str, user: str) -> str:
            messages = [{"role": r, "content": c} for r, c in (("system", system), ("user", user)) if c]
            body = {"model": self.name, "messages": messages} | ({} if self.temperature is None else {"temperature": self.temperature})
            head = {"Content-Type": "application/json", "Authorization": f"Bearer {self.api_key}"}
            request = urllib.request.Request(f"{self.base_url.rstrip('/')}/chat/completions", json.dumps(body).encode(), head)
            with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                return json.load(reply)["choices"][0]["message"]["content"] or ""

        return ask


@dataclass(frozen=True)
class StubModel:
    """A deterministic model for tests: the capitalised words of a text as entities. With ``drop_every`` it leaves out
    those whose length that number divides, as a weaker model might."""

    name: str = "stub"
    drop_every: int = 0

    def open(self) -> Ask:
        def ask(system: str, user: str) -> str:
            words = dict.fromkeys(re.findall(r"[A-Z][a-z]{4,}", user))
            found = [w for w in words if not self.drop_every or len(w) % self.drop_every]
            entities = [
                {"name": w, "type": ("missile", "radar", "equipment")[len(w) % 3], "attributes": {"len": str(len(w)), "first": w[0]},
                 "relations": [{"relation": "携带", "target": t}] if t else [], "evidence": [{"page": "1", "text": w}]}
                for w, t in zip(found, [*found[1:], ""])
            ]
            return json.dumps({"entities": entities}, ensure_ascii=False)

        return ask


def _limits(concurrency: int | Limits | None) -> Limits:
    return concurrency if isinstance(concurrency, Limits) else Limits(concurrency) if concurrency else Limits()


def ask_model(chunks: DataFrame, model: Model, concurrency: int | Limits | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Raw answers, schemas.RESPONSE: one request a chunk. A request that fails gives a row with the error and the empty
    answer; the query goes on. ``concurrency`` bounds the requests made at the same time. The string columns in ``carry``
    come back too."""
    limits = _limits(concurrency)
    dealt, threads = shared_out(chunks, limits)

    def run(batches):
        ask = model.open()
        for pdf in in_parts(batches):
            prompts = ((EXTRACTION_SYSTEM, extraction_prompt(c, p, list(t), x)) for c, p, t, x in zip(pdf["chunk_id"], pdf["page_hint"], pdf["title_path"], pdf["text"]))
            told = list(answers(ask, prompts, threads, limits))
            errors = [e and f"{type(e).__name__}: {e}" for _, e in told]
            yield pdf.drop(columns="text").assign(raw_response=[a for a, _ in told], error=errors, model_name=model.name)

    return dealt.select("doc_id", "chunk_idx", "chunk_id", "page_hint", "title_path", "text", *carry).mapInPandas(run, ", ".join([_PLACE, *(f"{c} string" for c in carry), _REPLY]))


def parse_responses(responses: DataFrame) -> DataFrame:
    """Extractions from raw answers. A failed request keeps its error and has no entities."""
    names = [c.split(" ")[0] for c in RESPONSE.split(", ")]
    raw, failed = names.index("raw_response"), names.index("error")
    read = responses.select(*names)
    entities = StructType.fromDDL(f"entities array<{ENTITY}>")
    schema = StructType([*read.schema.fields[:5], *entities.fields, *read.schema.fields[5:]])
    kind = to_arrow_schema(entities)[0].type

    def run(batches):
        for part in by_bytes(batches, raw):
            found, errors = [], []
            for text, error in zip(part.column(raw).to_pylist(), part.column(failed).to_pylist()):
                listed, wrong = ([], error) if error is not None else parse_answer(text)
                found.append([{**e, "attributes": list(e["attributes"].items())} for e in listed])
                errors.append(wrong)
            columns = [pa.array(errors, c.type) if i == failed else c for i, c in enumerate(part.columns)]
            yield pa.RecordBatch.from_arrays([*columns[:5], pa.array(found, kind), *columns[5:]], schema.names)

    return read.mapInArrow(run, schema)


def extract(chunks: DataFrame, model: Model, concurrency: int | None = None) -> DataFrame:
    """schemas.EXTRACTION of every chunk by a model."""
    return parse_responses(ask_model(chunks, model, concurrency))


def judge(candidates: DataFrame, model: Model, concurrency: int | Limits | None = None) -> DataFrame:
    """``doc_id, chunk_idx, llm_judgement`` for rows (doc_id, chunk_idx, text, reference_json, prediction_json): the
    answer's object as JSON, or {"error": reason}."""
    limits = _limits(concurrency)
    dealt, threads = shared_out(candidates, limits)

    def run(batches):
        ask = model.open()
        for pdf in in_parts(batches):
            verdicts = []
            prompts = ((JUDGE_SYSTEM, judge_prompt(t, r, p)) for t, r, p in zip(pdf["text"], pdf["reference_json"], pdf["prediction_json"]))
            for answer, failed in answers(ask, prompts, threads, limits):
                found, error = (None, f"{type(failed).__name__}: {failed}") if failed else find_object(answer)
                verdicts.append(json.dumps(found or {"error": error}, ensure_ascii=False, separators=(",", ":")))
            yield pdf[["doc_id", "chunk_idx"]].assign(llm_judgement=verdicts)

    columns = ["doc_id", "chunk_idx", "text", "reference_json", "prediction_json"]
    return dealt.select(*columns).mapInPandas(run, "doc_id string, chunk_idx int, llm_judgement string")


def _ask_batches(batches: DataFrame, model: Model, concurrency: int | Limits | None, prompt, *fields: str) -> DataFrame:
    """``category, batch_id, text``: the answer to the prompt made of each row's ``fields``. A failed request fails the query."""
    limits = _limits(concurrency)
    dealt, threads = shared_out(batches, limits)

    def run(parts):
        ask = model.open()
        for pdf in in_parts(parts):
            told = all_answers(ask, (("", prompt(*values)) for values in zip(*(pdf[f] for f in fields))), threads, limits)
            yield pdf[["category", "batch_id"]].assign(text=told)

    return dealt.select(*dict.fromkeys(["category", "batch_id", *fields])).mapInPandas(run, "category string, batch_id int, text string")


def generate_answers(batches: DataFrame, model: Model, concurrency: int | Limits | None = None) -> DataFrame:
    """``category, batch_id, text``: a request per task batch. A failed request fails the query."""
    return _ask_batches(batches, model, concurrency, question_prompt, "category", "count", "description")


def score_answers(answers_: DataFrame, model: Model, concurrency: int | Limits | None = None) -> DataFrame:
    """``category, batch_id, text``: the judge's scores, one a line, for the questions of each answer (category, batch_id,
    text). An answer without questions is not sent. A failed request fails the query."""
    asked = answers_.select("category", "batch_id", answer_lines(F.coalesce("text", F.lit(""))).alias("questions")).where(F.size("questions") > 0)
    return _ask_batches(asked, model, concurrency, lambda category, questions: judge_questions_prompt(category, list(questions)), "category", "questions")


@dataclass(frozen=True)
class ListingModel:
    """A deterministic model for tests: to a request for n questions it answers n numbered lines with a blank one after
    each, to a list of questions the last digit of each one's length."""

    name: str = "listing"

    def open(self) -> Ask:
        def ask(system: str, user: str) -> str:
            head, _, rest = user.partition("\n\n")
            if asked := re.search(r"\d+ practice", head):
                return "".join(f" question {i}\n\n" for i in range(1, int(asked.group().split()[0]) + 1))
            return "\n".join(str(len(line) % 10) for line in rest.split("\n"))

        return ask

