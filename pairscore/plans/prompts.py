"""Prompts for the models."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import ENTITY_TYPES

# The relation names to choose from and the shape of an answer, which the parser reads.
_RELATION_NAMES = "装备/属于/改装自/包含/使用/携带/位于/继承自"
_ENTITY_SHAPE = f'''{{"entities": [{{"name": "", "type": "", "aliases": [""], "attributes": {{"name": "value"}},
"relations": [{{"relation": "{_RELATION_NAMES}", "target": ""}}], "evidence": [{{"page": "", "text": ""}}]}}]}}'''
_VERDICT_SHAPE = '''{"wrong_attachment": [{"entity": "", "attribute": "", "reason": ""}],
"wrong_relation": [{"subject": "", "relation": "", "target": "", "reason": ""}], "notes": [""]}'''

EXTRACTION_SYSTEM = f"""Return one JSON object of this shape, with no text around it:
{_ENTITY_SHAPE}

You read scanned Markdown, chunk by chunk, to fill a graph of equipment.
- type: one of {", ".join(ENTITY_TYPES)} where one fits.
- evidence: the page and the words that name the entity. What you cannot quote from the chunk, you leave out.
- attributes: by the entity they describe, as written.
- relations: from the entity to a target's name, level by level where things are part of each other.
- A thing mentioned several times is one entry, its other names are aliases."""

JUDGE_SYSTEM = f"""Return one JSON object of this shape, with no text around it:
{_VERDICT_SHAPE}

You are given a text and two lists of entities taken from it, and explain their differences from the text alone.
Report attributes that belong to another entity, relations whose subject, name or target is wrong, and, as notes, names
that are the same but for spacing, character width or an alias."""

_EXTRACTION = ("Extract the entities of this Markdown chunk.\n\nchunk_id: ", "\npage_hint: ", "\ntitle_path: ", "\n\ntext:\n", "\n")
_JUDGE = ("Check where the prediction puts attributes and relations differently from the reference.\n\ntext:\n", "\n\nreference:\n", "\n\nprediction:\n", "\n")
_QUESTION = ("Ask ", " practice questions about ", ", one per line, with no numbering, bullets or explanations.\n\n", ": ", "\n")
_SCORES = ("For each line below, how surely does it belong to the category ", "? Answer with one digit from 0 (not at all) to 9 (certainly) a line and nothing else.\n\n", "")


def _woven(parts: tuple[str, ...], values) -> str:
    return "".join(p + v for p, v in zip(parts, [*values, ""], strict=True))


def _woven_column(parts: tuple[str, ...], values: list[Column]) -> Column:
    return F.concat(*[c for p, v in zip(parts, [*values, F.lit("")], strict=True) for c in (F.lit(p), v)])


def extraction_prompt(chunk_id: str, page_hint: str, title_path: list[str], text: str) -> str:
    return _woven(_EXTRACTION, (chunk_id, page_hint, " > ".join(title_path), text))


def extraction_prompt_column(chunk_id="chunk_id", page_hint="page_hint", title_path="title_path", text="text") -> Column:
    return _woven_column(_EXTRACTION, [F.col(chunk_id), F.col(page_hint), F.concat_ws(" > ", F.col(title_path)), F.col(text)])


def judge_prompt(text: str, reference: str, prediction: str) -> str:
    return _woven(_JUDGE, (text, reference, prediction))


def judge_prompt_column(text: Column, reference: Column, prediction: Column) -> Column:
    return _woven_column(_JUDGE, [text, reference, prediction])


def question_prompt(category: str, count: int, description: str) -> str:
    return _woven(_QUESTION, (str(count), category, category, description))


def question_prompt_column(category="category", count="count", description="description") -> Column:
    return _woven_column(_QUESTION, [F.col(count).cast("string"), F.col(category), F.col(category), F.col(description)])


def judge_questions_prompt(category: str, questions: list[str]) -> str:
    """One score from 0 to 9 a line: how well each question fits its category."""
    return _woven(_SCORES, (category, "\n".join(questions)))
