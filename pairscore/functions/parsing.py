"""Reading a model's answer: the JSON object in it, and strictly validated entities."""

import json
from typing import Any

import pandas as pd
from pyspark.sql import Column, functions as F

from ..schemas import DEFAULT_TYPE, ENTITY

# What fences a part of an answer, and the language it may be marked with.
_FENCE, _LANGUAGE = "```", "json"


def fenced(text: str) -> list[str]:
    """The parts between an opening fence and the next one, without the language they are marked with."""
    parts = text.split(_FENCE)
    closed = parts[1 : len(parts) - 1 : 2]
    return [p[len(_LANGUAGE) :] if p[: len(_LANGUAGE)].lower() == _LANGUAGE else p for p in closed]


def find_object(text: str | None) -> tuple[dict[str, Any] | None, str | None]:
    """The first JSON object of: the whole answer, its fenced parts, the span from the first to the last brace. A list
    counts as an object's entities. Else nothing and the reason."""
    if not text:
        return None, "empty response"
    tries = [text, *fenced(text)]
    opening, closing = text.find("{"), text.rfind("}")
    if 0 <= opening < closing:
        tries.append(text[opening : closing + 1])
    for part in tries:
        try:
            value = json.loads(part.strip())
        except json.JSONDecodeError:
            continue
        if isinstance(value, list):
            return {"entities": value}, None
        if isinstance(value, dict):
            return value, None
    return None, "failed to parse JSON object"


def _records(items: Any, *fields: str) -> list[dict[str, str]] | None:
    """A list of objects whose fields, if given, are strings; None if it is no such list."""
    if not isinstance(items, list):
        return None
    out = []
    for item in items:
        if not isinstance(item, dict) or any(not isinstance(item.get(f, ""), str) for f in fields):
            return None
        out.append({f: item.get(f, "") for f in fields})
    return out


def valid_entity(item: dict[str, Any]) -> dict[str, Any] | None:
    """The entity as a record of the schema, or None where any part has another type than asked for. Missing optional
    parts take their defaults, unknown ones are ignored; nothing is coerced."""
    name, kind = item.get("name", ""), item.get("type", DEFAULT_TYPE)
    aliases, attributes = item.get("aliases", []), item.get("attributes", {})
    if not isinstance(name, str) or not isinstance(kind, str):
        return None
    if not isinstance(aliases, list) or not all(isinstance(a, str) for a in aliases):
        return None
    if not isinstance(attributes, dict) or not all(isinstance(v, str) for v in attributes.values()):
        return None
    relations, evidence = _records(item.get("relations", []), "relation", "target"), _records(item.get("evidence", []), "page", "text")
    if relations is None or evidence is None:
        return None
    return {"name": name, "type": kind, "aliases": aliases, "attributes": attributes, "relations": relations, "evidence": evidence}


def parse_answer(text: str | None) -> tuple[list[dict[str, Any]], str | None]:
    """Entities and error of an answer. Items that are no objects, and invalid entities, are left out one by one."""
    found, error = find_object(text)
    if found is None:
        return [], error
    items = found.get("entities", [])
    if not hasattr(items, "__iter__"):
        return [], f"TypeError: {type(items).__name__!r} object is not iterable"
    kept = (valid_entity(i) for i in items if isinstance(i, dict))
    return [e for e in kept if e is not None], None


def _parsed(values: pd.Series) -> pd.DataFrame:
    rows = [parse_answer(v) for v in values]
    return pd.DataFrame({"entities": [found for found, _ in rows], "error": [error for _, error in rows]})


def parse_response(raw: Column) -> Column:
    """Struct (entities, error) of a raw answer."""
    return F.pandas_udf(_parsed, f"struct<entities:array<{ENTITY}>,error:string>")(raw)
