"""Merging what one model found in a chunk: entities of the same name become one.

A chunk's entities are one list in one row, and all of it happens there: the list is sorted by the names' comparison form,
runs of one name are cut out as slices, each run becomes an entity, and these return to the order of their first ones.
Nothing is exploded, grouped or joined, so merging needs no exchange of its own; its work is that of the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fold_all, is_blank, plain_lists
from ..schemas import DEFAULT_TYPE, ENTITY

KEYS = ("doc_id", "chunk_idx")
PLACED = f"array<struct<pos:int,e:{ENTITY}>>"


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: an expression that lambdas mention is else put into them by the
    optimizer and computed again for each element. The value is what a fold over nothing starts from, which unlike the
    one element of an array gives the body's result without a copy of it."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda same, _: same, body)


def _sliced(all_: Column, sizes: list[Column]) -> list[Column]:
    """Consecutive slices of an array."""
    out, start = [], F.lit(1)
    for n in sizes:
        out.append(F.slice(all_, start, n))
        start = start + n
    return out


def runs(items: Column, key: str) -> Column:
    """A list of structs as a list of its runs, one for each value of the field ``key``, by that value. Within a run the
    order is the list's."""
    placed = F.transform(items, lambda x, i: F.struct(x[key].alias("k"), i.alias("i"), x.alias("x")))

    def cut(ordered: Column) -> Column:
        ordinal = F.transform(ordered, lambda _, i: i)
        begins = F.filter(ordinal, lambda i: (i == 0) | ~F.get(ordered, i)["k"].eqNullSafe(F.get(ordered, i - 1)["k"]))
        return bind(F.concat(begins, F.array(F.size(ordered))), lambda at: F.transform(
            F.slice(at, 1, F.size(at) - 1), lambda b, j: F.transform(F.slice(ordered, b + 1, F.get(at, j + 1) - b), lambda y: y["x"])))

    return bind(F.array_sort(placed), cut)


def _last_values(entries: Column) -> Column:
    """A map from a list of (key, value): of equal keys the last value, in the place of the first."""

    def last(all_: Column) -> Column:
        placed = F.transform(all_, lambda a, i: F.struct(a["key"].alias("key"), a["value"].alias("value"), i.alias("i")))
        ends = F.transform(runs(placed, "key"), lambda r: F.struct(F.get(r, F.lit(0))["i"].alias("i"), F.get(r, F.lit(0))["key"].alias("key"), F.element_at(r, -1)["value"].alias("value")))
        return bind(F.array_sort(ends), lambda e: F.map_from_arrays(e["key"], e["value"]))

    different = lambda all_: F.size(F.array_distinct(all_["key"])) == F.size(all_)
    return bind(entries, lambda all_: F.when(different(all_), F.map_from_arrays(all_["key"], all_["value"])).otherwise(last(all_)))


def with_merged(rows: DataFrame, column: str, name: str, exact: bool = True) -> DataFrame:
    """``rows`` with, as ``name``, the list of entities in ``column`` as a list of (pos, e): entities merged by the
    comparison form of their name, ``pos`` the place of the first one. A null list is as an empty one.

    Left out are entities with a blank name or no evidence, blank aliases, and attributes with a blank key or value. The
    first entity gives name and place; the type is the first that is not the default; aliases are the sorted union; of
    one attribute the last value counts; relations and evidence are appended, repeats too.
    """
    given = F.coalesce(F.col(column), F.array().cast(f"array<{ENTITY}>"))
    placed = F.transform(given, lambda e, i: F.struct(
        i.alias("pos"), e["name"].alias("name"), e["type"].alias("type"), F.filter(e["aliases"], lambda a: ~is_blank(a)).alias("aliases"),
        F.filter(F.map_entries(e["attributes"]), lambda a: ~is_blank(a["key"]) & ~is_blank(a["value"])).alias("entries"),
        e["relations"].alias("relations"), e["evidence"].alias("evidence")))
    own = "_usable_entities"
    told = rows.withColumn("_placed", placed).withColumn(own, F.filter("_placed", lambda x: ~is_blank(x["name"]) & (F.size(x["evidence"]) > 0)))
    # columns of their own, so that Python's arguments and what is made of its answers share them
    told = told.withColumn("_texts", F.transform(own, lambda x: F.concat(F.array(x["name"]), x["aliases"], x["entries"]["key"], x["entries"]["value"])))
    texts, keys = plain_lists(F.col("_texts"), exact), fold_all(F.col(own)["name"], exact)
    in_order = lambda found: F.array_sort(found, lambda a, b: a["pos"] - b["pos"])
    several = lambda clean: in_order(F.transform(runs(clean, "key"), _one))
    # most lists have no name twice: nothing is to be merged then
    different = lambda all_: F.size(F.array_distinct(all_["key"])) == F.size(all_)
    found = bind(F.arrays_zip(F.col(own).alias("x"), texts.alias("told"), keys.alias("key")), lambda all_: F.when(
        different(all_), F.transform(all_, lambda y: _alone(_clean(y)))).otherwise(several(F.transform(all_, _clean))))
    return told.withColumn(name, found.cast(PLACED)).drop("_placed", own, "_texts")


def _clean(y: Column) -> Column:
    """An entity with its strings as normalised, and the key it is merged by."""
    x, n = y["x"], F.size(y["x"]["entries"])
    name, aliases, names, values = _sliced(y["told"], [F.lit(1), F.size(x["aliases"]), n, n])
    return F.struct(
        y["key"].alias("key"), x["pos"].alias("pos"), F.get(name, F.lit(0)).alias("name"), x["type"].alias("type"), aliases.alias("aliases"),
        F.arrays_zip(names.alias("key"), values.alias("value")).alias("attributes"), x["relations"].alias("relations"), x["evidence"].alias("evidence"))


def _alone(x: Column) -> Column:
    """An entity whose name no other has."""
    entity = F.struct(
        x["name"].alias("name"), F.coalesce(x["type"], F.lit(DEFAULT_TYPE)).alias("type"), F.sort_array(F.array_distinct(x["aliases"])).alias("aliases"),
        _last_values(x["attributes"]).alias("attributes"), x["relations"].alias("relations"), x["evidence"].alias("evidence"))
    return F.struct(x["pos"].alias("pos"), entity.alias("e"))


def _one(run: Column) -> Column:
    """Entities of one name as one."""
    first, special = F.get(run, F.lit(0)), F.filter(run["type"], lambda t: t != DEFAULT_TYPE)
    entity = F.struct(
        first["name"].alias("name"), F.coalesce(F.get(special, F.lit(0)), F.lit(DEFAULT_TYPE)).alias("type"), F.sort_array(F.array_distinct(F.flatten(run["aliases"]))).alias("aliases"),
        _last_values(F.flatten(run["attributes"])).alias("attributes"), F.flatten(run["relations"]).alias("relations"), F.flatten(run["evidence"]).alias("evidence"))
    return F.struct(first["pos"].alias("pos"), entity.alias("e"))


def normalize_extractions(extractions: DataFrame, exact: bool = True) -> DataFrame:
    """Extractions with merged entities, row by row; a chunk that loses all keeps an empty list."""
    done = with_merged(extractions, "entities", "_merged_entities", exact)
    return done.withColumn("entities", F.transform("_merged_entities", lambda x: x["e"])).select(*extractions.columns)
