"""Scoring one side's entities against a reference, chunk by chunk.

Both sides' lists meet in one row per chunk, by one join; all comparing is then done on the lists by higher-order
functions: two chunks never compare, and no pair leaves its row. Matching is greedy in list order, one to one: a fold over
the reference with the list of those taken as its state, or for long lists a queue of places for each key.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions.metrics import level_metrics
from ..functions.text import ascii_folded, ascii_relation_name, folded, relation_name
from ..schemas import ENTITY, ERROR, ERROR_TYPES, LEVELS
from .merge import KEYS, bind

_TEXTS = ArrayType(StringType())


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_ATTRIBUTE = _struct(key=StringType(), value=StringType(), n_key=StringType(), n_value=StringType())
_RELATION = _struct(relation=StringType(), target=StringType(), target_keys=_TEXTS)
#: An entity with its comparison forms. A type and no DDL, since workers read this module too.
PREPARED = _struct(name=StringType(), type=StringType(), n_type=StringType(), keys=_TEXTS, attributes=ArrayType(_ATTRIBUTE), relations=ArrayType(_RELATION))


#: Both sides of a chunk, and for each entity and relation of ``ref`` the place of its match in ``pred``, or -1.
PAIR = _struct(ref=ArrayType(PREPARED), pred=ArrayType(PREPARED), entity_match=ArrayType(IntegerType()), relation_match=ArrayType(IntegerType()))


def prepare(extractions: DataFrame, name: str, exact: bool = True, keys=KEYS) -> DataFrame:
    """``keys`` and, as ``name``, the list of prepared entities."""
    return extractions.select(*keys, prepared(F.col("entities"), exact).alias(name))


def prepared(entities: Column, exact: bool = True) -> Column:
    """A list of entities with their comparison forms. Nothing is exploded or shuffled: an Arrow function works on the
    lists of many rows at once, column by column, and each different string of these is folded once."""
    return (_prepared_exact if exact else _prepared_plainly)(*[entities[f] for f in ("name", "type", "aliases", "attributes", "relations")])


def prepared_pair(ref: Column, pred: Column, exact: bool = True) -> Column:
    """Two lists of entities, neither null, as a struct of PAIR: prepared as by ``prepared``, and matched as by ``greedy``
    while the keys are numbers."""
    fields = ("name", "type", "aliases", "attributes", "relations")
    return (_pair_exact if exact else _pair_plainly)(*[side[f] for side in (ref, pred) for f in fields])


def _parts(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Sizes of lists and all their elements."""
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    values = pa.StructArray.from_arrays([lists.keys, lists.items], ["key", "value"]) if isinstance(lists, pa.MapArray) else lists.values
    return np.diff(offsets), values[offsets[0] : offsets[-1]]


def _lists(sizes: np.ndarray, values: pa.Array, nulls: pa.Array | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values, mask=nulls)


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all elements of ranges, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _mapped(fn, strings: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """``fn`` of each string, called once for a string: a number for each and the results that these stand for."""
    told = pc.fill_null(strings, "").dictionary_encode()
    results = pa.array([fn(x) for x in told.dictionary.to_pylist()], pa.string()).dictionary_encode()
    return np.asarray(results.indices, dtype=np.int64)[np.asarray(told.indices)], results.dictionary


def _firsts(owner: np.ndarray, code: np.ndarray, n_codes: int) -> np.ndarray:
    """The places of the first of equal codes of an owner, in order."""
    return np.sort(np.unique(owner * n_codes + code, return_index=True)[1])


def _joint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Codes of pairs of codes."""
    return np.unique(a * (b.max(initial=0) + 1) + b, return_inverse=True)[1]


def _flat(name: pa.Array, type: pa.Array, aliases: pa.Array, attributes: pa.Array, relations: pa.Array) -> tuple[list[np.ndarray], list[pa.Array]]:
    """Many rows' entities as the sizes of their lists and all strings of a kind."""
    n_entities, names = _parts(name)
    kinds, (n_aliases, aliases), (n_attributes, attributes), (n_links, links) = _parts(type)[1], *(_parts(_parts(x)[1]) for x in (aliases, attributes, relations))
    return [n_entities, n_aliases, n_attributes, n_links], [names, kinds, aliases, attributes.field("key"), attributes.field("value"), links.field("relation"), links.field("target")]


@dataclass
class _Keyed:
    """Items of many rows, each with the keys (codes) it may be found by, in the order of rows and items."""

    row: np.ndarray  # of an item
    item: np.ndarray  # of a key
    code: np.ndarray  # of a key

    def split(self, row: int) -> tuple[_Keyed, _Keyed]:
        """The items of the rows before this one, and the others, numbered anew."""
        n, at = np.searchsorted(self.row, row), np.searchsorted(self.row[self.item], row)
        return _Keyed(self.row[:n], self.item[:at], self.code[:at]), _Keyed(self.row[n:] - row, self.item[at:] - n, self.code[at:])

    def keys(self, row: int) -> list[list[int]]:
        """The keys of a row's items, item by item."""
        first, end = np.searchsorted(self.row, (row, row + 1))
        ends = np.searchsorted(self.item, np.arange(first, end + 1))
        return [self.code[a:b].tolist() for a, b in zip(ends, ends[1:])]


def matched(left: _Keyed, right: _Keyed, n_rows: int) -> np.ndarray:
    """``first_free`` of many rows at once: for each item of ``left`` the place in its row of the item of ``right``, or -1.
    Of most rows no item shares a key with two others, so that all such pairs are matches; the rest is matched row by row."""
    n_codes = max(left.code.max(initial=0), right.code.max(initial=0)) + 1
    wanted, has = left.row[left.item] * n_codes + left.code, right.row[right.item] * n_codes + right.code
    order = np.argsort(has, kind="stable")
    low, high = (np.searchsorted(has[order], wanted, side) for side in ("left", "right"))
    n_pairs, row = high - low, left.row[left.item]
    # rows of a very common key have many more pairs than keys; these are never made
    odd = np.bincount(row, n_pairs, n_rows) > 4 * (np.bincount(row, minlength=n_rows) + np.bincount(right.row[right.item], minlength=n_rows))
    few = ~odd[row]
    a, b = np.repeat(left.item[few], n_pairs[few]), right.item[order[_places(low[few], n_pairs[few])]]
    a, b = np.divmod(np.unique(a * (len(right.row) + 1) + b), len(right.row) + 1)
    contested = (np.bincount(a, minlength=len(left.row))[a] > 1) | (np.bincount(b, minlength=len(right.row))[b] > 1)
    odd[left.row[a[contested]]] = True
    out, plain = np.full(len(left.row), -1), ~odd[left.row[a]]
    out[a[plain]] = b[plain] - np.searchsorted(right.row, right.row[b[plain]])
    for r in np.flatnonzero(odd):
        first, end = np.searchsorted(left.row, (r, r + 1))
        out[first:end] = first_free(left.keys(r), right.keys(r))
    return out


def _preparing(fold, relation_of):
    """The functions of ``prepared`` and ``prepared_pair`` with the forms that ``fold`` and ``relation_of`` give."""

    def forms_of(sizes: list[np.ndarray], strings: list[pa.Array], nulls: pa.Array | None = None) -> tuple[pa.Array, _Keyed, Callable[[], _Keyed]]:
        """The prepared lists, the entities by their keys, and what gives the relations by what makes them the same."""
        (n_entities, n_aliases, n_attributes, n_links), (names, kinds, aliases, key, value, verb, target) = sizes, strings
        n, row = len(names), np.repeat(np.arange(len(n_entities)), n_entities)
        given = pc.fill_null(pc.not_equal(target, ""), False)
        verb, target, subject = verb.filter(given), target.filter(given), np.repeat(np.arange(n), n_links)[np.asarray(given, dtype=bool)]
        strings = [kinds, names, aliases, key, value, target, pa.array([""], pa.string())]
        codes, forms = _mapped(fold, pa.concat_arrays(strings))
        kind, own, others, n_key, n_value, target, blank = np.split(codes, np.cumsum([len(x) for x in strings])[:-1])
        # an entity's keys are its name's form and its aliases', each once, without blank ones
        owner, code = np.repeat(np.arange(n), n_aliases + 1), np.empty(n + len(others), dtype=np.int64)
        first = np.cumsum(n_aliases + 1) - n_aliases - 1
        code[first], code[_places(first + 1, n_aliases)] = own, others
        owner, code = owner[code != blank], code[code != blank]
        kept = _firsts(owner, code, len(forms))
        owner, code = owner[kept], code[kept]
        n_keys = np.bincount(owner, minlength=n)
        first = np.cumsum(n_keys) - n_keys
        # a target's are itself and the keys of those entities of its row that have it; one step, not further
        has = row[owner] * len(forms) + code
        order, wanted = np.argsort(has, kind="stable"), row[subject] * len(forms) + target
        low, high = (np.searchsorted(has[order], wanted, side) for side in ("left", "right"))
        named = owner[order[_places(low, high - low)]]
        link = np.repeat(np.repeat(np.arange(len(target)), high - low), n_keys[named])
        link, keys = np.concatenate((np.arange(len(target)), link)), np.concatenate((target, code[_places(first[named], n_keys[named])]))
        link, keys = link[keys != blank], keys[keys != blank]
        by_link = np.argsort(link, kind="stable")
        link, keys = link[by_link], keys[by_link]
        kept = _firsts(link, keys, len(forms))
        link, keys = link[kept], keys[kept]
        verbs, verb_forms = _mapped(relation_of, verb)
        text = lambda of, codes: of.take(pa.array(codes))
        pairs = [key, value, text(forms, n_key), text(forms, n_value)]
        ends = [text(verb_forms, verbs), text(forms, target), _lists(np.bincount(link, minlength=len(target)), text(forms, keys))]
        fields = [
            names, kinds, text(forms, kind), _lists(n_keys, text(forms, code)),
            _lists(n_attributes, pa.StructArray.from_arrays(pairs, ["key", "value", "n_key", "n_value"])),
            _lists(np.bincount(subject, minlength=n), pa.StructArray.from_arrays(ends, ["relation", "target", "target_keys"]))]
        out = _lists(n_entities, pa.StructArray.from_arrays(fields, ["name", "type", "n_type", "keys", "attributes", "relations"]), nulls)

        def same_relations() -> _Keyed:
            # as relation_keys: all of the subject's keys with the relation's name and all of the target's keys
            each = n_keys[subject[link]]
            by = _joint(np.repeat(verbs[link], each), code[_places(first[subject[link]], each)])
            return _Keyed(row[subject], np.repeat(link, each), _joint(by, np.repeat(keys, each)))

        return out, _Keyed(row, owner, code), same_relations

    def prepare_lists(name: pa.Array, type: pa.Array, aliases: pa.Array, attributes: pa.Array, relations: pa.Array) -> pa.Array:
        return forms_of(*_flat(name, type, aliases, attributes, relations), name.is_null())[0]

    def prepare_pairs(
        name: pa.Array, type: pa.Array, aliases: pa.Array, attributes: pa.Array, relations: pa.Array,
        name_b: pa.Array, type_b: pa.Array, aliases_b: pa.Array, attributes_b: pa.Array, relations_b: pa.Array,
    ) -> pa.Array:
        # the other side's rows follow the first one's, so that both have the same codes
        (sizes, strings), (sizes_b, strings_b) = _flat(name, type, aliases, attributes, relations), _flat(name_b, type_b, aliases_b, attributes_b, relations_b)
        n = len(name)
        out, entities, links = forms_of([np.concatenate(x) for x in zip(sizes, sizes_b)], [pa.concat_arrays(x) for x in zip(strings, strings_b)])
        fields = [out[:n], out[n:]]
        for items in (entities, links()):
            left, right = items.split(n)
            fields.append(_lists(np.bincount(left.row, minlength=n), pa.array(matched(left, right, n), pa.int32())))
        return pa.StructArray.from_arrays(fields, PAIR.names)

    # nondeterministic as the functions of functions.text
    return tuple(F.arrow_udf(fn, kind).asNondeterministic() for fn, kind in ((prepare_lists, ArrayType(PREPARED)), (prepare_pairs, PAIR)))


(_prepared_exact, _pair_exact), (_prepared_plainly, _pair_plainly) = _preparing(folded, relation_name), _preparing(ascii_folded, ascii_relation_name)


#: Pairs of two lists up to which a fold in the JVM tries them; beyond, keys are looked up.
FOLD_PAIRS = 2_500


def first_free(left: list[list[str]], right: list[list[str]]) -> list[int]:
    """For each element of ``left``, in order, the place of the first element of ``right`` not yet taken that shares a key
    with it; -1 for none. Each key has a queue of the places that have it, from which taken ones are dropped as they come
    up, so the work is that of reading all keys once."""
    queues: dict[str, deque[int]] = {}
    for j, keys in enumerate(right):
        for key in keys:
            queues.setdefault(key, deque()).append(j)
    taken, out = bytearray(len(right)), []
    for keys in left:
        best = -1
        for key in keys:
            queue = queues.get(key)
            while queue and taken[queue[0]]:
                queue.popleft()
            if queue and (best < 0 or queue[0] < best):
                best = queue[0]
        if best >= 0:
            taken[best] = 1
        out.append(best)
    return out


@F.pandas_udf(ArrayType(IntegerType()))
def _first_free(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([None if a is None else first_free(a, b) for a, b in zip(left, right)], dtype=object)


_first_free = _first_free.asNondeterministic()  # as the functions of functions.text


def greedy(left: Column, right: Column, n_left: Column | None = None, n_right: Column | None = None) -> Column:
    """``first_free`` of two lists of key lists; ``n_left`` and ``n_right`` are their sizes, where these are known without
    making the lists. Short lists stay in the JVM, as a fold over the left one with the list of
    those taken as its state; long ones go to Python, where the work is linear."""
    n_left, n_right = (F.size(lists) if n is None else n for lists, n in ((left, n_left), (right, n_right)))
    few = n_left * n_right.cast("long") <= FOLD_PAIRS
    long = _first_free(F.when(~few, left), F.when(~few, right))

    def fold(rights: Column) -> Column:
        places = F.transform(rights, lambda _, j: j)

        def take(taken: Column, keys: Column) -> Column:
            free = F.filter(places, lambda j: ~F.array_contains(taken, j) & F.arrays_overlap(keys, F.get(rights, j)))
            return F.concat(taken, F.array(F.coalesce(F.try_element_at(free, F.lit(1)), F.lit(-1))))

        return F.aggregate(left, F.array().cast("array<int>"), take)

    return F.when(few, bind(right, fold)).otherwise(long)


def entity_keys(side: Column) -> Column:
    return F.transform(side, lambda e: e["keys"])


def relation_keys(links: Column) -> Column:
    """Of each relation all of its subject's keys with its name and all keys of its target: two relations are the same if they
    share one. The separator is white space, which no comparison form has."""
    of = lambda x: F.flatten(F.transform(x["keys"], lambda k: F.transform(x["target_keys"], lambda t: F.concat_ws("\x1f", x["relation"], k, t))))
    return F.transform(links, of)


def match_lists(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``entity_match``: for each entity of ``ref``, in order, its place in ``pred``, or -1."""
    return pairs.withColumn("entity_match", greedy(entity_keys(F.col("ref")), entity_keys(F.col("pred")), F.size("ref"), F.size("pred")))


def _errors(kind: str, items: Column, *fields) -> Column:
    """Error rows from a list; ``fields`` are pairs of a name and a function of the item."""
    payload = lambda x: F.create_map(*[c for name, get in fields for c in (F.lit(name), get(x))])
    return F.transform(items, lambda x, i: F.struct(F.lit(kind).alias("error_type"), i.alias("seq"), payload(x).alias("payload")))


def _links(side: Column) -> Column:
    """All relations of a side with their subject's keys, in order."""
    of = lambda e: lambda r: F.struct(e["name"].alias("subject"), e["keys"].alias("keys"), r["relation"].alias("relation"), r["target"].alias("target"), r["target_keys"].alias("target_keys"))
    return F.flatten(F.transform(side, lambda e: F.transform(e["relations"], of(e))))


def _pairs(ref: Column, pred: Column, match: Column) -> Column:
    """The matched pairs: i (the reference's place), r and p."""
    all_ = F.transform(ref, lambda r, i: F.struct(i.alias("i"), r.alias("r"), F.get(pred, F.get(match, i)).alias("p"), (F.get(match, i) >= 0).alias("met")))
    return F.filter(all_, lambda x: x["met"])


def _asked(pairs: Column) -> Column:
    """The reference's attributes in matched pairs, with what the other side has: ``found`` by the comparison form of the
    name, the last one if several; ``raw`` by the name as written, or empty."""
    by_key = lambda p, a: F.try_element_at(F.filter(p["attributes"], lambda b: b["n_key"] == a["n_key"]), F.lit(-1))["n_value"]
    by_name = lambda p, a: F.coalesce(F.try_element_at(F.filter(p["attributes"], lambda b: b["key"] == a["key"]), F.lit(1))["value"], F.lit(""))
    one = lambda x: lambda a: F.struct(
        x["r"]["name"].alias("entity"), a["key"].alias("key"), a["value"].alias("value"), a["n_value"].alias("n_value"),
        by_key(x["p"], a).alias("found"), by_name(x["p"], a).alias("raw"))
    return F.flatten(F.transform(pairs, lambda x: F.transform(x["r"]["attributes"], one(x))))


def _more(pairs: Column, ref: Column) -> Column:
    """The other side's attributes that the reference lacks, with the first other reference entity that has the value."""
    lacking = lambda x: F.filter(x["p"]["attributes"], lambda a: ~F.exists(x["r"]["attributes"], lambda b: b["n_key"] == a["n_key"]))
    has = lambda a: lambda o, j: F.struct(j.alias("j"), o["name"].alias("name"), F.exists(o["attributes"], lambda b: b["n_value"] == a["n_value"]).alias("has"))
    owner = lambda x, a: F.try_element_at(F.filter(F.transform(ref, has(a)), lambda o: o["has"] & (o["j"] != x["i"])), F.lit(1))["name"]
    one = lambda x: lambda a: F.struct(x["p"]["name"].alias("entity"), a["key"].alias("key"), a["value"].alias("value"), owner(x, a).alias("owner"))
    return F.flatten(F.transform(pairs, lambda x: F.transform(lacking(x), one(x))))


def _where(items: Column, condition) -> Column:
    """The elements of which a condition on element and place holds."""
    return F.transform(F.filter(F.transform(items, lambda x, i: F.struct(x.alias("x"), condition(x, i).alias("kept"))), lambda y: y["kept"]), lambda y: y["x"])


def _except(items: Column, places: Column) -> Column:
    """The elements whose places are not among these."""
    others = F.array_except(F.transform(items, lambda _, j: j), places)
    return F.transform(others, lambda j: F.get(items, j))


def _result(ref: Column, pred: Column, entity_match: Column, ref_links: Column, pred_links: Column, relation_match: Column, pairs: Column, asked: Column, more: Column) -> Column:
    n = lambda c: F.size(c).cast("bigint")
    met = lambda c: n(F.filter(c, lambda j: j >= 0))
    counts = lambda tp, fp, fn: F.struct(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    missing, wrong = F.filter(asked, lambda a: a["found"].isNull()), F.filter(asked, lambda a: a["found"] != a["n_value"])
    equal = n(F.filter(asked, lambda a: a["found"] == a["n_value"]))
    field = lambda name, of=None: (name, lambda x: x[of or name])
    errors = F.concat(
        _errors("missing_entity", _where(ref, lambda _, i: F.get(entity_match, i) < 0), field("name"), field("type")),
        _errors("extra_entity", _except(pred, entity_match), field("name"), field("type")),
        _errors("wrong_type", F.filter(pairs, lambda x: x["r"]["n_type"] != x["p"]["n_type"]), ("name", lambda x: x["r"]["name"]), ("reference_type", lambda x: x["r"]["type"]), ("prediction_type", lambda x: x["p"]["type"])),
        _errors("missing_attribute", missing, field("entity"), field("attribute", "key"), field("value")),
        _errors("wrong_attribute_value", wrong, field("entity"), field("attribute", "key"), field("reference_value", "value"), field("prediction_value", "raw")),
        _errors("wrong_relation", _where(ref_links, lambda _, i: F.get(relation_match, i) < 0), field("subject"), field("relation"), field("target")),
        _errors("wrong_attachment", F.filter(more, lambda a: a["owner"].isNotNull()), field("predicted_entity", "entity"), field("attribute", "key"), field("value"), field("likely_entity", "owner")),
    )
    return F.struct(
        counts(met(entity_match), n(pred) - met(entity_match), n(ref) - met(entity_match)).alias("entity"),
        counts(equal, n(wrong) + n(more), n(missing) + n(wrong)).alias("attribute"),
        counts(met(relation_match), n(pred_links) - met(relation_match), n(ref_links) - met(relation_match)).alias("relation"),
        errors.cast(f"array<{ERROR}>").alias("errors"),
    )


def score_lists(pairs: DataFrame) -> DataFrame:
    """``pairs`` has the columns ``ref`` and ``pred``, lists of prepared entities. Adds ``entity_match`` and
    ``relation_match`` (the places taken; where ``pairs`` has both, as from ``prepared_pair``, they stay), ``entity``, ``attribute`` and ``relation`` (counts) and ``errors``.

    A different type is an error but still a match. Attributes count inside matched pairs only: equal values are true
    positives, a missing one is a false negative, a different one both, one more on the other side a false positive.
    Relations match when their subjects share a key, their canonical names agree and their targets share a key.
    """
    known = {"entity_match", "relation_match"} <= set(pairs.columns)
    told = (pairs if known else match_lists(pairs)).withColumn("_ref_links", _links(F.col("ref"))).withColumn("_pred_links", _links(F.col("pred")))
    if not known:
        told = told.withColumn("relation_match", greedy(relation_keys(F.col("_ref_links")), relation_keys(F.col("_pred_links")), F.size("_ref_links"), F.size("_pred_links")))
    ref, pred, em = F.col("ref"), F.col("pred"), F.col("entity_match")
    result = bind(_pairs(ref, pred, em), lambda ps: bind(_asked(ps), lambda asked: bind(_more(ps, ref), lambda more: _result(
        ref, pred, em, F.col("_ref_links"), F.col("_pred_links"), F.col("relation_match"), ps, asked, more))))
    return told.withColumn("result", result).select(*dict.fromkeys([*pairs.columns, "entity_match", "relation_match"]), "result.*")


def choose_reference(b: DataFrame, a: DataFrame, gold: DataFrame | None = None, keys=KEYS) -> DataFrame:
    """The chunks of ``b`` with ``ref_entities``: the gold list where a chunk has one that is not empty, else the list
    of ``a``, else none. ``reference_source`` is "gold" for all chunks once there is any gold record;
    ``reference_actual`` tells it row by row. A chunk that is repeated on either side, or in gold, counts once: of its rows
    the one with the largest ``seq`` (``line_no`` in gold), where there is such a column.

    A chunk_id is unique within a document only, so gold records belong to (doc_id, chunk_id). Those without a doc_id are
    for the only document of ``b``; with several documents they raise ValueError."""
    nothing = F.array().cast(f"array<{ENTITY}>")
    of_a = _last(a, keys).select(*keys, F.col("entities").alias("a_entities"))
    out = _last(b, keys).join(of_a, list(keys), "left")
    if gold is None:
        return out.withColumn("ref_entities", F.coalesce("a_entities", nothing)).withColumn("reference_source", F.lit("model_a_pseudo_gold")).withColumn("reference_actual", F.lit("model_a")).drop("a_entities")
    known = _last(_keyed(gold, b), ("doc_id", "chunk_id")).select(F.col("doc_id").alias("_doc"), F.col("chunk_id").alias("_chunk"), F.col("entities").alias("gold_entities"))
    has = F.size(F.coalesce("gold_entities", nothing)) > 0
    any_gold = gold.limit(1).count() > 0  # at most one record is read; the label depends on no more
    out = out.join(known, (F.col("doc_id").cast("string") == F.col("_doc")) & (F.col("chunk_id") == F.col("_chunk")), "left").drop("_doc", "_chunk")
    out = out.withColumn("ref_entities", F.when(has, F.col("gold_entities")).otherwise(F.coalesce("a_entities", nothing)))
    return out.withColumn("reference_source", F.lit("gold" if any_gold else "model_a_pseudo_gold")).withColumn("reference_actual", F.when(has, "gold").otherwise("model_a")).drop("a_entities", "gold_entities")


def _keyed(gold: DataFrame, b: DataFrame) -> DataFrame:
    """Gold records with the documents they belong to, as text."""
    own = F.col("doc_id").cast("string") if "doc_id" in gold.columns else F.lit(None).cast("string")
    gold = gold.withColumn("doc_id", own)
    if gold.where(F.col("doc_id").isNull()).limit(1).count() == 0:
        return gold
    documents = [r[0] for r in b.select(F.col("doc_id").cast("string")).distinct().limit(2).collect()]
    if len(documents) > 1:
        raise ValueError("gold records without a doc_id cannot be told apart with several documents")
    return gold.withColumn("doc_id", F.coalesce("doc_id", F.lit(documents[0] if documents else None)))


def _last(rows: DataFrame, keys) -> DataFrame:
    """One row per key, the last one: that of the largest ``seq`` or ``line_no``, where the table has such a column; among
    equals, and without one, the choice is by the list's hash. It needs no exchange or sort besides the following join's."""
    said = F.transform("entities", lambda e: F.struct(e["name"], e["type"], e["aliases"], F.map_entries(e["attributes"]), e["relations"], e["evidence"]))
    order = [F.col(c).desc_nulls_last() for c in ("seq", "line_no") if c in rows.columns]
    latest = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(said))
    return rows.withColumn("_nth", F.row_number().over(latest)).where("_nth = 1").drop("_nth")


def evaluate_pairs(b: DataFrame, a: DataFrame, gold: DataFrame | None = None, exact: bool = True, keys=KEYS) -> DataFrame:
    """One row per chunk of ``b``: ``keys, chunk_id, reference_source, entity, attribute, relation, errors`` and the nine
    metrics. Both sides are normalised extractions."""
    chosen = choose_reference(b, a, gold, keys)
    base = list(dict.fromkeys([*keys, "chunk_id", "reference_source", "reference_actual"]))
    nothing = F.array().cast(f"array<{ENTITY}>")
    both = prepared_pair(*[F.coalesce(side, nothing) for side in ("ref_entities", "entities")], exact)
    scored = score_lists(chosen.select(*base, both.alias("_both")).select(*base, "_both.*"))
    metrics = [m for level in LEVELS for m in level_metrics(level, F.col(level))]
    return scored.select(*base, *LEVELS, "errors", *metrics)


def error_rows(evaluated: DataFrame, keys=KEYS) -> DataFrame:
    """The errors, one a row: ``keys, chunk_id, error_type, seq, payload``."""
    # the inner form would add a filter by the list's size, which scores a second time
    return evaluated.select(*dict.fromkeys([*keys, "chunk_id"]), F.explode_outer("errors").alias("x")).where("x is not null").select(*dict.fromkeys([*keys, "chunk_id"]), "x.error_type", "x.seq", "x.payload")


def errors_by_kind(errors: Column) -> Column:
    """A chunk's errors as a struct of lists, one a kind, in report order."""
    of = lambda kind: lambda x: x["error_type"] == kind
    return F.struct(*[F.transform(F.filter(errors, of(k)), lambda x: x["payload"]).alias(k) for k in ERROR_TYPES])
