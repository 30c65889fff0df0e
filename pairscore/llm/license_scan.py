"""License scans by an exact set-similarity join (DataFrame functions only).

Templates are word sequences, from one line to a whole licence, each with the share of its distinct words that must stand
close together (the threshold): within as many words as the template would have if only that share of its text were the
template's, its reach. A text is cut into overlapping blocks of twice a step, one every step, a step being at least the
reach, so that any such stretch lies whole in a block. Words are ordered by how many documents of the corpus have them,
rarest first, and only blocks around a prefix word are looked at:

* prefix filter: a match must hold one of a template's ``size - ceil(threshold * size) + 1`` rarest words;
* length filter: a block with fewer distinct template words than the threshold asks for cannot match;
* positional filter: when the rarest shared word is the template's k-th (from 0), at most ``size - k`` can be shared.

What passes is verified: the densest stretch of the block is found, and its words are counted. Base phrases are places
where a phrase's words stand in sequence; they are found around each phrase's rarest word. Texts and templates meet in
the text's own row, so nothing but the corpus counts is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.merge import bind
from .common import ascii_lower

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Usual notices, passages and whole texts of public licences, with SPDX-like labels and thresholds; short ones
# differ from each other by single words, so all of theirs are asked for.
TEMPLATES = (
    ("gpl-3.0-notice", 0.8, "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", 0.8, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl-notice", 0.8, "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl-notice", 0.8, "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache-2.0-notice", 1.0, "licensed under the apache license version 2 0"),
    ("apache-2.0-terms", 0.8, "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit-notice", 1.0, "released under the mit license"),
    ("mit-terms", 0.8, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd-terms", 0.8, "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc-terms", 0.8, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0-notice", 0.8, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-notice", 1.0, "made available under the terms of the eclipse public license"),
    ("cc-by-notice", 0.8, "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-notice", 1.0, "licensed under cc by nc 4 0"),
    ("cc-by-sa-notice", 1.0, "licensed under cc by sa 4 0"),
    ("cc0-notice", 0.8, "to the extent possible under law the author has waived all copyright and related rights"),
    ("unlicense-terms", 0.8, "this is free and unencumbered software released into the public domain"),
    ("mit-text", 0.8,
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in "
     "the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of "
     "the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this "
     "permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind "
     "express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event "
     "shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising "
     "from out of or in connection with the software or the use or other dealings in the software"),
    ("isc-text", 0.8,
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright "
     "notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this "
     "software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or "
     "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other "
     "tortious action arising out of or in connection with the use or performance of this software"),
    ("bsd-2-clause-text", 0.8,
     "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 "
     "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary "
     "form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials "
     "provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties "
     "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the "
     "copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to "
     "procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether "
     "in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the "
     "possibility of such damage"),
)
#: The least step from block to block.
STEP = 8
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _NOT_WORD), lambda w: w != "")


def reach_of(words: list[str], share: float) -> int:
    """The words within which that share of a template's must stand."""
    return math.ceil(len(words) / share - 1e-9)


def step_of(reach: int) -> int:
    """STEP, doubled until the reach fits."""
    step = STEP
    while step < reach:
        step *= 2
    return step


def _corpus_counts(lists: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How many texts of the whole corpus have each template word; one row a word comes to the driver, so its size is that
    of the templates. Only template words leave their row."""
    held = F.array_intersect("words", F.array(*map(F.lit, vocabulary)))
    found = lists.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in found.collect()}


def license_scan(docs: DataFrame, templates=TEMPLATES, base=None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places``.

    ``templates`` are triples of label, threshold and words. ``places`` lists what was found as structs (label, start, length
    in words, score), sorted: each base phrase, and of each template the densest stretch of every block that has one.
    ``score`` is the best of them, 0.0 for none. Null texts count as empty and give empty labels. Rows are scanned each for
    itself, whatever their ids; other columns are ignored; an empty table gives an empty result. No text is cut short and
    no place is dropped.
    """
    base = BASE if base is None else base
    lists = docs.select("doc_id", words(F.col("text")).alias("words"))
    vocabulary = sorted({w for text in [*base, *(t for _, _, t in templates)] for w in text.split()})
    seen = _corpus_counts(lists, vocabulary)
    rank = lambda w: (seen.get(w, 0), w)
    phrases, rules, rare = [], [], set()
    for phrase, label in base.items():
        ws = phrase.split()
        first = min(ws, key=rank)
        rare.add(first)
        phrases.append(F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, ws)).alias("sequence"), F.lit(first).alias("rarest"), F.lit(ws.index(first)).alias("offset")))
    for label, share, text in templates:
        ws = text.split()
        own = sorted(set(ws), key=rank)
        need, reach = math.ceil(share * len(own) - 1e-9), reach_of(ws, share)
        prefix = own[: len(own) - need + 1]
        rare.update(prefix)
        rules.append(F.struct(
            F.lit(label).alias("label"), F.array(*map(F.lit, own)).alias("own"), F.array(*map(F.lit, prefix)).alias("prefix"),
            F.lit(need).alias("need"), F.lit(reach).alias("reach"), F.lit(step_of(reach)).alias("step")))
    none = F.array().cast(_PLACES)
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(sorted(rare)))
    all_ = lambda kinds, of: F.flatten(F.transform(F.array(*kinds), of)).cast(_PLACES) if kinds else none
    found = bind(hits, lambda at: F.concat(all_(phrases, lambda p: _phrase_places(at, p)), all_(rules, lambda r: _template_places(at, r))))
    # only texts with a prefix word are scanned
    places = F.when(F.arrays_overlap("words", F.array(*map(F.lit, sorted(rare)))), F.array_sort(F.array_distinct(found))).otherwise(none) if rare else none
    told = lists.select("doc_id", F.size("words").cast("long").alias("n_words"), places.alias("places"))
    out = told.withColumn("own", F.filter("places", lambda p: p["base"]))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.col(f"{c}.label"))), ",")
    return out.select(
        "doc_id", "n_words", F.size("own").cast("long").alias("n_base"),
        F.array_min("own.start").alias("first_word"), F.array_max("own.start").alias("last_word"),
        labels("own").alias("base_labels"), labels("places").alias("labels"),
        F.coalesce(F.array_max("places.score"), F.lit(0.0)).alias("score"),
        F.transform("places", lambda p: F.struct(p["label"].alias("label"), p["start"].alias("start"), p["length"].alias("length"), p["score"].alias("score"))).alias("places"),
    )


_PLACES = "array<struct<base:boolean,label:string,start:bigint,length:int,score:double>>"


def _place(base: bool, label: Column, start: Column, length: Column, score: Column) -> Column:
    return F.struct(F.lit(base).alias("base"), label.alias("label"), start.cast("long").alias("start"), length.alias("length"), score.alias("score"))


def _phrase_places(hits: Column, p: Column) -> Column:
    """The places of a phrase, from where its rarest word stands."""
    starts = F.transform(F.filter(hits, lambda h: h["w"] == p["rarest"]), lambda h: h["i"] - p["offset"])
    met = F.filter(starts, lambda s: (s >= 0) & (F.slice("words", F.greatest(s, F.lit(0)) + 1, F.size(p["sequence"])) == p["sequence"]))
    return F.transform(met, lambda s: _place(True, p["label"], s, F.size(p["sequence"]), F.lit(1.0)))


def _template_places(hits: Column, r: Column) -> Column:
    """The densest stretch of each block around a prefix word that passes the filters and the threshold."""
    near = F.filter(hits, lambda h: F.array_contains(r["prefix"], h["w"]))
    block = lambda h: F.floor(h["i"] / r["step"]).cast("int")
    blocks = F.filter(F.array_distinct(F.flatten(F.transform(near, lambda h: F.array(block(h) - 1, block(h))))), lambda b: b >= 0)

    def of_block(b: Column) -> Column:
        start = b * r["step"]
        ws = F.slice("words", start + 1, 2 * r["step"])

        def filtered(had: Column) -> Column:
            can = F.size(r["own"]) - (F.array_position(r["own"], F.get(had, F.lit(0))) - 1)
            return F.when((F.size(had) >= r["need"]) & (can >= r["need"]), bind(ws, densest))

        def densest(own: Column) -> Column:
            held = F.filter(F.transform(own, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: F.array_contains(r["own"], x["w"]))
            return bind(held, lambda all_: F.array_max(F.transform(all_, lambda x: F.struct(
                F.size(F.array_distinct(F.filter(all_, lambda y: (y["i"] >= x["i"]) & (y["i"] < x["i"] + r["reach"]))["w"])).alias("n"), (-(start + x["i"])).alias("at")))))

        return bind(F.array_intersect(r["own"], ws), filtered)

    found = F.filter(F.transform(blocks, of_block), lambda x: x.isNotNull() & (x["n"] >= r["need"]))
    return F.transform(found, lambda x: _place(False, r["label"], -x["at"], r["reach"], (x["n"] / F.size(r["own"])).cast("double")))
