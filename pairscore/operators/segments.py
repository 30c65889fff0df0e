"""Chunking of documents of any size by blocks of lines.

Where the chunk that opens at a line ends depends on what follows it only, so each block of lines can tell, before anything
is known of the blocks ahead of it, where the fold leaves it for every line at which it may be entered. Folds from
different entries soon meet at a common boundary, and later entries never leave earlier, so these are a few ranges of
entries with their exits. Page and titles are functions of what was in force before the block in the same way. A small
table of these per document is then walked in order, which gives each block its true entry, and the blocks are folded from
there, all at once. A block is joined by as many of the following lines as a chunk can have.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import heading_level, heading_title, page_hint
from ..schemas import CHUNK
from .chunking import MAX_CHARS, MIN_CHARS, fold_lines

BLOCK_LINES = 50_000
DEPTH = 6  # levels of headings
_EXITS = "doc_id string, block long, first long, exit long, page string, kept array<int>, titles array<array<string>>"
_ENTRIES = "doc_id string, block long, entry long, page string, titles array<string>"


def exits(sizes: np.ndarray, marks: np.ndarray, entries: int, end: int, min_chars: int, max_chars: int) -> list[tuple[int, int]]:
    """(first entry, exit) for ranges of entries from 0 up to ``entries``: where, from ``end`` on, the next chunk opens if one
    opens at the entry. ``sizes`` are the lengths of the lines, ``marks`` tells those that may close a chunk before them."""
    n = len(sizes)
    total = np.concatenate([[0], np.cumsum(sizes)]) + np.arange(n + 1)  # lines i .. j - 1 have total[j] - total[i] - 1 characters
    start = total[:-1] + 1
    full = np.minimum(np.searchsorted(total, start + max_chars), n)  # after the line that fills it
    places = np.append(np.flatnonzero(marks), n)
    able = np.maximum(np.searchsorted(total, start + min_chars), np.arange(n) + 1)
    marked = places[np.searchsorted(places, np.minimum(able, n))]
    leaves = np.minimum(full, marked).tolist()
    for i in range(min(end, n) - 1, -1, -1):
        if leaves[i] < end and leaves[i] < n:
            leaves[i] = leaves[leaves[i]]
    found: list[tuple[int, int]] = []
    for i in range(min(entries, end, n)):
        if not found or found[-1][1] != leaves[i]:
            found.append((i, leaves[i]))
    return found


def title_moves(headings: Iterable[tuple[int, str]]) -> tuple[list[int], list[list[str]]]:
    """For each number of titles in force before, 0 to DEPTH: how many of them stay, and the titles that follow those."""
    kept, own = list(range(DEPTH + 1)), [[] for _ in range(DEPTH + 1)]
    for level, title in headings:
        for n in range(DEPTH + 1):
            stays = min(kept[n], level - 1)
            own[n] = [*own[n][: level - 1 - kept[n]], title] if level - 1 > kept[n] else [title]
            kept[n] = stays
    return kept, own


def chunk_lines(lines: DataFrame, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Chunks of documents given as lines (doc_id, line_no from 0 without gaps, line), as schemas.CHUNK; the same as
    ``chunk_documents`` gives for the lines joined. No more than a block of lines and ``max_chars`` more are in one place.
    A block must be longer than that, else ValueError. Null lines are empty."""
    ahead = max_chars + 2
    if block_lines < ahead:
        raise ValueError(f"a block must have {ahead} lines or more")
    text = F.coalesce("line", F.lit(""))
    block, within = F.floor(F.col("line_no") / block_lines).cast("long"), F.col("line_no") % block_lines
    own = lines.select(F.col("doc_id").cast("string").alias("doc_id"), block.alias("block"), F.col("line_no").cast("long").alias("line_no"), text.alias("line"))
    more = own.where((within < ahead) & (F.col("block") > 0)).withColumn("block", F.col("block") - 1)
    placed = own.unionByName(more)
    told = placed.select("doc_id", "block", "line_no", F.length("line").alias("size"), page_hint(F.col("line")).alias("page"), heading_level(F.col("line")).alias("level"), F.when(heading_level(F.col("line")) > 0, heading_title(F.col("line"))).alias("title"))

    def leave(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("line_no")
        doc_id, number = pdf["doc_id"].iloc[0], int(pdf["block"].iloc[0])
        base, end = number * block_lines, int((pdf["line_no"] < (number + 1) * block_lines).sum())
        here = pdf[:end]
        pages = here["page"].dropna()
        headed = here[here["level"] > 0]
        kept, titles = title_moves(zip(headed["level"].tolist(), headed["title"]))
        marks = (pdf["page"].notna() | (pdf["level"] > 0)).to_numpy()
        found = exits(pdf["size"].to_numpy(dtype=np.int64), marks, 1 if number == 0 else ahead, end, min_chars, max_chars)
        page = pages.iloc[-1] if len(pages) else None
        # what holds for the block goes with its first range
        rows = [(doc_id, number, base + i, base + x, *((page, kept, titles) if not k else (None, None, None))) for k, (i, x) in enumerate(found)]
        return pd.DataFrame(rows, columns=["doc_id", "block", "first", "exit", "page", "kept", "titles"])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["block", "first"])
        entry, page, titles, rows = 0, "", [], []
        for number, block in pdf.groupby("block", sort=True):
            rows.append((block["doc_id"].iloc[0], number, entry, page, titles))
            entry = int(block["exit"].iloc[int(np.searchsorted(block["first"].to_numpy(), entry, side="right")) - 1])
            head = block.iloc[0]
            page = head["page"] or page
            n = len(titles)
            titles = [*titles[: head["kept"][n]], *head["titles"][n]]
        return pd.DataFrame(rows, columns=["doc_id", "block", "entry", "page", "titles"])

    def fold(key, pdf: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("line_no")
        base, at = int(key[1]) * block_lines, entered.iloc[0]
        found = fold_lines(pdf["line"].tolist(), min_chars, max_chars, at["page"], list(at["titles"]), int(at["entry"]) - base, block_lines)
        return pd.DataFrame([(key[0], int(key[1]), i, p, list(t), body) for i, (p, t, body) in enumerate(found, 1)], columns=["doc_id", "block", "n", "page", "titles", "text"])

    entries = told.groupBy("doc_id", "block").applyInPandas(leave, _EXITS).groupBy("doc_id").applyInPandas(walk, _ENTRIES)
    chunks = placed.groupBy("doc_id", "block").cogroup(entries.groupBy("doc_id", "block")).applyInPandas(fold, "doc_id string, block long, n long, page string, titles array<string>, text string")
    before = Window.partitionBy("doc_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = chunks.groupBy("doc_id", "block").agg(F.count("*").alias("count")).withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    numbered = chunks.join(counts.select("doc_id", "block", "before"), ["doc_id", "block"]).withColumn("chunk_idx", (F.col("before") + F.col("n")).cast("int"))
    name = F.format_string("chunk_%04d", "chunk_idx")
    given = {"doc_id": F.col("doc_id"), "chunk_idx": F.col("chunk_idx"), "chunk_id": name, "page_hint": F.when(F.col("page") == "", name).otherwise(F.col("page")), "title_path": F.col("titles"), "text": F.col("text")}
    return numbered.select(*[given[c.split(" ")[0]].alias(c.split(" ")[0]) for c in CHUNK.split(", ")])
