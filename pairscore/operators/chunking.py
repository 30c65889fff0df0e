"""Splitting Markdown documents into chunks that know their page and headings.

Chunk boundaries depend on a length that starts anew at each boundary, so they are a fold over a document's lines: it
runs in an Arrow function, document by document, with no shuffle; operators.segments folds documents that are too large for
that by blocks of lines. What is no fold (lines, page and heading tags, hard slices) is also there as column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.batches import by_bytes, record
from ..functions.text import HEADING_PATTERN, PAGE_PATTERNS, heading_level, heading_title, page_hint, split_lines, trim
from ..schemas import CHUNK

MIN_CHARS, MAX_CHARS = 1500, 3000
_PAGES = tuple(re.compile(p, re.I) for p in PAGE_PATTERNS)
_HEADING = re.compile(HEADING_PATTERN)
# Fixed value: what separates paragraphs.
_BLANK_RUN = re.compile(r"(\n\s*\n)")


def page_of(line: str) -> str | None:
    return next((m.group(1) for m in (p.match(line) for p in _PAGES) if m), None)


def fit(text: str, limit: int) -> list[str]:
    """A text in parts of at most ``limit`` characters: at blank lines if they serve, else sliced."""
    if len(text) <= limit:
        return [text]
    packed, room = [""], limit
    for piece in _BLANK_RUN.split(text):  # separators are pieces too
        if len(piece) > room and packed[-1].strip():
            packed.append("")
            room = limit
        packed[-1] += piece
        room -= len(piece)
    slices = (part[at : at + limit].strip() for part in map(str.strip, packed) for at in range(0, len(part), limit))
    return [s for s in slices if s]


@dataclass
class _Open:
    """The lines of the chunk being built; its page and titles are those at its first line."""

    lines: list[str] = field(default_factory=list)
    length: int = 0
    page: str = ""
    titles: list[str] = field(default_factory=list)

    def add(self, line: str) -> None:
        self.length += len(line) + (1 if self.lines else 0)
        self.lines.append(line)


def fold_lines(
    lines: Iterable[str], min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS, page: str = "", titles: Sequence[str] = (), first: int = 0, until: int | None = None,
) -> Iterator[tuple[str, list[str], str]]:
    """(page or "", title path, text) of each chunk.

    A page marker or a heading closes what is open if that has ``min_chars`` or more; a line that brings it to
    ``max_chars`` closes it after itself. A chunk opened before any page was known takes the page known when it closes.
    Headings replace all titles from their level down; skipped levels leave no gap.

    ``page`` and ``titles`` are those in force before the first line. Lines before ``first`` only change these; the fold
    ends where a chunk would open at line ``until`` or later.
    """
    titles, now = list(titles), _Open()

    def close() -> Iterator[tuple[str, list[str], str]]:
        body = "\n".join(now.lines).strip()
        for part in fit(body, max_chars) if body else []:
            yield now.page or page, now.titles, part

    for i, line in enumerate(lines):
        marked, heading = page_of(line), _HEADING.match(line)
        if marked:
            page = marked
            if now.length >= min_chars:
                yield from close()
                now = _Open()
        if heading:
            titles = [*titles[: len(heading.group(1)) - 1], heading.group(2).strip()]
            if now.length >= min_chars:
                yield from close()
                now = _Open()
        if i < first:
            continue
        if not now.lines:
            if until is not None and i >= until:
                return
            now.page, now.titles = page, titles
        now.add(line)
        if now.length >= max_chars:
            yield from close()
            now = _Open()
    yield from close()


def chunk_text(text: str, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Iterator[tuple[str, list[str], str]]:
    """The chunks of a whole text; see ``fold_lines``."""
    return fold_lines(text.splitlines(), min_chars, max_chars)


def chunk_documents(docs: DataFrame, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> DataFrame:
    """Chunks of ``docs`` (doc_id, text), as schemas.CHUNK. Ids count from 1 within a document; a chunk without a page
    bears its id as page hint. Null and blank texts have no chunks."""

    schema = to_arrow_schema(StructType.fromDDL(CHUNK))

    def run(batches):
        for part in by_bytes(batches, 1):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                for i, (page, titles, body) in enumerate(chunk_text(text or "", min_chars, max_chars), 1):
                    name = f"chunk_{i:04d}"
                    rows.append((doc_id, i, name, page or name, titles, body))
            if rows:
                yield record(zip(*rows), schema)

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, CHUNK)


def document_lines(docs: DataFrame, split: Callable[[Column], Column] = split_lines) -> DataFrame:
    """``doc_id, line_no, line``, from 0, as ``split`` cuts a text."""
    return docs.select("doc_id", F.posexplode(split(F.coalesce("text", F.lit("")))).alias("line_no", "line"))


def markdown_marks(line: Column) -> tuple[Column, Column, Column]:
    """What a line of Markdown changes: the page or null, the level of its title or 0, and the title."""
    return page_hint(line), heading_level(line), heading_title(line)


def tagged_lines(lines: DataFrame, marks: Callable[[Column], tuple[Column, Column, Column]] = markdown_marks, depth: int = 6, nested: bool = True) -> DataFrame:
    """Lines with the page and the titles in force, as ``marks`` reads them: the last page marker so far, and for each of
    ``depth`` levels the last title not yet closed by a heading of a higher level; titles that are not ``nested`` are closed
    by their own level only. Where levels are skipped, ``chunk_text`` decides instead."""
    # lines of one number, as of a repeated id, see each other's marks, whatever their order
    so_far = Window.partitionBy("doc_id").orderBy("line_no").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    marked, level, title = marks(F.col("line"))
    own = lines.withColumn("level", level).withColumn("page", F.last(marked, True).over(so_far))
    title = F.struct("line_no", title.alias("title"))
    levels = [F.last(F.when(F.col("level") == k, title), True).over(so_far).alias(f"t{k}") for k in range(1, depth + 1)]
    last = [F.lit(-1)] + [F.coalesce(F.col(f"t{k}.line_no"), F.lit(-1)) for k in range(1, depth + 1)]
    is_open = lambda k: F.col(f"t{k}.line_no") > F.greatest(F.lit(-1), *last[: k if nested else 1])
    open_titles = F.array(*[F.when(is_open(k), F.col(f"t{k}.title")) for k in range(1, depth + 1)])
    return own.select("*", *levels).select("doc_id", "line_no", "line", F.coalesce("page", F.lit("")).alias("page"), F.array_compact(open_titles).alias("title_path"))


def hard_slices(text: Column, limit: int = MAX_CHARS) -> Column:
    """A text sliced every ``limit`` characters, trimmed, without blank slices."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(limit))
    return F.filter(F.transform(starts, lambda i: trim(F.substring(text, i + 1, F.lit(limit)))), lambda x: x != "")
