"""Chunking by blocks of lines against the plain fold."""

import random

import numpy as np
import pytest

from pairscore.operators.chunking import chunk_documents, fit, fold_lines
from pairscore.operators.segments import chunk_lines, exits, title_moves


def made(rnd, n):
    """Lines of all kinds: blank ones, long ones, headings that skip levels, page markers of all forms."""
    kinds = [
        lambda: "", lambda: "", lambda: "x" * rnd.randrange(1, 30), lambda: "word " * rnd.randrange(1, 40), lambda: "#" * rnd.randrange(1, 8) + f" T{rnd.randrange(99)} ",
        lambda: f"第 {rnd.randrange(99)} 页", lambda: f"--- {rnd.randrange(99)} 页 ---", lambda: f"# Page {rnd.randrange(99)}", lambda: "  ",
    ]
    weights = [rnd.random() for _ in kinds]
    return [rnd.choices(kinds, weights)[0]() for _ in range(n)]


def rows(df):
    return sorted((r.doc_id, r.chunk_idx, r.chunk_id, r.page_hint, tuple(r.title_path), r.text) for r in df.collect())


@pytest.mark.parametrize(("low", "high", "block"), [(15, 40, 42), (0, 25, 60), (30, 30, 45), (15, 40, 10_000)])
def test_blocks_give_the_chunks_of_the_whole(spark, low, high, block):
    rnd = random.Random(high + block)
    docs = {f"d{i}": made(rnd, rnd.choice([0, 1, 41, 42, 43, 84, 300, 700])) for i in range(14)}
    docs["blank"], docs["long"] = [""] * 400, ["y" * 500] * 130
    lines = spark.createDataFrame([(d, i, x) for d, own in docs.items() for i, x in enumerate(own)], "doc_id string, line_no int, line string")
    whole = spark.createDataFrame([(d, "\n".join(own) + "\n") for d, own in docs.items()], "doc_id string, text string")
    assert rows(chunk_lines(lines.repartition(5), low, high, block)) == rows(chunk_documents(whole, low, high))


def test_a_block_is_no_shorter_than_a_chunk(spark):
    with pytest.raises(ValueError, match="3002"):
        chunk_lines(spark.createDataFrame([], "doc_id string, line_no int, line string"), block_lines=3_001)
    assert chunk_lines(spark.createDataFrame([], "doc_id string, line_no int, line string")).collect() == []


def test_folds_from_different_entries_meet():
    rnd = random.Random(3)
    sizes, marks = np.array([rnd.randrange(0, 60) for _ in range(5_000)]), np.array([rnd.random() < 0.05 for _ in range(5_000)])
    found = exits(sizes, marks, 302, 4_500, 150, 300)
    assert len(found) <= 3 and found[0][0] == 0 and all(4_500 <= x < 5_000 for _, x in found)


def test_title_moves():
    rnd = random.Random(4)
    for _ in range(300):
        headings = [(rnd.randrange(1, 7), f"t{i}") for i in range(rnd.randrange(0, 6))]
        before = [f"b{i}" for i in range(rnd.randrange(0, 7))]
        titles = before
        for level, title in headings:
            titles = [*titles[: level - 1], title]
        kept, own = title_moves(headings)
        assert [*before[: kept[len(before)]], *own[len(before)]] == titles


def test_packing_at_blank_lines():
    assert fit("a" * 20 + "\n\n" + "b" * 20, 30) == ["a" * 20, "b" * 20]
    assert [t for _, _, t in fold_lines(["a" * 20, "", "b" * 30], 10, 40)] == ["a" * 20, "b" * 30]
