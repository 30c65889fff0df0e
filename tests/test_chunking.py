from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pairscore.operators.chunking import chunk_documents, chunk_text, document_lines, fit, hard_slices, tagged_lines


def chunks(text, **sizes):
    return list(chunk_text(text, **sizes))


def test_blank_documents_have_none():
    assert chunks("") == chunks(" \n\t\n ") == []


def test_titles():
    path = lambda text: [t for _, t, _ in chunks(text, min_chars=1)]
    assert path("# A\n### X\n### Y\n") == [["A"], ["A", "X"], ["A", "X", "Y"]]
    assert path("# A\n## B\n# C\n") == [["A"], ["A", "B"], ["C"]]


def test_a_first_marker_names_the_page_of_what_was_open():
    long = "x" * 1600
    got = chunks(f"{long}\n第 3 页\nmore")
    assert [(p, len(t)) for p, _, t in got] == [("3", 1600), ("3", 10)]


def test_short_text_is_not_closed_by_a_heading():
    got = chunks("y" * 1400 + "\n# H\nrest")
    assert len(got) == 1 and "# H" in got[0][2]


def test_closed_after_the_line_that_fills_it():
    got = chunks("# H\n" + "\n".join(["z" * 999] * 4))
    assert [t.count("z") for _, _, t in got] == [2994, 3, 999]


def test_long_lines_and_blank_lines():
    assert [len(t) for _, _, t in chunks("q" * 7000)] == [3000, 3000, 1000]
    got = chunks("a" * 2000 + "\n\n" + "b" * 2000)
    assert [t[0] + str(len(t)) for _, _, t in got] == ["a2000", "b2000"]
    assert fit("a" * 10 + "\n \n" + "b" * 10, 15) == ["a" * 10, "b" * 10]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab #\n第1页 ", max_size=400))
def test_no_chunk_is_blank_or_too_long(text):
    for _, _, body in chunks(text, min_chars=20, max_chars=40):
        assert body.strip() == body and 0 < len(body) <= 40


def test_documents(spark):
    docs = spark.createDataFrame([("d", "abc"), ("e", None), ("f", "x" * 3500)], "doc_id string, text string")
    got = [(r.doc_id, r.chunk_idx, r.chunk_id, r.page_hint, r.title_path, len(r.text)) for r in chunk_documents(docs).orderBy("doc_id", "chunk_idx").collect()]
    assert got == [("d", 1, "chunk_0001", "chunk_0001", [], 3), ("f", 1, "chunk_0001", "chunk_0001", [], 3000), ("f", 2, "chunk_0002", "chunk_0002", [], 500)]


def test_tagged_lines_agree_with_the_fold(spark):
    text = "# A\nl1\n第 2 页\n## B\nl2\n# C\nl3"
    docs = spark.createDataFrame([("d", text)], "doc_id string, text string")
    got = [(r.line, r.page, r.title_path) for r in tagged_lines(document_lines(docs)).orderBy("line_no").collect()]
    assert got[4] == ("l2", "2", ["A", "B"]) and got[6] == ("l3", "2", ["C"]) and got[1] == ("l1", "", ["A"])


def test_hard_slices(spark):
    rows = spark.createDataFrame([("",), ("ab cd",), ("  ",)], "v string")
    assert [r.x for r in rows.select(hard_slices(F.col("v"), 3).alias("x")).collect()] == [[], ["ab", "cd"], []]
