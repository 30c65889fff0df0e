from pyspark.sql import functions as F

from pairscore.functions import text as tx
from pairscore.operators.generate import question_rows


def one(spark, value, column, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(column.alias("x")).first().x


FOLDED = [(" P － 13 ", "p-13"), ("p—13", "p-13"), ("P–13", "p-13"), ("Ａ　Ｂ", "ab"), ("Straße", "strasse"), ("Ⅵ舱", "vi舱"), (None, ""), ("", ""), ("ẞß", "ssss")]
RELATIONS = [("装备", "equipped_with"), ("可携带", "equipped_with"), ("改装自", "modified_from"), ("改装为", "belongs_to"), ("为…型", "belongs_to"), ("Located In", "locatedin"), (None, "")]
PAGES = [("第 12 页", "12"), ("page: 12", "12"), ("<!-- page: 12 -->", "12"), ("--- 12 页 ---", "12"), ("# Page 12", "12"), ("第１２页", "１２"), ("see page 12 below", None), ("页码：7", "7"), ("12", None)]


def test_folding(spark):
    for value, want in FOLDED:
        assert tx.folded(value) == want
    got = spark.createDataFrame(FOLDED, "v string, want string").select(tx.normalize_text(F.col("v")).alias("x"), "want").collect()
    assert all(r.x == r.want for r in got)


def test_fast_path_agrees_on_ascii(spark):
    values = [("A b\tC",), (" x-Y ",), ("",), (None,), ("\x1cQ\x1f",)]
    for r in spark.createDataFrame(values, "v string").select(tx.normalize_text(F.col("v")).alias("a"), tx.normalize_text(F.col("v"), False).alias("b")).collect():
        assert r.a == r.b


def test_relations(spark):
    for value, want in RELATIONS:
        assert tx.relation_name(value) == want
    got = spark.createDataFrame(RELATIONS, "v string, want string").select(tx.normalize_relation(F.col("v")).alias("x"), tx.normalize_relation(F.col("v"), False).alias("y"), "want").collect()
    assert all(r.x == r.want for r in got)
    assert all(r.y == r.want for r in got if r.want)


def test_page_and_heading_columns(spark):
    got = spark.createDataFrame(PAGES, "v string, want string").select(tx.page_hint(F.col("v")).alias("x"), "want").collect()
    assert all(r.x == r.want for r in got)
    assert one(spark, "##  A b # ", tx.heading_title(F.col("v"))) == "A b #"
    assert one(spark, "##  A b # ", tx.heading_level(F.col("v"))) == 2
    assert one(spark, "##A", tx.heading_level(F.col("v"))) == 0


def test_lines_are_those_of_splitlines(spark):
    for value in ("", "a", "a\n", "a\n\n", "\n", "a\r\nb\rc\x0bd\x0ce\x1cf\x1dg\x1eh\x85i j k", "a\r\n"):
        assert one(spark, value, tx.split_lines(F.col("v"))) == value.splitlines()


def test_trim_takes_unicode_space(spark):
    assert one(spark, "　 \t a b\xa0\x1f", tx.trim(F.col("v"))) == "a b"


def test_question_lines(spark):
    rows = spark.createDataFrame([("c", "Q1\n\n  Q2 \n"), ("c", None), ("d", "Q1")], "category string, text string")
    assert sorted(map(tuple, question_rows(rows).collect())) == [("c", "Q1", 0), ("c", "Q2", 0), ("d", "Q1", 0)]
