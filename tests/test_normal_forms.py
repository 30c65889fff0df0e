"""What stays in the JVM agrees with Python's tables, over every character that may stay there."""

import re

from pyspark.sql import functions as F

from pairscore.functions import text as tx


def simple_characters():
    pattern = re.compile(tx.SIMPLE.replace("*+", "*").replace("\\z", "\\Z"))
    return [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and pattern.match(chr(i))]


def test_simple_characters_are_normal_and_stay_so_together():
    import unicodedata

    found = simple_characters()
    assert len(found) > 20_000
    assert all(unicodedata.is_normalized("NFKC", c) and unicodedata.combining(c) == 0 and c.lower() == c.casefold() for c in found)
    text = "".join(found)
    assert unicodedata.normalize("NFKC", text) == text and unicodedata.normalize("NFKC", text[::-1]) == text[::-1]


def test_both_ways_agree(spark):
    odd = ["Ａ", "ß", "é", "ﬀ", "İ", "Σ", "　", "\x85", "ｶﾞ", "Ⅵ", "가", " "]
    found = simple_characters()
    words = ["x" + c + "Y" for c in found] + [a + " " + b for a in odd for b in (*odd, "Q", "—", "为")] + ["", " \t\x1c", "a\nb"]
    rows = spark.createDataFrame([(words[i : i + 50] + [None],) for i in range(0, len(words), 50)], "v array<string>")
    got = rows.select("v", tx.fold_all(F.col("v")).alias("folded"), tx.plain_all(F.col("v")).alias("plain"), tx.relation_all(F.col("v")).alias("named"), tx.fold_lists(F.array("v", F.lit(None), F.array())).alias("lists")).collect()
    for r in got:
        assert r.folded == [tx.folded(x) for x in r.v]
        assert r.plain == [tx.plain(x) for x in r.v]
        assert r.named == [tx.relation_name(x) for x in r.v]
        assert r.lists == [r.folded, None, []]


def test_simple_strings_do_not_reach_python(spark):
    """A Python function that fails is not called with any string of them."""
    from pyspark.sql.types import ArrayType, StringType

    def refuse(values):
        assert not any(len(v) for v in values)
        return values

    only = F.pandas_udf(refuse, ArrayType(StringType())).asNondeterministic()
    rows = spark.createDataFrame([(["Abc", "为", "É —"],), (None,)], "v array<string>")
    assert [r.x for r in rows.select(tx._hybrid(F.array("v"), tx._simple_folded, only).alias("x")).collect()] == [[["abc", "为", "é-"]], [None]]


def test_rows_of_simple_strings_are_done_at_once(spark):
    lists = [
        [["Ab c", "", " x\ty "], [], None, [""], [None, "É–—"]], [[""]], [], [["a\x01B", "\x02", "\x03"], ["\x04"], []], [[]], [None], None,
        [["\x03"]], [[" "], ["\x1c\n", " a  b "]], [["Straße", " A "], []],
    ]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<array<string>>").coalesce(1)
    got = rows.select("i", tx.fold_lists(F.col("v")).alias("f"), tx.plain_lists(F.col("v")).alias("p")).orderBy("i").collect()
    of = lambda fn, v: None if v is None else [None if x is None else [fn(y) for y in x] for x in v]
    assert [r.f for r in got] == [of(tx.folded, v) for v in lists]
    assert [r.p for r in got] == [of(tx.plain, v) for v in lists]


def test_blank_strings(spark):
    given = ["", " ", "\u3000\x85\x1c", "a", " a", "\u200b", None, "\n\u2028"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x string").coalesce(1)
    assert [r.b for r in rows.select("i", tx.is_blank(F.col("x")).alias("b")).orderBy("i").collect()] == [None if x is None else x.strip() == "" for x in given]
