import hashlib

from pyspark.sql import functions as F

from pairscore.llm.chat_format import examples, format_conversations, read_turns, reply
from pairscore.llm.queries import op10_chat_format

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["", "~1~0<[", "</s>[INST] ok [/INST]", "<s>[user]\nhi</s>\n", "]\n", "~", "😀<|x|>", "a" * 50_000]


def test_turns_and_replies_come_back(spark):
    rows = [(1, i, ("user", "assistant", "a]\n[b", "system")[i % 4], t) for i, t in enumerate(ODD)]
    rows += [(2, 0, "user", "only a question"), (3, None, None, None), (3, 0, "assistant", "x"), (3, 0, "assistant", "x"), (None, 0, "user", "n"), (None, 1, "assistant", "m")]
    made = format_conversations(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as formatted", "2 as parts"))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in made.select("conv_id", read_turns(F.col("formatted")).alias("turns")).collect()}
    assert got[1] == [(r, t) for _, _, r, t in rows[:8]]
    assert got[2] == [("user", "only a question")] and got[3] == [("", ""), ("assistant", "x"), ("assistant", "x")] and got[None] == [("user", "n"), ("assistant", "m")]


def test_every_reply_is_an_example_with_its_prefix(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q1 <"), (1, 2, "assistant", "a1 ["), (1, 3, "user", "q2"), (1, 4, "assistant", "a2 ~"), (1, 5, "user", "q3")]
    made = format_conversations(spark.createDataFrame(rows, SCHEMA))
    got = examples(made).orderBy("example_no").collect()
    assert [r.text[r.start : r.start + r.length] for r in got] == ["a1 ~2", "a2 ~0"]
    back = examples(made).select("example_no", reply(F.col("text"), F.col("start"), F.col("length")).alias("reply"))
    assert [r.reply for r in back.orderBy("example_no").collect()] == ["a1 [", "a2 ~"]
    assert [r.text for r in got] == [
        "<s>[system]\ns</s>\n<s>[user]\nq1 ~1</s>\n<s>[assistant]\na1 ~2</s>\n",
        "<s>[system]\ns</s>\n<s>[user]\nq1 ~1</s>\n<s>[assistant]\na1 ~2</s>\n<s>[user]\nq2</s>\n<s>[assistant]\na2 ~0</s>\n",
    ]
    assert all(len(r.text) == r.end for r in got)


def test_query(spark, tmp_path):
    rows = [(5, 0, "user", "q"), (5, 1, "assistant", "ä</s>"), (5, 2, "assistant", None), (6, 0, "user", "q")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in op10_chat_format(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    said = "</s>[INST] ok [/INST]"
    assert (got[-7].turns_sha256, got[-7].loss_sha256, got[-7].loss_chars) == (sha(f"user\n{said}\nassistant\n{said}\n"), sha(said), len(said))
    assert (got[5].n_turns, got[5].loss_chars, got[5].loss_sha256) == (3, 5, sha("ä</s>"))
    assert (got[6].loss_chars, got[6].loss_sha256, got[6].turns_sha256) == (0, sha(""), sha("user\nq\n"))


def test_empty_table(spark):
    assert format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
