"""Question generation: a task catalogue, cut into batches, answered by a model, as question rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import answer_lines
from ..schemas import TASK

BATCH_SIZE = 20
#: Batches asked at the same time.
MAX_CONCURRENCY = 16

# The catalogue of categories, how many questions each is to have, and what it covers.
CATALOGUE = (
    ("结婚登记与条件", 500, "涉及结婚年龄、自愿原则、禁止近亲结婚、疾病限制、登记程序及法律效力等。"),
    ("夫妻权利义务", 400, "涵盖共同财产管理、相互扶养义务、姓名权、生育权及日常家事代理权等。"),
    ("离婚程序与条件", 600, "包括协议离婚冷静期、诉讼离婚标准、分居认定、感情破裂证明及调解程序等。"),
    ("财产分割", 800, "涉及共同财产界定、个人财产保护、债务承担、房产分割规则及隐匿财产追责等。"),
    ("子女抚养与监护权", 800, "包含抚养费计算标准、探视权实施、非婚生子女权益、抚养关系变更及教育责任等。"),
    ("家庭暴力与保护令", 500, "涵盖暴力行为认定、人身保护令申请、证据收集、紧急庇护措施及刑事责任关联等。"),
    ("继承权与婚姻关系", 300, "涉及配偶继承顺位、遗嘱效力、遗产分割冲突、再婚继承权及代位继承问题等。"),
    ("无效婚姻与可撤销婚姻", 200, "包括重婚无效、胁迫婚姻撤销、隐瞒疾病撤销的程序及法律后果等。"),
    ("涉外婚姻", 300, "涉及跨国婚姻登记、域外结婚效力认定、财产跨境分割及国际子女抚养公约适用等。"),
    ("法律责任与救济措施", 200, "包含虚假登记处罚、拒不执行判决后果、损害赔偿计算及强制执行程序等。"),
)


def catalogue_tasks(spark: SparkSession, catalogue=CATALOGUE) -> DataFrame:
    return spark.createDataFrame([(i, *row) for i, row in enumerate((c, n, d) for c, n, d in catalogue)], TASK)


def task_batches(tasks: DataFrame, size: int = BATCH_SIZE, max_tasks: int | None = 1) -> DataFrame:
    """``task_idx, category, count, description, batch_id``: each task in batches of ``size``, the last one smaller,
    numbered from 1. Only the first ``max_tasks`` tasks are cut; None takes all. A count of 0 gives no batch."""
    if max_tasks is not None:
        tasks = tasks.orderBy("task_idx").limit(max_tasks)
    starts = F.when(F.col("count") > 0, F.sequence(F.lit(0), F.col("count") - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    cut = tasks.select("task_idx", "category", F.col("count").alias("total"), "description", F.posexplode(starts).alias("n", "start"))
    return cut.select("task_idx", "category", F.least(F.lit(size), F.col("total") - F.col("start")).alias("count"), "description", (F.col("n") + 1).alias("batch_id"))


def question_rows(answers: DataFrame, category: str = "category", text: str = "text") -> DataFrame:
    """``category, question, score``: a row per non-blank line of each answer, repeats too; the score starts at 0."""
    return answers.select(F.col(category).alias("category"), F.explode(answer_lines(F.coalesce(F.col(text), F.lit("")))).alias("question"), F.lit(0).alias("score"))


def numbered_questions(answers: DataFrame) -> DataFrame:
    """``category, batch_id, line_no, question``: an answer's questions in order, from 0."""
    return answers.select("category", "batch_id", F.posexplode(answer_lines(F.coalesce("text", F.lit("")))).alias("line_no", "question"))


def judged_questions(questions: DataFrame, scores: DataFrame) -> DataFrame:
    """Questions (category, batch_id, line_no, question) with the judge's scores: the n-th non-blank line of the answer for
    a batch (category, batch_id, text) belongs to the n-th question; what is no digit from 0 to 9, or missing, is 0."""
    told = scores.select("category", "batch_id", F.posexplode(answer_lines(F.coalesce("text", F.lit("")))).alias("line_no", "told"))
    judged = questions.join(told, ["category", "batch_id", "line_no"], "left")
    score = F.when(F.col("told").rlike("^[0-9]$"), F.col("told")).otherwise("0").cast("int")
    return judged.select("category", "question", score.alias("score"))
