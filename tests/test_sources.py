import json

import pytest

from pairscore.operators.generate import catalogue_tasks, judged_questions, task_batches
from pairscore.plans.config import byte_size, load_config, load_generator, project_root
from pairscore.plans.pipeline import run_eval, run_generation
from pairscore.sources.gold import gold_lines, read_gold
from pairscore.sources.markdown import load_markdown, read_markdown
from pairscore.sources.sinks import commit_parts, write_lines, write_report
from pairscore.sources.models import ListingModel, StubModel, ask_model, extract
from pairscore.streaming.inbox import read_inbox, score_stream, stream_chunks

TEXT = "# Class Alpha\n第 3 页\nThe Kilo carries Shkval missiles.\nThe Kilo has Rubin sonar.\n"


def test_markdown(spark, tmp_path):
    (tmp_path / "a.md").write_bytes("x\r\ny\rz".encode())
    assert read_markdown(spark, str(tmp_path / "a.md")).first().text == "x\ny\nz"
    docs, errors = load_markdown(spark, str(tmp_path / "none.md"))
    assert docs.count() == 0 and errors[0].startswith("load_markdown: FileNotFoundError")


def test_gold(spark, tmp_path):
    path = tmp_path / "gold.jsonl"
    path.write_text('{"chunk_id": 1, "entities": [{"name": "old"}]}\n\n{"chunk_id": "1", "entities": [{"name": "new", "attributes": {"k": "v"}}]}\n{"chunk_id": "2"}\n')
    got = {r.chunk_id: [(e.name, e.attributes) for e in r.entities] for r in read_gold(spark, str(path)).collect()}
    assert got == {"1": [("new", {"k": "v"})], "2": []}
    assert read_gold(spark, None).count() == read_gold(spark, str(tmp_path / "none")).count() == 0
    path.write_text('{"chunk_id": "1", "entities": [{"name": 5}]}\n')
    with pytest.raises(Exception, match="invalid gold entity"):
        read_gold(spark, str(path)).collect()


class Broken:
    name = "broken"

    def open(self):
        def ask(system, user):
            raise TimeoutError("no answer")

        return ask


def test_failed_requests_are_rows(spark):
    chunks = spark.createDataFrame([("d", 1, "chunk_0001", "1", [], "Text Alpha")], "doc_id string, chunk_idx int, chunk_id string, page_hint string, title_path array<string>, text string")
    row = extract(chunks, Broken()).first()
    assert row.error == "TimeoutError: no answer" and row.entities == [] and row.raw_response == ""
    assert "Alpha" in [e.name for e in extract(chunks, StubModel()).first().entities]
    assert ask_model(chunks, StubModel(), concurrency=2).count() == 1


def test_run(spark, tmp_path):
    (tmp_path / "doc.md").write_text(TEXT)
    out = str(tmp_path / "out")
    summary, errors = run_eval(spark, str(tmp_path / "doc.md"), out, StubModel("a"), StubModel("b", drop_every=5), judge_model=StubModel("j"))
    assert errors == [] and summary["chunk_count"] == 1 and summary["metrics"]["entity_precision"] == 1.0 and 0 < summary["metrics"]["entity_recall"] < 1
    saved = json.loads((tmp_path / "out" / "summary_report.json").read_text())
    assert isinstance(saved.pop("chunk_errors"), list) and saved == summary and (tmp_path / "out" / "summary_report.md").read_text().count("\n- ") == 21
    line = json.loads(next((tmp_path / "out" / "pair_eval.jsonl").glob("part-*")).read_text().splitlines()[0])
    assert list(line) == ["chunk_id", "reference_source", "metrics", "counts", "errors", "llm_judgement"] and isinstance(line["llm_judgement"], dict)
    assert line["errors"]["extra_entity"] == [] and line["errors"]["missing_entity"][0]["name"]
    again, _ = run_eval(spark, str(tmp_path / "doc.md"), out, Broken(), Broken())  # other models: asked anew
    assert again["metrics"]["entity_f1"] == 0.0
    missing, errors = run_eval(spark, str(tmp_path / "no.md"), str(tmp_path / "out2"), StubModel(), StubModel())
    assert missing["chunk_count"] == 0 and missing["errors_by_type"] == {} and len(errors) == 1


def test_answers_are_kept(spark, tmp_path):
    (tmp_path / "doc.md").write_text(TEXT)
    run = lambda m: run_eval(spark, str(tmp_path / "doc.md"), str(tmp_path / "o"), m, StubModel("b"))[0]["metrics"]["entity_f1"]
    assert run(StubModel("a")) == 1.0
    broken = Broken()
    broken.name = "a"  # it would fail if it were asked
    assert run(broken) == 1.0


def test_batches(spark):
    tasks = catalogue_tasks(spark)
    assert [(r["count"], r.batch_id) for r in task_batches(tasks).orderBy("batch_id").collect()] == [(20, i) for i in range(1, 26)]
    every = task_batches(tasks, max_tasks=None).collect()
    assert len(every) == 230 and sum(r["count"] for r in every) == 4600
    small = spark.createDataFrame([(0, "c", 45, "d"), (1, "e", 0, "f")], tasks.schema)
    assert [r["count"] for r in task_batches(small, max_tasks=None).orderBy("batch_id").collect()] == [20, 20, 5]


class Asker:
    name = "asker"

    def open(self):
        return lambda system, user: "One?\n\n Two? \n"


def test_generation(spark, tmp_path):
    got = run_generation(spark, Asker(), str(tmp_path / "answers"))
    assert got.count() == 50 and {r.score for r in got.collect()} == {0}


def test_judged_questions(spark):
    q = spark.createDataFrame([("c", 1, 0, "a"), ("c", 1, 1, "b"), ("c", 1, 2, "d")], "category string, batch_id int, line_no int, question string")
    s = spark.createDataFrame([("c", 1, "7\n\nx\n")], "category string, batch_id int, text string")
    assert sorted(map(tuple, judged_questions(q, s).collect())) == [("c", "a", 7), ("c", "b", 0), ("c", "d", 0)]


def test_config(tmp_path, monkeypatch):
    for name in ("MODEL_A_NAME", "INPUT_MD", "OUTPUT_DIR", "GOLD_JSONL"):
        monkeypatch.delenv(name, raising=False)
    env = tmp_path / ".env"
    env.write_text("# c\nexport MODEL_A_BASE_URL='http://a'\nMODEL_A_API_KEY=k\nMODEL_A_NAME=a # note\nMODEL_B_BASE_URL=http://b\nMODEL_B_API_KEY=k\nMODEL_B_NAME=b\nINPUT_MD=in.md\n")
    with pytest.raises(ValueError, match="OUTPUT_DIR"):
        load_config(env_path=env)
    got = load_config(output_dir="o", env_path=env)
    assert (got.model_a.base_url, got.model_a.name, got.input_md, got.output_dir, got.gold_jsonl) == ("http://a", "a", "in.md", "o", None)
    assert "api_key" not in repr(got.model_a)
    monkeypatch.setenv("MODEL_A_NAME", " ")
    with pytest.raises(ValueError, match="MODEL_A_NAME"):
        load_config(output_dir="o", env_path=env)
    (tmp_path / "sub").mkdir()
    assert project_root(tmp_path / "sub") == tmp_path.resolve()
    assert [byte_size(x) for x in (5, "10 MB", "1.5kb", "7")] == [5, 10 * 2**20, 1536, 7]


def test_log(tmp_path):
    from pairscore.plans.log import driver_logger

    file = tmp_path / "logs" / "a.log"
    log = driver_logger("test", str(file), "1KB", 2)
    for i in range(200):
        driver_logger("test", str(file), "1KB", 2).info("number %d", i)
    assert len(log.handlers) == 2
    assert sorted(p.name for p in file.parent.iterdir()) == ["a.log", "a.log.1", "a.log.2"]
    assert file.read_text().splitlines()[-1].endswith("INFO test | number 199")
    driver_logger("test", str(tmp_path / "b.log")).info("to both")
    assert "to both" in (tmp_path / "b.log").read_text() and "to both" in file.read_text()
    with pytest.raises(ValueError, match="ten"):
        byte_size("ten MB")


def test_stream(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.md").write_text(TEXT)
    run = lambda: score_stream(stream_chunks(read_inbox(spark, str(inbox))), lambda b: b.select("doc_id", "chunk_id"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    (inbox / "b.md").write_text(TEXT)
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_answers_follow_the_chunks(spark, tmp_path):
    doc, out = tmp_path / "doc.md", str(tmp_path / "o")
    asked = tmp_path / "asked"
    asked.mkdir()

    class Counting:
        name = "a"

        def open(self):
            answer = StubModel().open()

            def ask(system, user):
                (asked / str(len(list(asked.iterdir())))).write_text(user)
                return answer(system, user)

            return ask

    def names():
        return {e.name for r in spark.read.parquet(f"{out}/_tables/extractions_a").collect() for e in r.entities} - {"Extract", "Markdown"}

    doc.write_text("The Kilo has Rubin sonar.")
    run_eval(spark, str(doc), out, Broken(), StubModel("b"))  # fails, so nothing is known
    broken_then = Counting()
    broken_then.name = "broken"
    run_eval(spark, str(doc), out, broken_then, StubModel("b"))  # asked again now that the model works
    assert names() == {"Rubin"} and len(list(asked.iterdir())) == 1
    run_eval(spark, str(doc), out, broken_then, StubModel("b"))  # known
    assert len(list(asked.iterdir())) == 1
    doc.write_text("The Kilo has Shkval missiles.")  # changed: no stale answer
    run_eval(spark, str(doc), out, broken_then, StubModel("b"))
    assert names() == {"Shkval"} and len(list(asked.iterdir())) == 2
    doc.write_text("")  # gone
    summary, _ = run_eval(spark, str(doc), out, broken_then, StubModel("b"))
    assert summary["chunk_count"] == 0 and spark.read.parquet(f"{out}/_tables/extractions_a").count() == 0


def test_gold_belongs_to_its_document(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.md").write_text("Rubin sonar")
    (docs / "b.md").write_text("Shkval missiles")
    ids = {r.doc_id.rsplit("/", 1)[1]: r.doc_id for r in read_markdown(spark, str(docs)).collect()}
    entity = lambda name: {"name": name, "evidence": [{"page": "1", "text": "t"}]}
    gold = tmp_path / "gold.jsonl"
    gold.write_text("".join(json.dumps({"doc_id": ids[f], "chunk_id": "chunk_0001", "entities": [entity(n)]}) + "\n" for f, n in (("a.md", "Rubin"), ("b.md", "Shkval"))))
    summary, _ = run_eval(spark, str(docs), str(tmp_path / "o"), Broken(), StubModel("b"), gold_jsonl=str(gold))
    assert summary["counts"]["entity"]["tp"] == 2 and summary["counts"]["entity"]["fn"] == 0
    gold.write_text(json.dumps({"chunk_id": "chunk_0001", "entities": [entity("Rubin")]}) + "\n")
    with pytest.raises(ValueError, match="several documents"):
        run_eval(spark, str(docs), str(tmp_path / "o2"), Broken(), StubModel("b"), gold_jsonl=str(gold))
    one, _ = run_eval(spark, str(docs / "a.md"), str(tmp_path / "o3"), Broken(), StubModel("b"), gold_jsonl=str(gold))
    assert one["counts"]["entity"]["tp"] == 1


def test_judged_generation(spark, tmp_path):
    got = run_generation(spark, ListingModel(), str(tmp_path / "q"), judge_model=ListingModel()).collect()
    assert len(got) == 500 and all(r.score == len(r.question) % 10 for r in got)
    with pytest.raises(ValueError, match="output"):
        run_generation(spark, ListingModel(), judge_model=ListingModel())


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    from pairscore.plans import cli

    monkeypatch.setattr(cli, "load_generator", lambda env: ListingModel())
    assert cli.main(["questions", "--output", str(tmp_path / "q"), "--judge", "--log", str(tmp_path / "run.log")], spark) == 0
    told = capsys.readouterr().out.splitlines()
    assert len(told) == 500 and told[0].count("\t") == 2
    assert "answers: 25 rows" in (tmp_path / "run.log").read_text()  # each step is logged
    env = tmp_path / ".env"
    env.write_text("MODEL_A_NAME=a\n")
    for name in ("MODEL_B_NAME", "MODEL_A_API_KEY"):
        monkeypatch.delenv(name, raising=False)
    assert cli.main(["eval", "--input", "x.md", "--output", "o", "--env", str(env), "--log", str(tmp_path / "run.log")], spark) == 1
    assert "MODEL_A_API_KEY" in (log := (tmp_path / "run.log").read_text()) and "MODEL_B_NAME" in log  # all missing ones at once
    for side in "AB":
        for part in ("BASE_URL", "API_KEY", "NAME"):
            monkeypatch.setenv(f"MODEL_{side}_{part}", "x")
    assert cli.main(["eval", "--input", str(tmp_path / "none.md"), "--output", "o"], spark) == 1
    assert "none.md" in capsys.readouterr().err


def test_generator_settings(tmp_path, monkeypatch):
    for name in ("LOCAL_MODEL", "LOCAL_MODEL_PROVIDER", "LOCAL_MODEL_BASE_URL", "LOCAL_MODEL_API_KEY"):
        monkeypatch.delenv(name, raising=False)
    env = tmp_path / ".env"
    env.write_text("LOCAL_MODEL=m\nLOCAL_MODEL_BASE_URL=http://m\nLOCAL_MODEL_API_KEY=k\n")
    got = load_generator(env)
    assert (got.name, got.base_url, got.api_key, got.temperature) == ("m", "http://m", "k", None)
    env.write_text("LOCAL_MODEL=m\nLOCAL_MODEL_PROVIDER=other\n")
    with pytest.raises(ValueError, match="other"):
        load_generator(env)


def test_shared_folder_is_refused_on_a_cluster():
    from types import SimpleNamespace as N

    from pairscore.sources.shared import shared_dir

    def session(master, named=None):
        held = N(isDefined=lambda: False)
        return N(conf=N(get=lambda key, default: named), sparkContext=N(master=master, _jsc=N(sc=lambda: N(getCheckpointDir=lambda: held))))

    assert shared_dir(session("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))


def test_gold_in_several_splits(spark, tmp_path):
    """A file of several splits is read by several tasks, and its last line for a chunk still wins; so does the last file."""
    path = tmp_path / "gold"
    path.mkdir()
    line = lambda i, name: json.dumps({"chunk_id": str(i % 50), "entities": [{"name": name}]}) + "\n"
    (path / "a.jsonl").write_text("".join(line(i, f"a{i}") + "\n" * (i % 3) for i in range(2_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert gold_lines(spark, str(path)).rdd.getNumPartitions() > 4
        assert {r.chunk_id: r.entities[0].name for r in read_gold(spark, str(path)).collect()} == {str(i): f"a{1950 + i}" for i in range(50)}
        (path / "b.jsonl").write_text(line(7, "b\r").replace("\\r", "") + "\r\n" + line(7, "last"))
        assert {r.chunk_id: r.entities[0].name for r in read_gold(spark, str(path)).collect()}["7"] == "last"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_one_file_in_order(spark, tmp_path):
    path = str(tmp_path / "one.jsonl")
    rows = spark.range(20_000, numPartitions=7).selectExpr("(id * 7919) % 20000 AS doc_id", "0 AS chunk_idx")
    for _ in range(2):  # the second takes the first's place
        write_lines(rows.selectExpr("*", "concat('v', doc_id) AS value"), path, one_file=True)
        assert (tmp_path / "one.jsonl").read_text().splitlines() == [f"v{i}" for i in range(20_000)]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["one.jsonl"]
    write_lines(rows.selectExpr("*", "'x' AS value").where("false"), path, one_file=True)
    assert (tmp_path / "one.jsonl").read_text() == ""


def test_parts_are_joined_where_the_file_system_can():
    from types import SimpleNamespace as N

    class Files:
        def __init__(self):
            self.did = []

        def listStatus(self, folder):  # noqa: N802
            paths = [N(name=n, getName=lambda n=n: n) for n in ("part-00002-x", "_SUCCESS", "part-00000-x", "part-00001-x")]
            return [N(getPath=lambda p=p: p) for p in paths]

        def concat(self, first, rest):
            self.did.append(("concat", first.name, [p.name for p in rest]))

        def delete(self, path, recursive):
            self.did.append(("delete", path))

        def rename(self, a, b):
            self.did.append(("rename", a.name, b))
            return True

    files = Files()
    commit_parts(files, str, list, "f._parts", "f")
    assert files.did == [("concat", "part-00000-x", ["part-00001-x", "part-00002-x"]), ("delete", "f"), ("rename", "part-00000-x", "f"), ("delete", "f._parts")]


def test_report_is_one_json_object(spark, tmp_path):
    rows = [("d", 2, "c2", "wrong_type", 1), ("d", 1, "c1", "missing_entity", 3), ("d", 1, "c1", "extra_entity", 2), ("e", 0, "c0", "missing_entity", 5)]
    counted = spark.createDataFrame(rows, "doc_id string, chunk_idx int, chunk_id string, error_type string, count long")
    write_report(spark, str(tmp_path / "r.json"), {"a": {"b": 1}}, counted.repartition(3))
    told = json.loads((tmp_path / "r.json").read_text())
    assert told == {"a": {"b": 1}, "chunk_errors": [{"chunk_id": c, "error_type": k, "count": n} for c, k, n in (("c1", "missing_entity", 3), ("c1", "extra_entity", 2), ("c2", "wrong_type", 1), ("c0", "missing_entity", 5))]}
    write_report(spark, str(tmp_path / "r.json"), {"a": 1}, counted.where("false"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": 1, "chunk_errors": []}


def test_totals_are_observed_during_the_write(spark, tmp_path):
    """The totals of a run are those that the tables give when they are read, and no job reads a table to count it."""
    from pairscore.plans.pipeline import Tables, summarize

    (tmp_path / "a.md").write_text(TEXT + "\n" + "x" * 3_000 + "\n" + TEXT)
    out = str(tmp_path / "out")
    told, _ = run_eval(spark, str(tmp_path / "a.md"), out, StubModel("a"), StubModel("b", drop_every=3))
    kept = lambda name: spark.read.parquet(f"{out}/_tables/{name}")
    head = {k: told[k] for k in ("input_md", "output_dir", "model_a", "model_b")}
    assert told == summarize(kept("pair_eval"), kept("chunks"), **head) and sum(told["errors_by_type"].values()) > 0
    tables = Tables(spark, str(tmp_path / "t"))
    assert tables.keep(spark.range(7, numPartitions=3), "some").count() == tables.seen["some"]["rows"] == 7
    assert tables.keep(spark.range(7).where("id > 9"), "none").count() == tables.seen["none"]["rows"] == 0
    assert tables.keep(spark.range(7).where("false"), "never").count() == tables.seen["never"]["rows"] == 0
