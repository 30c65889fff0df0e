"""The report's sums as the state of a stream: exact over files that come in several runs, and after a batch run again."""

import shutil


from pairscore.operators import evaluate as ev, report
from pairscore.schemas import LEVELS
from pairscore.streaming import inbox

SF = "/root/testdata/sf0.001"
PARTS = [f"{level}_{p}" for level in LEVELS for p in ("tp", "fp", "fn")]


def scored(chunks):
    from pairscore.plans.queries import both_sides

    return ev.score_lists(both_sides(chunks))


def test_sums_of_a_stream(spark, tmp_path):
    from pairscore.plans.queries import slices

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    table, sums, checkpoint = (str(tmp_path / n) for n in ("documents", "sums", "checkpoint"))
    docs.where("doc_id % 2 = 0").repartition(3).write.parquet(table)

    def run():
        chunks = slices(spark, SF, inbox.read_table_stream(spark, table))
        inbox.summary_stream(scored(chunks), sums, checkpoint).awaitTermination()
        return inbox.latest_summary(spark, sums).first()

    def want(rows):
        done = scored(slices(spark, SF, rows))
        total = report.summary_counts(done).first().asDict(recursive=True)
        return [done.count(), *[total[level][p] for level in LEVELS for p in ("tp", "fp", "fn")]], {r.error_type: r["count"] for r in report.errors_by_type(done).collect()}

    got = run()
    counts, errors = want(docs.where("doc_id % 2 = 0"))
    assert [got.chunks, *[got[p] for p in PARTS]] == counts and {k: got[k] for k in errors} == errors
    assert spark.read.parquet(sums).select("batch_no").distinct().count() == 3  # a file a batch
    docs.where("doc_id % 2 = 1").repartition(2).write.mode("append").parquet(table)
    got = run()  # goes on where it stopped
    counts, errors = want(docs)
    assert [got.chunks, *[got[p] for p in PARTS]] == counts and {k: got[k] for k in errors} == errors
    # the last batch is run again: as if the driver had died between its output and its commit
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    again = run()
    assert [again.chunks, *[again[p] for p in PARTS]] == counts and {r.error_type: r["count"] for r in inbox.summary_errors(inbox.latest_summary(spark, sums)).collect()} == errors
    shutil.rmtree(sums)


def test_a_table_of_one_file(spark):
    assert inbox.read_table_stream(spark, f"{SF}/nation.parquet").isStreaming
    assert inbox.summary_errors(spark.createDataFrame([(0, 1)], "chunks long, missing_entity long"), ["missing_entity"]).collect() == []
