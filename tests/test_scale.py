"""What keeps the plans of the registered queries cheap at size."""

from pairscore.plans import queries
from pairscore.sources import gold
from pairscore.sources.shared import parts_by_size


def test_long_lists_are_sorted_by_fields(spark):
    plan = queries.match_large(spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert "sort_array(collect_list(struct(l_orderkey" in plan  # a struct within makes an ordering at each comparison


def test_parts_are_prepared_in_their_own_row(spark):
    plan = queries.blank_parts(spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    assert "Join" not in plan.optimizedPlan().toString() and plan.toRdd().getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_sizes_of_lists_do_not_make_them(spark):
    plan = queries.match_greedy(spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert 0 < plan.count("concat_ws(\x1f") <= 4  # both lists for the fold and for the queues, none for a size


def test_merged_lists_are_made_once(spark):
    plan = queries.merge_entities(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter ((size(" not in plan and "Filter (size(" not in plan  # the inner form of inline is preceded by one


def test_repeated_lines_are_dealt_once_for_both_sides(spark):
    done = queries.repeated_chunks(spark, "/root/testdata/sf0.001")
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 1 and "isnotnull(doc_id" not in plan
    dealt = [line for line in plan.splitlines() if "+- Exchange hashpartitioning(doc_id" in line]
    assert len(dealt) == 1 and "REPARTITION_BY_NUM" in dealt[0]


def test_partitions_follow_a_table_s_size(spark):
    lines = queries.table(spark, "/root/testdata/sf0.01", "lineitem")
    cores = spark.sparkContext.defaultParallelism
    assert parts_by_size(lines, 1 << 40) == cores and parts_by_size(lines, 1 << 14) > 3 * cores


def test_gold_is_grouped_in_parts_by_size(spark, tmp_path, monkeypatch):
    (tmp_path / "gold.jsonl").write_text("".join(f'{{"doc_id": {i % 50}, "chunk_id": "{i % 7}", "entities": [{{"name": "a{i}"}}]}}\n' for i in range(1400)))
    monkeypatch.setattr(gold, "PART_BYTES", 1 << 12)
    read = gold.read_gold(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() > 10  # however well the rows compress
    assert {(r.doc_id, r.chunk_id): r.entities[0].name for r in read.collect()} == {(str(i % 50), str(i % 7)): f"a{i}" for i in range(1400)}
