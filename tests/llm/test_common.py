from pairscore.llm.common import Staged, dropping, spread


def test_few_partitions_are_dealt_and_many_are_left(spark):
    one, many = spark.range(100).coalesce(1), spark.range(100).repartition(9)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(many).rdd.getNumPartitions() == 9
    assert sorted(r.id for r in spread(one).collect()) == list(range(100))


def test_tables_made_inside_are_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pairscore.llm.common.shared_dir", lambda spark: str(tmp_path))
    outer = Staged(spark)
    kept = outer.keep(spark.range(3).toDF("id"))
    with dropping():
        assert Staged(spark).keep(spark.range(2).toDF("id")).count() == 2
        assert len(list(tmp_path.iterdir())) == 2
    assert len(list(tmp_path.iterdir())) == 1 and kept.count() == 3
