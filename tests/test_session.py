"""Session helpers: shared checkpoint folder, materialisation, sizing."""

from pyspark.sql import functions as F

from ridgeline.session import checkpoint_dir, cluster_conf, materialize


def test_checkpoint_dir_is_set_and_stable(spark):
    d = checkpoint_dir(spark)
    assert d and checkpoint_dir(spark) == d
    assert spark.sparkContext.getCheckpointDir() == d


def test_materialize_both_forms_cut_lineage(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k")).groupBy("k").count()
    for as_table in (False, True):
        m = materialize(df, as_table=as_table)
        assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in df.collect())
        plan = m._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan  # the aggregate is not recomputed


def test_cluster_conf_sizes_shuffle_from_volume():
    conf = cluster_conf(100, executors=1000, cores_per_executor=4, target_partition_mb=256)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024 * 1024 // 256
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(0.001, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # at least two waves of slots


def test_checkpoint_folder_is_required_off_a_local_master():
    from types import SimpleNamespace

    import pytest

    from ridgeline.session import is_local

    assert is_local("local") and is_local("local[4]") and is_local("local[*]")
    assert not is_local("yarn") and not is_local("local-cluster[2,1,1024]")
    spark = SimpleNamespace(
        sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None),
        conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(spark)
