"""The parallelism guard only adds a shuffle when a frame is under-partitioned."""

from recordsmith.operators.parallel import ensure_parallelism


def test_spreads_small_inputs_and_leaves_large_ones(spark):
    target = spark.sparkContext.defaultParallelism
    one = spark.range(0, 100, 1, 1)
    spread = ensure_parallelism(one, "id")
    assert spread.rdd.getNumPartitions() == target
    assert sorted(r.id for r in spread.collect()) == list(range(100))
    many = spark.range(0, 100, 1, target * 2)
    assert ensure_parallelism(many, "id") is many
