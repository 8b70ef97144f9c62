"""Intermediate tables and the scopes that own them."""

import os

import pytest

from ferrytab.plans.catalogue import QUERIES
from ferrytab.session import TASKS_PER_CORE, even_tasks, scratch_dir, scratch_path, scratch_scope
from ferrytab.sources.extract import extract_batches


def held(spark):
    return set(os.listdir(scratch_dir(spark).removeprefix("file:")))


def test_nothing_is_left_of_a_scope(spark, sf_dir):
    before = held(spark)
    with scratch_scope(spark):
        rows = extract_batches(spark.range(1_000), "id", batch_size=100)
        assert len(held(spark) - before) == 1
        assert rows.count() == rows.distinct().count() == 1_000  # read as often as wanted, meanwhile
        assert QUERIES["rule_transitions"](spark, sf_dir).count() >= 0
        assert len(held(spark) - before) >= 2
    assert held(spark) == before


def test_scopes_stand_in_each_other_and_end_with_errors(spark):
    before = held(spark)
    with pytest.raises(RuntimeError), scratch_scope(spark):
        outer = scratch_path(spark, "outer")
        spark.range(3).write.parquet(outer)
        with scratch_scope(spark):
            spark.range(3).write.parquet(scratch_path(spark, "inner"))
        assert held(spark) - before == {os.path.basename(outer)}
        raise RuntimeError
    assert held(spark) == before
    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    assert held(spark) - before == {os.path.basename(kept)}


def test_a_path_that_was_never_written_is_no_error(spark):
    with scratch_scope(spark):
        scratch_path(spark, "never")


SCAN, SHUFFLE = "spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum"


def test_a_stage_of_even_tasks_has_several_per_core(spark):
    rows, cores = scratch_path(spark, "rows"), spark.sparkContext.defaultParallelism
    spark.range(0, 6_400, 1, 64).write.parquet(rows)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")  # files this small are else read together
    try:
        assert spark.read.parquet(rows).rdd.getNumPartitions() <= 2 * cores
        with even_tasks(spark):
            assert spark.read.parquet(rows).rdd.getNumPartitions() >= 3 * cores
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_settings_of_the_session_stay_and_come_back(spark):
    spark.conf.set(SCAN, "7")
    try:
        with pytest.raises(RuntimeError), even_tasks(spark):
            least = str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
            with even_tasks(spark):
                assert (spark.conf.get(SCAN), spark.conf.get(SHUFFLE)) == ("7", least)
            assert (spark.conf.get(SCAN), spark.conf.get(SHUFFLE)) == ("7", least)
            raise RuntimeError
        assert (spark.conf.get(SCAN), spark.conf.get(SHUFFLE, None)) == ("7", None)
    finally:
        spark.conf.unset(SCAN)
