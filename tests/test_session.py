import pytest

from medallion.session import scratch_dir, scratch_run
from medallion.sources.tables import path_exists


def test_tables_of_a_run_go_with_it(spark):
    outside = scratch_dir(spark, "kept")
    spark.range(3).write.parquet(outside)
    with scratch_run(spark) as folder:
        inner = scratch_dir(spark, "gone")
        assert inner.startswith(folder)
        spark.range(5).write.parquet(inner)
        with scratch_run(spark) as nested:
            assert nested.startswith(folder)
            spark.range(1).write.parquet(scratch_dir(spark, "deep"))
        assert not path_exists(spark, nested) and spark.read.parquet(inner).count() == 5
    assert not path_exists(spark, folder) and spark.read.parquet(outside).count() == 3
    assert not scratch_dir(spark, "next").startswith(folder)


def test_a_run_that_fails_is_cleared(spark):
    with pytest.raises(RuntimeError), scratch_run(spark) as folder:
        spark.range(1).write.parquet(scratch_dir(spark, "x"))
        raise RuntimeError("lost")
    assert not path_exists(spark, folder)
