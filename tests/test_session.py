from pathlib import Path

import pytest

from cleanroll.session import Stages, scratch_root, stage


def folders(spark, name):
    return list(Path(scratch_root(spark).removeprefix("file:")).glob(f"{name}-*"))


def test_stages_are_deleted_on_leaving(spark):
    with Stages(spark) as stages:
        first = stages.write(spark.range(5), "owned_first")
        second = stages.write(first.where("id > 2"), "owned_second")
        stages.drop(first)
        assert not folders(spark, "owned_first")
        assert second.count() == 2
        result = stage(second, "owned_result")
    assert not folders(spark, "owned_second")
    assert [r.id for r in result.orderBy("id").collect()] == [3, 4]


def test_stages_are_deleted_after_an_error(spark):
    with pytest.raises(ValueError, match="stop"), Stages(spark) as stages:
        stages.write(spark.range(5), "failed_first")
        raise ValueError("stop")
    assert not folders(spark, "failed_first")


def test_a_failed_write_leaves_nothing(spark):
    with pytest.raises(Exception, match="broken"), Stages(spark) as stages:
        stages.write(spark.range(3).selectExpr("raise_error('broken') as x"), "failed_write")
    assert not folders(spark, "failed_write")
