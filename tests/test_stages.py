"""Stages are removed with the block or the job that owns them."""

from __future__ import annotations

import os

import pytest

from conftest import SF001
from costloom.session import materialize, stage_root, stages


def listed(spark):
    root = stage_root(spark).replace("file:", "")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_blocks_remove_their_own_stages(spark):
    before = listed(spark)
    with stages(spark):
        outer = materialize(spark.range(3), "outer")
        with stages(spark):
            inner = materialize(outer.selectExpr("id + 1 AS id"), "inner")
            assert inner.count() == 3 and len(listed(spark) - before) == 2
        assert len(listed(spark) - before) == 1 and outer.count() == 3
    assert listed(spark) == before


def test_a_failing_block_removes_them_too(spark):
    before = listed(spark)
    with pytest.raises(ValueError):
        with stages(spark):
            materialize(spark.range(3), "x")
            raise ValueError
    assert listed(spark) == before


@pytest.mark.parametrize("name", ["nrm2_normalize", "kub2_daily", "run3_estimated", "stt1_stats"])
def test_queries_leave_nothing_behind(spark, name):
    import __spark_entry__ as E
    before = listed(spark)
    with stages(spark):
        assert E.queries()[name](spark, SF001).collect()
        assert listed(spark) != before
    assert listed(spark) == before
