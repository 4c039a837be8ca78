"""Every stage of these queries is removed with the block around it."""

from __future__ import annotations

import os

import pytest

from costloom.llm import queries as Q
from costloom.session import stage_root, stages
from tests.llm.test_llm import SF


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_queries_leave_nothing_behind(spark, name):
    root = stage_root(spark).replace("file:", "")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with stages(spark):
        assert Q.queries()[name](spark, SF).limit(3).collect()
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before
