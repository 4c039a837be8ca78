"""The month's commit: one put, no moment without a month, whatever the store does."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from costloom.plans import sink
from costloom.plans.sink import current, data_path, manifest_folder, read_target, remove_abandoned, replace_month, versions


def month_rows(spark, n, month=202401):
    return spark.range(n).withColumn("invoice_month", F.lit(month))


def count(spark, target, month=202401):
    return read_target(spark, target).where(F.col("invoice_month") == month).count()


class Store:
    """A file system of which some calls fail; what it is asked for is written down."""

    def __init__(self, real, fails, asked):
        self.real, self.fails, self.asked = real, fails, asked

    def __getattr__(self, name):
        def call(*args):
            self.asked.append(name)
            if name in self.fails:
                raise OSError(f"the store refuses {name}")
            return getattr(self.real, name)(*args)
        return call


@pytest.fixture()
def store(monkeypatch):
    real, fails, asked = sink.file_system, set(), []

    def through(spark, path):
        fs, p = real(spark, path)
        return Store(fs, fails, asked), p

    monkeypatch.setattr(sink, "file_system", through)
    return fails, asked


def test_months_are_replaced_one_by_one(spark, scratch):
    t = os.path.join(scratch, "t")
    with pytest.raises(ValueError, match="no month"):
        read_target(spark, t)
    replace_month(month_rows(spark, 5), t, 202401)
    replace_month(month_rows(spark, 7, 202402), t, 202402)
    replace_month(month_rows(spark, 3), t, 202401)
    assert count(spark, t) == 3 and count(spark, t, 202402) == 7 and read_target(spark, t).count() == 10
    replace_month(month_rows(spark, 0), t, 202401)
    assert count(spark, t) == 0 and read_target(spark, t, [202402]).count() == 7
    plan = read_target(spark, t).where("invoice_month = 202402")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(invoice_month" in plan


def test_a_store_without_renames_will_do(spark, scratch, store):
    fails, asked = store
    fails.add("rename")
    t = os.path.join(scratch, "t")
    replace_month(month_rows(spark, 5), t, 202401)
    replace_month(month_rows(spark, 6), t, 202401)
    assert count(spark, t) == 6 and "rename" not in asked


@pytest.mark.parametrize("call", ["create", "delete"])
def test_a_refusing_store_leaves_a_month(spark, scratch, store, call):
    fails, _ = store
    t = os.path.join(scratch, "t")
    for n in (4, 5, 6):
        replace_month(month_rows(spark, n), t, 202401)
    fails.add(call)
    if call == "create":
        with pytest.raises(OSError):
            replace_month(month_rows(spark, 9), t, 202401)
        assert count(spark, t) == 6
    else:  # only the clean-up fails
        replace_month(month_rows(spark, 9), t, 202401)
        assert count(spark, t) == 9
    fails.clear()
    replace_month(month_rows(spark, 2), t, 202401)
    assert count(spark, t) == 2 and len(versions(spark, t, 202401)) == 2


def test_a_put_that_breaks_off_is_no_commit(spark, scratch):
    t = os.path.join(scratch, "t")
    replace_month(month_rows(spark, 4), t, 202401)
    for n, text in ((2, ""), (3, '{"version": "abc", "fa'), (4, "[]"), (5, '{"facts": {}}')):
        with open(f"{manifest_folder(t, 202401)}/{n:020d}.json", "w") as f:
            f.write(text)
    assert count(spark, t) == 4
    done = replace_month(month_rows(spark, 8), t, 202401)
    assert done.number == 6 and count(spark, t) == 8


def test_failing_write_and_failing_check_leave_the_month(spark, scratch):
    t = os.path.join(scratch, "t")
    replace_month(month_rows(spark, 5), t, 202401)
    bad = month_rows(spark, 5).withColumn("id", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        replace_month(bad, t, 202401)

    def refuse(written):
        assert written.count() == 3
        raise RuntimeError("not so")

    with pytest.raises(RuntimeError, match="not so"):
        replace_month(month_rows(spark, 3), t, 202401, check=refuse)
    assert count(spark, t) == 5
    assert len(os.listdir(os.path.dirname(data_path(t, 202401, "x")))) == 1       # nothing of them stays


def test_a_reader_that_began_can_finish(spark, scratch):
    t = os.path.join(scratch, "t")
    replace_month(month_rows(spark, 5), t, 202401)
    began = read_target(spark, t)
    replace_month(month_rows(spark, 6), t, 202401)
    assert began.count() == 5 and count(spark, t) == 6


def test_two_writers_of_one_number(spark, scratch, monkeypatch):
    t = os.path.join(scratch, "t")
    replace_month(month_rows(spark, 5), t, 202401)
    real = sink._numbers
    monkeypatch.setattr(sink, "_numbers", lambda s, target, month: [])      # a list from before the other's commit
    done = replace_month(month_rows(spark, 6), t, 202401)
    monkeypatch.setattr(sink, "_numbers", real)
    assert done.number == 2 and count(spark, t) == 6


def test_abandoned_versions_are_removed_in_time(spark, scratch):
    t = os.path.join(scratch, "t")
    replace_month(month_rows(spark, 5), t, 202401)
    os.makedirs(data_path(t, 202401, "dead"))
    assert remove_abandoned(spark, t) == 0
    os.utime(data_path(t, 202401, "dead"), (0, 0))
    assert remove_abandoned(spark, t) == 1 and count(spark, t) == 5
    assert current(spark, t, 202401) is not None and current(spark, t, 209901) is None
