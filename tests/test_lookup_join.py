"""Lookup joins: broadcast under the threshold, split shuffle join beyond it (same rows)."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from costloom.operators import interval as IVL
from costloom.operators.lookup import lookup_join


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _frames(spark):
    # one hot resource holds most big-side rows; r-3 has no lookup row; a NULL key never matches
    big = spark.createDataFrame(
        [(f"r-{1 if i % 3 else (i % 4)}", i) for i in range(300)] + [(None, 999)],
        "resource_id string, hour int")
    lookup = spark.sql("SELECT * FROM VALUES ('r-1', 0, 99, 'alice'), ('r-1', 100, 400, 'bob'), ('r-0', 0, 500, 'carol'), "
                       "('r-2', 0, 10, 'dave') AS t(lk_id, lk_from, lk_to, lk_user)")
    return big, lookup


def _rows(df):
    return sorted((tuple(r) for r in df.select("resource_id", "hour", "lk_user").collect()), key=repr)


@pytest.mark.parametrize("spread_by", [("hour",), ()])
def test_shuffle_path_returns_the_broadcast_rows(spark, no_broadcast, spread_by):
    big, lookup = _frames(spark)
    big = big.unionByName(spark.createDataFrame([("", 5), ("", 6), (" ", 7)], big.schema))
    lookup = lookup.unionByName(spark.sql("SELECT * FROM VALUES ('', 0, 5, 'blank'), (' ', 0, 99, 'space'), (NULL, 0, 99, 'null') AS t(lk_id, lk_from, lk_to, lk_user)"))
    residual = (F.col("hour") >= F.col("lk_from")) & (F.col("hour") <= F.col("lk_to"))
    keys = [("resource_id", "lk_id")]
    shuffled = lookup_join(big, lookup, keys, residual=residual, spread_by=spread_by)
    assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
    rows = _rows(shuffled)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    sent = lookup_join(big, lookup, keys, residual=residual)
    assert "BroadcastHashJoin" in sent._jdf.queryExecution().executedPlan().toString()
    assert rows == _rows(sent) and len(rows) == big.count()
    assert ("", 5, "blank") in rows and ("", 6, None) in rows and (" ", 7, "space") in rows


def _two_lookups(spark, scratch, key_of_big, key_of_lookup, rows=60_000):
    path = os.path.join(scratch, "big")
    (spark.range(rows).select(key_of_big.alias("resource_id"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"), F.lit(1).alias("unused"))
     .repartition(8).write.parquet(path))
    j = spark.read.parquet(path)
    for n in ("a", "b"):
        spark.range(3000).select(key_of_lookup.alias(f"{n}_id"), F.sha2(F.col("id").cast("string"), 256).alias(f"{n}_user")).repartition(4).write.parquet(os.path.join(scratch, n))
        j = lookup_join(j, spark.read.parquet(os.path.join(scratch, n)), [("resource_id", f"{n}_id")], spread_by=("v", "pad"))
    return j.select("resource_id", "v", "pad", "a_user", "b_user")


def test_null_and_blank_keys_are_dealt_over_partitions_in_one_scan(spark, no_broadcast, scratch):
    """Nine tenths of the keys are NULL or blank: both joins take them in one exchange, spread; the big
    side is read once, and only its used columns."""
    i = F.col("id")
    key = F.when(i % 10 < 5, F.lit(None)).when(i % 10 < 9, F.lit("")).otherwise(F.concat(F.lit("r"), i))
    out = _two_lookups(spark, scratch, key, F.when(i == 0, "").otherwise(F.concat(F.lit("r"), i * 10 + 9)))
    placed = out.withColumn("p", F.spark_partition_id())
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in placed.groupBy("p").count().collect()]
        nulls = [r["count"] for r in placed.where("resource_id is null").groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(nulls) == 8 and max(nulls) < 2 * min(nulls)
    assert sum(sizes) == 60_000 and max(sizes) < 2 * min(sizes)
    rows = out.collect()
    assert sum(r.resource_id is None and r.a_user is None for r in rows) == 30_000
    assert sum(r.resource_id == "" and r.a_user is not None and r.b_user is not None for r in rows) == 24_000
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("FileScan parquet") == 3 and "unused" not in plan
    assert plan.count("Exchange hashpartitioning") == 3          # the big side and two lookups


def test_skewed_key_is_split(spark, no_broadcast, scratch):
    """Two lookups in a row on a key that holds most rows: AQE splits both joins."""
    i = F.col("id")
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = _two_lookups(spark, scratch, F.when(i % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), i)),
                           F.when(i == 0, "hot").otherwise(F.concat(F.lit("r"), i)))
        out.write.format("noop").mode("overwrite").save()
        assert out.count() == 60_000
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.split("== Initial Plan ==")[0].count("skew=true") >= 2


def _interval_rows(spark, events, owners):
    ev = spark.createDataFrame(events, "resource_id string, ts timestamp_ntz")
    ow = spark.createDataFrame(owners, "r string, s timestamp_ntz, e timestamp_ntz, who string")
    return ev, ow


def _joined(ev, ow, first, last):
    ow = IVL.within_span(ow, "s", "e", first, last)
    grid = IVL.dense_grid(ow, "r", "s", "e", first, last)
    a = IVL.bucket_events(ev, grid, "resource_id", "ts", "_b")
    b = IVL.bucket_intervals(ow, grid, "r", "s", "e", "rb")
    return a, b, grid


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(6)
    t0 = dt.datetime(2024, 1, 1)
    moment = lambda lo=-3, hi=35: t0 + dt.timedelta(seconds=rng.randrange(lo * 86400, hi * 86400))
    events = [(rng.choice(["a", "b", "few", "none", None]), moment(0, 31)) for _ in range(400)]
    owners = []
    for r, n in (("a", 300), ("b", 60), ("few", 5), ("elsewhere", 70)):
        for k in range(n):
            s = moment()
            owners.append((r, s, s + dt.timedelta(seconds=rng.choice([0, 1, 3600, 86400 * 20, -5])), f"{r}{k}"))
    owners += [("a", None, moment(), "x"), ("a", moment(), None, "y"), (None, t0, moment(30, 31), "z"), ("a", events[0][1], events[0][1], "edge")]
    ev, ow = _interval_rows(spark, events, owners)
    a, b, grid = _joined(ev, ow, F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-01-31 23:59:59").cast("timestamp_ntz"))
    assert {r.g_key for r in grid.collect()} == {"a", "b", "elsewhere"}
    got = lookup_join(a, b, [("resource_id", "r"), ("_b", "rb")], residual=(F.col("ts") >= F.col("s")) & (F.col("ts") <= F.col("e")))
    want = []
    for r, ts in events:
        hit = [w for o, s, e, w in owners if o == r and o is not None and s and e and s <= ts <= e]
        want += [(r, ts, w) for w in hit] or [(r, ts, None)]
    assert sorted(((r.resource_id, r.ts, r.who) for r in got.collect()), key=str) == sorted(want, key=str)
    tags = spark.createDataFrame([("a", "t1"), ("few", "t2"), ("a", "t3")], "rt string, tag string")
    tagged = lookup_join(a, IVL.bucket_all(tags, grid, "rt", "tb"), [("resource_id", "rt"), ("_b", "tb")])
    assert tagged.where("resource_id = 'a' and tag is not null").count() == 2 * sum(r == "a" for r, _ in events)


@pytest.mark.parametrize("length", [600, 86400 * 7])
def test_a_resource_with_100000_owners_stays_linear(spark, length):
    """Pairs that the equi-join looks at, against those that match, and copies of intervals."""
    n, month = 100_000, 31 * 86400
    start = F.timestamp_add("SECOND", F.pmod(F.col("id") * 7919, F.lit(month - length)), F.lit("2024-01-01").cast("timestamp_ntz"))
    ow = spark.range(n).select(F.lit("hot").alias("r"), start.alias("s"), F.timestamp_add("SECOND", F.lit(length), start).alias("e"), F.col("id").alias("who"))
    ev = spark.range(2000).select(F.lit("hot").alias("resource_id"), F.timestamp_add("SECOND", F.col("id") * 1339, F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"))
    a, b, _ = _joined(ev, ow, F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-01-31 23:59:59").cast("timestamp_ntz"))
    pairs = a.join(b, (F.col("resource_id") == F.col("r")) & (F.col("_b") == F.col("rb"))).select("ts", "s", "e")
    seen, matched = pairs.agg(F.count(F.lit(1)), F.count(F.when(F.col("ts").between(F.col("s"), F.col("e")), 1))).first()
    assert b.count() <= (IVL.COPIES + 2) * n
    assert seen <= 1.2 * matched + 3 * IVL.DENSE * 2000


def test_jobs_match_oracle_without_broadcasts(spark, duck, no_broadcast):
    """Every lookup (resource owners / tags, RI fees, prices, ad hoc slots, kube and infra weights)
    on the shuffle path gives the oracle's results."""
    import __spark_entry__ as E
    from tools.check_oracle import digest
    for name in ("nrm2_normalize", "nrm3_actual", "nrm3_estimated", "run1_daily", "run2_detail", "run3_actual", "run3_estimated"):
        sdf = E.queries()[name](spark, SF001)
        rows, cols = [r.asDict() for r in sdf.collect()], sorted(sdf.columns)
        rel = duck.execute(E.oracle_sql()[name])
        d_cols = [d[0] for d in rel.description]
        d_rows = [dict(zip(d_cols, r)) for r in rel.fetchall()]
        assert len(rows) == len(d_rows), name
        assert digest(rows, cols)[0] == digest(d_rows, cols)[0], name


def test_small_lookups_plan_as_broadcast_joins(spark):
    """Under the threshold, the RI / owner / tag lookups never shuffle the transactions."""
    import __spark_entry__ as E
    df = E.queries()["nrm2_normalize"](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 4       # accounts, RI fees, owners, tags
    assert "SortMergeJoin" not in plan
