"""Edge rows from the survey's decision table (Q-numbers) on hand-made inputs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import D, cur_rows, ts
from costloom import constants as K
from costloom.operators import fees as FEES
from costloom.operators.calendar import month_calendar
from costloom.operators.fanout import fan_out
from costloom.operators.normalize import normalize_bill
from costloom.plans.daily import DailyJob, resolve_month
from costloom.plans.summary import SummaryJob
from costloom.sources import fixture_defs as FX
from costloom.sources.catalog import DictCatalog, FixtureCatalog


def catalog(spark, **tables):
    return DictCatalog(spark, tables, fallback=FixtureCatalog(spark, SF001))


def test_q11_three_valued_type_filters(spark):
    cur = cur_rows(spark,
                   {"line_item_line_item_type": "Credit", "line_item_line_item_description": None},
                   {"line_item_line_item_type": "Fee", "bill_bill_type": None},
                   {"line_item_line_item_type": "Fee", "bill_bill_type": "Anniversary", "resource_tags_user_name": "a"},
                   {"line_item_line_item_type": "Fee", "bill_bill_type": "Purchase"},
                   {"line_item_line_item_type": "Credit", "line_item_line_item_description": "ok",
                    "resource_tags_user_name": "b"},
                   {"line_item_line_item_type": None, "resource_tags_user_name": "c"})
    cat = catalog(spark)
    out = normalize_bill(cur, cat.account_config, 202401).collect()
    # NULL description / NULL bill type make NOT(a AND b) NULL -> dropped; NULL type fails NOT IN
    assert sorted(r.resource_tags_user_name for r in out) == ["a", "b"]


def test_company_fallback_and_support_cost(spark):
    cur = cur_rows(spark,
                   {"resource_tags_user_company": "", "line_item_usage_account_id": FX.HOSTING,
                    "resource_tags_user_name": "blank"},
                   {"resource_tags_user_company": None, "resource_tags_user_name": "null"},
                   {"resource_tags_user_company": " x ", "resource_tags_user_name": "spaced"},
                   {"product_product_name": "AWS Support (Business)", "resource_tags_user_name": "support"},
                   {"line_item_line_item_type": "SavingsPlanCoveredUsage", "resource_tags_user_name": "spcu"})
    out = {r.resource_tags_user_name: r for r in
           normalize_bill(cur, catalog(spark).account_config, 202401).collect()}
    assert out["blank"].resource_tags_user_company == "COMPANY INFRASTRUCTURE"
    assert out["null"].resource_tags_user_company == "CLIENT A"          # Dev default cost centre
    assert out["spaced"].resource_tags_user_company == " X "              # no trim in the daily rule
    assert out["support"].pricing_public_on_demand_cost == Decimal("10")  # support takes unblended
    assert out["spcu"].line_item_unblended_cost == 0


def test_q12_zero_delete_keeps_null_costs(spark):
    df = spark.createDataFrame(
        [(1, D(0), D(0)), (2, None, D(0)), (3, D(0), D(5)), (4, D(0), None)],
        "id INT, line_item_unblended_cost DECIMAL(28,12), pricing_public_on_demand_cost DECIMAL(28,12)")
    assert sorted(r.id for r in FEES.drop_zero_cost_rows(df).collect()) == [2, 3, 4]


def test_q13_only_recurring_fees(spark):
    cur = cur_rows(spark,
                   {"line_item_line_item_type": "SavingsPlanRecurringFee", "line_item_usage_start_date": ts(2024, 1, 3, 1)},
                   {"line_item_line_item_type": "SavingsPlanRecurringFee", "line_item_usage_start_date": ts(2024, 1, 29, 1)})
    job = DailyJob(catalog(spark, cost_usage_report=cur), 202401)
    assert job.scalars["last_trx"] is None
    assert job.after_cut().count() == 2            # nothing cut
    assert job.upfront_rows().count() == 0         # no upfront rows up to a NULL date


def test_cut_drops_recurring_fees_after_last_usage(spark):
    cur = cur_rows(spark,
                   {"line_item_usage_start_date": ts(2024, 1, 20, 5)},
                   {"line_item_line_item_type": "SavingsPlanRecurringFee", "line_item_usage_start_date": ts(2024, 1, 20, 5),
                    "resource_tags_user_name": "same"},
                   {"line_item_line_item_type": "SavingsPlanRecurringFee", "line_item_usage_start_date": ts(2024, 1, 20, 6),
                    "resource_tags_user_name": "later"})
    job = DailyJob(catalog(spark, cost_usage_report=cur), 202401)
    names = sorted(r.resource_tags_user_name for r in job.after_cut().collect())
    assert names == ["i-9", "same"]


@pytest.mark.parametrize("start,month,days", [
    (ts(2024, 1, 1, 5), 202401, 31), (ts(2024, 1, 20, 7), 202401, 12), (ts(2024, 1, 31, 0), 202401, 1),
    (ts(2024, 2, 1, 0), 202402, 29)])
def test_rifee_amortisation_slices(spark, start, month, days):
    y, m = divmod(month, 100)
    last_day = (dt.date(y, m, 28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    cur = cur_rows(spark,
                   {"invoice_month": month, "line_item_line_item_type": "RIFee", "line_item_usage_start_date": start,
                    "line_item_unblended_cost": D("31.00"), "line_item_usage_amount": D("62"),
                    "pricing_public_on_demand_cost": D("0"), "resource_tags_user_name": "ri"},
                   {"invoice_month": month, "line_item_usage_start_date": dt.datetime.combine(last_day, dt.time(23))})
    job = DailyJob(catalog(spark, cost_usage_report=cur), month)
    ri = [r for r in job.after_amortize().collect() if r.resource_tags_user_name == "ri"]
    assert len(ri) == days
    assert {r.note for r in ri} == {K.NOTE_AMORTIZED_RI}
    assert {r.line_item_usage_start_date.hour for r in ri} == {start.hour}
    assert abs(sum(r.line_item_unblended_cost for r in ri) - Decimal("31")) < Decimal("1e-9")


def test_rifee_slices_stop_at_last_transaction_date(spark):
    cur = cur_rows(spark,
                   {"line_item_line_item_type": "RIFee", "line_item_usage_start_date": ts(2024, 1, 1),
                    "pricing_public_on_demand_cost": D("0"), "resource_tags_user_name": "ri"},
                   {"line_item_usage_start_date": ts(2024, 1, 10, 3)})
    job = DailyJob(catalog(spark, cost_usage_report=cur), 202401)
    ri = [r for r in job.after_amortize().collect() if r.resource_tags_user_name == "ri"]
    assert max(r.line_item_usage_start_date for r in ri).date() == dt.date(2024, 1, 10)
    assert len(ri) == 10


def _adhoc_cur(spark, when):
    return cur_rows(spark, {"line_item_usage_account_id": FX.HOSTING, "resource_tags_user_name": "i-1",
                            "line_item_usage_start_date": when, "line_item_unblended_cost": D("12"),
                            "pricing_public_on_demand_cost": D("18")})


def test_q4_off_hours_edge_of_month_is_not_allocated(spark):
    # 17:00 UTC on the 31st is 00:00 on Feb 1 at UTC+7: outside the month's calendar
    job = DailyJob(catalog(spark, cost_usage_report=_adhoc_cur(spark, ts(2024, 1, 31, 17))), 202401)
    rows = job.after_adhoc().collect()
    assert len(rows) == 1 and rows[0].note == "" and rows[0].resource_tags_user_company == "CLIENT A"


def test_q1_instance_scope_matches_other_accounts(spark):
    # 13:00 UTC = 20:00 UTC+7 on Wed Jan 31: Hosting/i-1 has only Client A, Prod/i-1 has Client D
    cur = _adhoc_cur(spark, ts(2024, 1, 31, 13))
    faithful = DailyJob(catalog(spark, cost_usage_report=cur), 202401, adhoc_scope="instance").after_adhoc().collect()
    fixed = DailyJob(catalog(spark, cost_usage_report=cur), 202401, adhoc_scope="account").after_adhoc().collect()
    assert [r.resource_tags_user_company for r in faithful] == ["Client A", "Client A"]
    assert sum(r.line_item_unblended_cost for r in faithful) == Decimal("24")   # over-allocated, as the reference
    assert [(r.resource_tags_user_company, r.line_item_unblended_cost) for r in fixed] == [("Client A", Decimal("12"))]
    assert {r.note for r in fixed} == {K.NOTE_ADHOC_DAILY}


def test_adhoc_split_between_overlapping_companies(spark):
    # 14:00 UTC = 21:00 UTC+7 on Jan 15: Client A (schedule 1) and Client B (schedule 2) share i-1
    cur = _adhoc_cur(spark, ts(2024, 1, 15, 14))
    rows = DailyJob(catalog(spark, cost_usage_report=cur), 202401, adhoc_scope="account").after_adhoc().collect()
    assert sorted((r.resource_tags_user_company, r.line_item_unblended_cost) for r in rows) == \
        [("Client A", Decimal("6")), ("Client B", Decimal("6"))]


def test_fee_types_are_not_reallocated(spark):
    cur = cur_rows(spark, {"line_item_usage_account_id": FX.HOSTING, "resource_tags_user_name": "i-1",
                           "line_item_line_item_type": "Fee", "line_item_usage_start_date": ts(2024, 1, 15, 14)})
    rows = DailyJob(catalog(spark, cost_usage_report=cur), 202401).after_adhoc().collect()
    assert len(rows) == 1 and rows[0].note == ""


def test_q22_duplicate_price_key_is_refused(spark):
    prices = spark.sql("SELECT * FROM VALUES ('c5.large', CAST(0.1 AS DECIMAL(18,8))), "
                       "('c5.large', CAST(0.2 AS DECIMAL(18,8))) AS t(product_instance_type, pricing_public_on_demand_rate)")
    cur = cur_rows(spark, {"line_item_usage_type": "APS1-SpotUsage:c5.large"})
    job = DailyJob(catalog(spark, cost_usage_report=cur, price_list=prices), 202401)
    priced = job.after_spot()          # the plan raises, when it meets the key
    with pytest.raises(Exception, match="price_list: key product_instance_type=c5.large is not unique"):
        priced.collect()


def test_repeated_null_price_keys_match_nothing(spark):
    prices = spark.sql("SELECT * FROM VALUES ('c5.large', CAST(0.1 AS DECIMAL(18,8))), (CAST(NULL AS STRING), CAST(0.2 AS DECIMAL(18,8))), "
                       "(NULL, CAST(0.3 AS DECIMAL(18,8))) AS t(product_instance_type, pricing_public_on_demand_rate)")
    cur = cur_rows(spark, {"line_item_usage_type": "APS1-SpotUsage:c5.large", "line_item_usage_amount": D("10")},
                   {"product_instance_type": None, "resource_tags_user_name": "null"})
    rows = {r.resource_tags_user_name: r for r in DailyJob(catalog(spark, cost_usage_report=cur, price_list=prices), 202401).after_spot().collect()}
    assert rows["i-9"].pricing_public_on_demand_cost == Decimal("1") and rows["null"].pricing_public_on_demand_cost == Decimal("15")


def test_spot_pricing_daily(spark):
    cur = cur_rows(spark,
                   {"line_item_usage_type": "APS1-SpotUsage:c5.large", "line_item_usage_amount": D("10"),
                    "resource_tags_user_name": "mapped"},
                   {"line_item_usage_type": "APS1-SpotUsage:m5.xlarge", "resource_tags_user_name": "unmapped"})
    job = DailyJob(catalog(spark, cost_usage_report=cur), 202401)
    rows = {r.resource_tags_user_name: r for r in job.after_spot().collect()}
    assert rows["mapped"].product_instance_type == "c5.large" and rows["mapped"].product_instance_type_family == "c5"
    assert rows["mapped"].pricing_public_on_demand_cost == Decimal("1.23456")
    assert rows["unmapped"].pricing_public_on_demand_cost == Decimal("15")
    assert [r.instance_size for r in job.unmapped_spot().collect()] == ["m5.xlarge"]


def test_fan_out_shuffle_path_matches_broadcast_path(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(30)], "id INT, t BOOLEAN")
    w = spark.createDataFrame([(f"c{j}", D(j) / 10) for j in range(7)], "w_company STRING, w_weight DECIMAL(18,16)")
    fields = {"w_company": "string", "w_weight": K.WEIGHT}
    sent = fan_out(df, F.col("t"), w, fields).collect()
    shuffled = fan_out(df, F.col("t"), w, fields, broadcast=False).collect()
    key = lambda r: (r.id, r.w_company or "", r._w_hit)
    assert sorted(map(key, sent)) == sorted(map(key, shuffled))
    assert len(sent) == 20 + 10 * 7
    for small in (True, False):
        assert len(fan_out(df, F.col("t"), w.limit(0), fields, broadcast=small).collect()) == 20   # target rows vanish without weights


def test_fan_out_plans_fast_and_spreads_rows(spark):
    """The plan does not grow with the weights, and beyond the broadcast threshold the product
    is spread over most shuffle partitions."""
    import time
    df = spark.range(2000).select(F.col("id"), F.lit(True).alias("t"))
    fields = {"w_company": "string", "w_weight": K.WEIGHT}
    many = spark.range(100_000).select(F.concat(F.lit("c"), "id").alias("w_company"), F.lit("0.00001").cast(K.WEIGHT).alias("w_weight"))
    start = time.monotonic()
    fan_out(df, F.col("t"), many, fields)._jdf.queryExecution().optimizedPlan()
    assert time.monotonic() - start < 2
    few = many.limit(45)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in fan_out(df, F.col("t"), few, fields, broadcast=False).where("_w_hit")
                 .groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == 90_000 and len(sizes) >= width - 1 and max(sizes) < 3 * 90_000 / width


def test_shares_beyond_one_and_exact_weighting(spark):
    """Credits can make a share exceed 1; weighted money is the exact decimal value rounded once."""
    from costloom.operators.infra import with_share
    from costloom.operators.rollup import weight_actual_cost
    g = spark.createDataFrame([("a", D(1000)), ("b", D(-995))], "k STRING, v DECIMAL(28,12)")
    assert {r.k: r.w for r in with_share(g, "v", "w").collect()} == {"a": D(200), "b": D(-199)}
    rows, accounts = [], spark.createDataFrame([("1", "One", "C")], "account_id STRING, account_display_name STRING, default_cost_center STRING")
    for i in range(300):
        rows.append((199801, "I", "ACTUAL", "1", f"C{i}", "p", "Usage", D("31234567.12345671") + 7 * i, D("41234567.87654321") + 11 * i, ""))
    agg = spark.createDataFrame(rows, "invoice_month INT, invoice_id STRING, trx_source STRING, account_id STRING, user_company STRING, user_product STRING, "
                                      "lineitem_type STRING, actual_cost DECIMAL(38,8), retail_cost DECIMAL(38,8), note STRING")
    got = {r.user_company: r for r in weight_actual_cost(agg, accounts).collect()}
    actual, retail = sum(r[7] for r in rows), sum(r[8] for r in rows)
    assert actual > D("9e9")
    import decimal
    with decimal.localcontext() as ctx:
        ctx.prec = 80
        for r in rows:
            want = (r[8] * actual / retail).quantize(D("1e-8"), decimal.ROUND_HALF_UP)
            assert got[r[4]].weighted_actual_cost == want


def test_month_calendar_and_weekday_codes(spark):
    cal = {r.calendar_date: r.day_of_week for r in month_calendar(spark, 202402).collect()}
    assert len(cal) == 29
    assert cal[dt.date(2024, 2, 4)] == "SUN" and cal[dt.date(2024, 2, 29)] == "THU"


def test_month_resolution():
    now = dt.datetime(2024, 1, 15)
    assert resolve_month(None, now) == 202401 and resolve_month(0, now) == 202401
    assert resolve_month(-1, now) == 202312 and resolve_month(199805, now) == 199805


def test_q24_summary_source_is_validated(spark):
    with pytest.raises(ValueError):
        SummaryJob(FixtureCatalog(spark, SF001), None, 199801)


def test_billing_state(spark):
    invoiced = cur_rows(spark, {"bill_invoice_id": "INV1"})
    pending = cur_rows(spark, {"bill_invoice_id": ""}, {"bill_invoice_id": "INV1", "resource_tags_user_name": "b"})
    a = DailyJob(catalog(spark, cost_usage_report=invoiced), 202401)
    b = DailyJob(catalog(spark, cost_usage_report=pending), 202401)
    assert a.billing_state().first().trx_source == "ACTUAL" and a.scalars["trx_source"] == "ACTUAL"
    assert b.billing_state().first().trx_source == "ESTIMATED"


def test_shares_of_large_totals(spark):
    """Totals of a large bill: products and quotients of more than 38 digits, exact at the last place."""
    from costloom.functions.columns import from_units, times_over, units
    from costloom.operators.infra import with_share
    from costloom.operators.rollup import weight_actual_cost
    import decimal
    amounts = [("x", "A", D("1234567890123.12345678"), D("2345678901234.87654321")), ("x", "B", D("-99999999999.5"), D("33333333333.33333333")),
               ("x", "C", D("0.00000001"), D("0.00000001"))]
    agg = spark.createDataFrame([(199801, "INV", "ESTIMATED", FX.HOSTING, k, x, "Usage", a, r) for x, k, a, r in amounts],
                                "invoice_month int, invoice_id string, trx_source string, account_id string, user_company string, user_product string, "
                                "lineitem_type string, actual_cost decimal(38,8), retail_cost decimal(38,8)")
    got = {r.user_company: r for r in weight_actual_cost(agg, catalog(spark).account_config).collect()}
    with decimal.localcontext(prec=90, rounding=decimal.ROUND_HALF_UP):
        actual, retail = (sum(x[i] for x in amounts) for i in (2, 3))
        for _, k, _, part in amounts:
            assert got[k].weighted_actual_cost == (part * actual / retail).quantize(D("1e-8"))
            assert got[k].retail_cost_percent == (part / retail).quantize(D("1e-10"))
        rows = [("a", D("123456789012345.123456789012")), ("b", D("-23456789012345.5")), ("c", None)]
        shares = {r.k: r.w for r in with_share(spark.createDataFrame(rows, "k string, v decimal(28,12)"), "v", "w").collect()}
        total = rows[0][1] + rows[1][1]
        assert shares == {"a": (rows[0][1] / total).quantize(D("1e-16")), "b": (rows[1][1] / total).quantize(D("1e-16")), "c": None}
        cases = [(D(p), D(f), D(t)) for p in ("0", "1", "-7", "99999999999999999999.99999999", "12345678.00000001") for f in ("0", "3", "-99999999999999999999.99999999")
                 for t in ("7", "-99999999999999999999.99999999", "2", "3333333333333.33333333")
                 if abs(D(p) * D(f) / D(t)) < D("1e20")]
        df = spark.createDataFrame(cases, "p decimal(28,8), f decimal(28,8), t decimal(28,8)")
        found = df.select("*", from_units(times_over(*(units(F.col(x), 8) for x in "pft")), 8, K.DEC38_8).alias("q")).collect()
        assert len(found) == len(cases)
        assert [r.q for r in found] == [(r.p * r.f / r.t).quantize(D("1e-8")) for r in found]


def test_second_part_equals_split_part(spark):
    from costloom.functions.columns import second_part
    texts = ["", ":", "a", "a:", ":b", "a:b", "a:b:c", "::c", "APS1-SpotUsage:c5.large", "\u00e9:\u00fc\U0001F600:x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", second_part(F.col("t"), ":").alias("got"), F.split_part("t", F.lit(":"), F.lit(2)).alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]


def test_transaction_grain_is_compiled(spark):
    """Each row computes the key of a fixture list once and no text is put in upper case or split by a pattern above
    the joins, and generated methods are no longer than what the JVM compiles."""
    from costloom.session import METHOD_LIMIT
    job = SummaryJob(FixtureCatalog(spark, SF001), "ESTIMATED", checkpoint=False)
    assert int(spark.conf.get(METHOD_LIMIT)) <= 8000
    plan = job.normalized._jdf.queryExecution().optimizedPlan().toString()
    assert "upper(" not in plan.split("\n")[0].lower() and "split_part" not in plan
    kind = dict(FX.DERIVED_VIEWS["usage_transaction"][0]["columns"])["lineitem_type"]
    assert FX.expr_for(kind, "spark").count("l_orderkey") == 1
    keys = [(k,) for k in (None, -1, 0, 1, 2, 3)]
    text = {d: FX.expr_for(FX._case("k", ["'a'", "''", "'c'"], "'z'"), d) for d in ("spark", "duckdb")}
    rows = spark.createDataFrame(keys, "k bigint").select(F.expr(text["spark"]).alias("got"), F.expr(text["duckdb"]).alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows] == ["z", "z", "a", "", "c", "z"]
