"""Per-job variants that must stay different (survey Q9, Q14, Q17, Q21) on fixture data."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF01
from costloom import constants as K
from costloom.settings import DEFAULTS
from costloom.plans.queries import daily_job, detail_job, summary_job


def test_q17_azure_infrastructure_share_daily_keeps_detail_drops(spark):
    daily = daily_job(spark, SF01).output()
    kept = daily.where((F.col("resource_tags_user_company") == DEFAULTS.infra_company)
                       & (F.col("note") == "REALLOCATED INFRA COSTS (AZURE)")).count()
    assert kept > 0
    detail = detail_job(spark, SF01).output()
    assert detail.where((F.col("account_name") == "Hosting") & (F.col("user_company") == DEFAULTS.infra_company)).count() == 0
    assert detail.where(F.col("note") == K.NOTE_INFRA_DETAIL).count() > 0


def test_q16_infra_weights_keyed_by_cloud_daily_company_monthly(spark):
    daily = {(r.cost_source, r.resource_tags_user_company) for r in daily_job(spark, SF01).infra_weights().collect()}
    assert ("AWS", "CLIENT A") in daily and ("AZURE", "CLIENT A") in daily
    monthly = [r.user_company for r in detail_job(spark, SF01).infra_weights().collect()]
    assert len(monthly) == len(set(monthly))


def test_q9_discounted_usage_folding(spark):
    detail_types = {r.lineitem_type for r in detail_job(spark, SF01).output().select("lineitem_type").distinct().collect()}
    assert "discountedusage" not in detail_types and "DiscountedUsage" not in detail_types
    summary = summary_job(spark, SF01, "ACTUAL").rolled()
    types = {r.lineitem_type for r in summary.select("lineitem_type").distinct().collect()}
    assert {"discountedusage", "DiscountedUsage"} <= types      # exact case kept in the summary


def test_q14_summary_drops_unweighted_kube_product_daily_keeps(spark):
    job = summary_job(spark, SF01, "ACTUAL")
    regional_dev = ((F.col("account_id") == DEFAULTS.regional_account_id) & (F.col("user_company") == DEFAULTS.regional_company)
                    & (F.col("user_product") == "COMPANYDEV.K8S.LOCAL"))
    before = job.rolled().where(regional_dev).count()
    after = job.after_kube().where(regional_dev).count()
    assert before > 0 and after == 0
    daily = daily_job(spark, SF01).after_kube()
    assert daily.where((F.col("resource_tags_user_product") == "COMPANYDEV.K8S.LOCAL")
                       & (F.col("resource_tags_user_company") == DEFAULTS.regional_company)).count() > 0


def test_q21_marketplace_rows_get_no_upfront_fee(spark):
    out = summary_job(spark, SF01, "ACTUAL").with_upfront()
    market = out.where(F.col("user_product") == DEFAULTS.marketplace_product).collect()
    assert market and all(r.weighted_upfront_rifee_actual_cost == 0 for r in market)
    others = out.where((F.col("account_id") == "100000000002") & (F.col("user_product") != DEFAULTS.marketplace_product))
    assert others.where(F.col("weighted_upfront_rifee_actual_cost") != 0).count() > 0


def test_jobs_take_other_names(spark):
    """Renaming the installation's accounts and companies in the inputs and in the settings alike
    changes nothing but the names."""
    from costloom.plans.daily import DailyJob
    from costloom.plans.detail import DetailJob
    from costloom.plans.summary import SummaryJob
    from costloom.settings import Settings
    from costloom.sources import fixture_defs as FX
    from costloom.sources.catalog import DictCatalog, FixtureCatalog, TABLES
    from conftest import SF001
    own = Settings(regional_account_id="555555555555", regional_company="ACME", kube_products=("K1.X", "K2.X"), hosting_account_name="Hub",
                   infra_company="ACME SHARED", marketplace_product="MARKET", marketplace_description_prefix="Bazaar")
    swap = {DEFAULTS.regional_account_id: own.regional_account_id, DEFAULTS.hosting_account_name: own.hosting_account_name}
    words = {"COMPANY REGIONAL": "ACME", "COMPANY INFRASTRUCTURE": "ACME SHARED", "COMPANYDEV.K8S.LOCAL": "K2.X", "COMPANY.K8S.LOCAL": "K1.X"}
    fx = FixtureCatalog(spark, SF001)

    def rename(df):
        for f in df.schema:
            if f.dataType.simpleString() == "string":
                col = F.col(f.name)
                new = F.regexp_replace(col, "^AWS Marketplace", "Bazaar")
                for a, b in {**swap, **words}.items():
                    new = F.when(F.upper(col) == a.upper(), F.lit(b)).otherwise(new)
                df = df.withColumn(f.name, new)
        return df

    other = DictCatalog(spark, {t: rename(fx.table(t)) for t in TABLES})
    money = {"daily": "line_item_unblended_cost", "detail": "retail_cost", "summary": "weighted_actual_cost"}
    for name, make in (("daily", lambda c, s: DailyJob(c, FX.DAILY_MONTH, settings=s)), ("detail", lambda c, s: DetailJob(c, FX.DETAIL_MONTH, settings=s)),
                       ("summary", lambda c, s: SummaryJob(c, "ACTUAL", FX.DETAIL_MONTH, settings=s))):
        note = ["note"] if name != "summary" else ["account_id"]
        a, b = (sorted((r[0], r[1], round(r[2], 4)) for r in make(c, s).output().groupBy(
            F.regexp_replace(note[0], "COMPANYDEV.K8S.LOCAL|K2.X|COMPANY.K8S.LOCAL|K1.X|555555555555|082404710867", "?").alias("k"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(money[name]).alias("m")).collect()) for c, s in ((fx, DEFAULTS), (other, own)))
        assert a == b, name


def test_run_tells_unmapped_sizes_companies_and_takes_a_mode(spark, scratch):
    import os

    import pytest
    target = os.path.join(scratch, "m")
    job = daily_job(spark, SF01)
    status = job.run(target, mode="process_data")
    assert status["unmapped_spot_sizes"] and status["adhoc_companies"] and status["row_count"] > 0
    again = daily_job(spark, SF01).run(target, mode="Stats_Only")
    assert again["row_count"] == status["row_count"]
    with pytest.raises(ValueError):
        job.run(target, mode="other")


def test_output_schemas(spark):
    """Columns and decimal types of the three outputs."""
    from costloom.plans.queries import summary_job as summary
    kinds = lambda df: {f.name: f.dataType.simpleString() for f in df.schema}
    d, t, s = kinds(daily_job(spark, SF01).output()), kinds(detail_job(spark, SF01).output()), kinds(summary(spark, SF01, "ACTUAL").output())
    assert (len(d), len(t), len(s)) == (28, 11, 13)   # run() adds t_created_date
    for m in ("line_item_unblended_cost", "pricing_public_on_demand_cost", "line_item_usage_amount"):
        assert d[m] == "decimal(38,15)"
    assert d["line_item_unblended_rate"] == d["pricing_public_on_demand_rate"] == "decimal(19,10)"
    assert all(k.startswith("decimal") for k in (t["retail_cost"], t["quantity"], s["actual_cost"], s["weighted_actual_cost"],
                                                 s["weighted_upfront_rifee_actual_cost"], s["retail_cost"], s["retail_cost_percent"]))
