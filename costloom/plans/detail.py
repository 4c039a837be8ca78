"""RUN2: the monthly detail job. Usage transactions of one month -> tagged, spot-repriced,
off-hours reallocated detail rows; Hosting infrastructure spread over AWS and Azure
companies; one month replaced in the target.

The interval join to resource owners (JOI4) is the only join of two large inputs; it is
an equi join on ``resource_id`` with a range residual, so AQE's skew handling applies to
a hot resource. The rolled-up stage is materialised: the infra weights and the infra
split both read it."""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.checks.gates import Gate
from costloom.operators import adhoc as ADH
from costloom.operators import fees as FEES
from costloom.operators import infra as INF
from costloom.operators import rollup as R
from costloom.operators import spot as SPT
from costloom.operators.calendar import month_calendar
from costloom.operators.normalize import latest_month, normalize_detail, transaction_rows
from costloom.plans.job import MonthJob
from costloom.sources.catalog import Catalog


def resolve_latest(cat: Catalog, invoice_month: int | None, estimated: bool = False) -> int | None:
    """MON2: NULL/0 -> the latest month present in the transactions (None if there are none)."""
    if invoice_month:
        return int(invoice_month)
    trx = cat.usage_transaction_estimated if estimated else cat.usage_transaction
    return latest_month(trx).first()["invoice_month"]


class DetailJob(MonthJob):
    label = "detail"

    @cached_property
    def month(self) -> int | None:
        """A month that is not given is looked up, which is an action."""
        return resolve_latest(self.cat, self.invoice_month)

    def _scalar_rows(self) -> DataFrame:
        return transaction_rows(self.cat.usage_transaction, self.cat.account_config, self.month).agg(F.count(F.lit(1)).alias("rows"))

    def latest_month(self) -> DataFrame:
        return latest_month(self.cat.usage_transaction)

    def normalized(self) -> DataFrame:
        c = self.cat
        return normalize_detail(c.usage_transaction, c.account_config, c.rifee, c.resource_user,
                                c.resource_tag, self.month, keep=self._keep)

    def after_spot(self) -> DataFrame:
        return SPT.reprice_spot_detail(self.normalized(), self.cat.price_list, self._watch)

    def after_zero(self) -> DataFrame:
        return FEES.drop_rounded_zero(self.after_spot(), "retail_cost", 8)

    @cached_property
    def _alloc(self) -> DataFrame:
        sched = ADH.adhoc_schedule(self.cat.adhoc_billing, self.cat.adhoc_billing_instance,
                                   self.cat.adhoc_billing_schedule_hours, month_calendar(self.spark, self.month),
                                   self.month)
        return self._keep(ADH.adhoc_weights(sched, self.adhoc_scope), "adhoc")

    def adhoc_alloc(self) -> DataFrame:
        return self._alloc

    def after_adhoc(self) -> DataFrame:
        return ADH.reallocate_adhoc(self.after_zero(), self.adhoc_alloc(), account_col="account_id",
                                    name_col="user_name", ts_col="usage_date_hour", type_col="lineitem_type",
                                    company_col="user_company",
                                    measures={"retail_cost": K.DEC38_8, "quantity": K.MONEY},
                                    skip_types=K.DETAIL_ADHOC_SKIPPED_TYPES, note=K.NOTE_ADHOC_DETAIL, cfg=self.cfg)

    @cached_property
    def rolled(self) -> DataFrame:
        return self._keep(R.detail_rollup(self.after_adhoc(), self.cat.account_config), "final")

    def infra_weights(self) -> DataFrame:
        return INF.infra_weights_monthly(self.rolled, self.cat.azure_cost_summary, self.month, self.cfg)

    @cached_property
    def infra_alloc(self) -> DataFrame:
        return self._keep(self.infra_weights(), "infra")

    def after_infra(self) -> DataFrame:
        return INF.redistribute_infra_detail(self.rolled, self.infra_alloc, self.cfg)

    def output(self) -> DataFrame:
        return R.detail_output(self.after_infra())

    def gates(self, written: DataFrame) -> list[Gate]:
        """Infra weights add up to one (CHK3); the written shares hold the cost that was split, less the
        share of infrastructure itself, which the job drops (CHK4). Rows are written at four places."""
        return [*self.adhoc_gates(), *self.infra_gates(self.rolled, written.where(F.col("note") == K.NOTE_INFRA_DETAIL), ("retail_cost",), Decimal("0.00005"))]

    def _empty(self) -> dict | None:
        """Before anything else, as a run over no transactions has no month either."""
        if self.month is not None and self.scalars["rows"]:
            return None
        return {"invoice_month": self.month, "row_count": 0, "error": "No transactions exist" if self.month is None else f"No transactions for invoice month {self.month}"}

    def _status(self) -> dict:
        return {"invoice_month": self.month, "error": ""}
