"""What the three jobs share: stages, facts gathered while they are written, gates, publishing.

Building ``output()`` writes stages and runs no other action: scalars (row count, billing state, last
transaction time, month) are a one-row stage that the plan reads through scalar subqueries, guards and
the uniqueness of lookup keys are part of the plan. ``run`` publishes the month after its gates hold.

Figures that a run reports are gathered by ``DataFrame.observe`` in passes that run anyway. Sums and
counts are taken at the top of a written stage (tasks of the last stage count once, also when an
executor is lost); a set of names may be gathered anywhere, as a repeated task adds nothing to it."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from costloom.checks import reconcile as CHK
from costloom.checks.gates import Gate, check_all
from costloom.operators import adhoc as ADH
from costloom.operators import infra as INF
from costloom.plans.sink import replace_month
from costloom.plans.stats import stats_columns
from costloom.session import compile_joins, materialize, remove_stages
from costloom.settings import DEFAULTS, Settings
from costloom.sources.catalog import Catalog


@dataclass(frozen=True)
class Shares:
    """Infra weights: their total, and the total of those that the monthly jobs keep."""

    total: Decimal | None
    kept: Decimal
    rows: int

    def gate(self) -> Gate:
        """Each weight is rounded at 16 places."""
        return Gate("infra weights", self.total, Decimal(1 if self.rows else 0), Decimal("1e-12") + self.rows * Decimal("1e-16"))


class MonthJob:
    """A job over one invoice month. ``label`` names its stages, ``invoice_col`` the output column that
    tells whether a row is invoiced."""

    label = "job"
    invoice_col: str | None = None

    def __init__(self, catalog: Catalog, invoice_month: int | None, adhoc_scope: str = "instance",
                 checkpoint: bool = True, settings: Settings = DEFAULTS):
        self.cat = catalog
        self.spark = catalog.spark
        compile_joins(self.spark)
        self.invoice_month = invoice_month
        self.adhoc_scope = adhoc_scope
        self.checkpoint = checkpoint
        self.cfg = settings
        self.stages: list[str] = []
        self._watched: dict[str, Observation] | None = None

    # -- stages and facts -----------------------------------------------------------------
    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, f"{self.label}-{name}", self.stages) if self.checkpoint else df

    def _watch(self, df: DataFrame, name: str, *facts: Column) -> DataFrame:
        """``df``, in a run with facts about its rows that are gathered as they pass."""
        if self._watched is None:
            return df
        self._watched[name] = Observation(f"{self.label}-{name}")
        return df.observe(self._watched[name], *facts)

    def _fact(self, name: str) -> dict:
        return dict(self._watched[name].get)

    def _release(self) -> None:
        """Remove the staged tables and forget everything computed from the inputs (the job can
        run again and sees them as they are then)."""
        remove_stages(self.spark, self.stages)
        self._watched = None
        for k in [k for k in self.__dict__ if isinstance(getattr(type(self), k, None), cached_property)]:
            del self.__dict__[k]

    # -- scalars --------------------------------------------------------------------------
    def _scalar_rows(self) -> DataFrame:
        """One row of the scalars that the plan needs first."""
        raise NotImplementedError

    @cached_property
    def scalars_frame(self) -> DataFrame:
        return self._keep(self._scalar_rows(), "scalars")

    def scalar(self, name: str) -> Column:
        """A scalar of the job as part of the plan."""
        return self.scalars_frame.select(name).scalar()

    @cached_property
    def scalars(self) -> dict:
        """The scalars on the driver (an action: for reports and callers, not for the plan)."""
        return self.scalars_frame.first().asDict()

    @property
    def last_trx(self) -> Column:
        return self.scalar("last_trx")

    # -- run ------------------------------------------------------------------------------
    def output(self) -> DataFrame:
        raise NotImplementedError

    def gates(self, written: DataFrame) -> list[Gate]:
        """Invariants of the run, given the rows that are about to be published."""
        return []

    def adhoc_gates(self) -> list[Gate]:
        """CHK1 / CHK2: with weights by account, each slot's weights add up to one, so no off-hours cost is
        made or lost. Weights by instance name over-allocate on purpose."""
        if self.adhoc_scope != "account":
            return []
        off = CHK.adhoc_weight_totals(self.adhoc_alloc()).agg(F.max(F.abs(F.col("total_weight") - 1)).alias("off")).first()["off"]
        return [Gate("off-hours weights of a slot", off, Decimal(0), Decimal("1e-12"))]

    def infra_split(self, final: DataFrame, measures: tuple[str, ...]) -> tuple[dict, Shares]:
        """Per measure of a monthly job's final stage the cost outside and inside the split, and the weights' total."""
        target = F.coalesce(INF.monthly_target(self.cfg), F.lit(False))
        sums = [F.sum(F.when(target == inside, F.col(m)).otherwise(0)).alias(f"{m}_{inside}") for m in measures for inside in (False, True)]
        row = final.agg(*sums).first()
        total = self.infra_alloc.agg(F.sum("weight").alias("all"), F.sum(F.when(F.col("user_company") == self.cfg.infra_company, F.col("weight"))).alias("own"),
                                     F.count(F.lit(1)).alias("rows")).first()
        shares = Shares(total["all"], (total["all"] or Decimal(0)) - (total["own"] or Decimal(0)), total["rows"])
        return {m: (row[f"{m}_False"] or Decimal(0), row[f"{m}_True"] or Decimal(0)) for m in measures}, shares

    def infra_gates(self, final: DataFrame, shared: DataFrame, measures: tuple[str, ...], rounding: Decimal) -> list[Gate]:
        """The rows of ``shared`` hold the cost that was split."""
        before, shares = self.infra_split(final, measures)
        after = shared.agg(F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in measures]).first()
        # every share is rounded, and shares that round to nothing are not written
        parts = final.where(INF.monthly_target(self.cfg)).count() * max(self.infra_alloc.count(), 1)
        return [shares.gate(), *[Gate(f"infra {m}", after[m], target * shares.kept, rounding * max(parts, 1)) for m, (_, target) in before.items()]]

    def _empty(self) -> dict | None:
        """The status of a run without input rows."""
        raise NotImplementedError

    def _status(self) -> dict:
        raise NotImplementedError

    def report(self) -> dict:
        """Spot sizes without a price, and per account the companies that off-hours costs go to."""
        rows = ADH.adhoc_companies(self.cat.adhoc_billing, self._month_number()).orderBy("account_id").collect()
        return {"unmapped_spot_sizes": sorted(self._fact("spot").get("unmapped") or []),
                "adhoc_companies": {r["account_id"]: r["user_company"] for r in rows}}

    def _month_number(self) -> int:
        return self.month

    def run(self, target: str | None = None) -> dict:
        """Computes the month and replaces it in ``target`` once the gates hold; without a target
        it is computed for the report only."""
        try:
            self._watched = {}
            nothing = self._empty()
            if nothing is not None:
                return nothing
            status = self._status()
            out = self.output().withColumn("t_created_date", F.current_timestamp().cast("timestamp_ntz"))
            out = self._watch(out, "output", *stats_columns(self.invoice_col))
            if target:
                replace_month(out, target, self._month_number(), lambda rows: check_all(self.gates(rows)), lambda: self._fact("output"))
            else:
                out.write.format("noop").mode("overwrite").save()
            return status | self._fact("output") | self.report()
        finally:
            self._release()
