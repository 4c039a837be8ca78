"""Building blocks of the oracle's DuckDB SQL: inputs, rule tables and allocation by shares.

The SQL is written from the operator inventory, not from the Spark code: what a line costs comes
from a rule table, months are ranges of time, totals are windows, and every reallocation
is one outer join to a table of shares.
"""

from __future__ import annotations

import datetime as dt

from costloom.sources import fixture_defs as FX

MONEY, MONEY8, SHARE = "DECIMAL(28,12)", "DECIMAL(38,8)", "DECIMAL(24,16)"

# FIXED VALUES: types, notes, products and placeholders that must equal the reference's.
NO_DAILY = ("SavingsPlanNegation", "SavingsPlanUpfrontFee", "Refund")
NO_MONTHLY = ("SavingsPlanNegation", "Fee", "SavingsPlanUpfrontFee", "Refund")
FEES = ("RIFee", "Fee", "SavingsPlanRecurringFee")
RUNNING_FEE = "SavingsPlanRecurringFee"
REGION_ACCOUNT, REGION_COMPANY = "082404710867", "COMPANY REGIONAL"
CLUSTERS = ("COMPANY.K8S.LOCAL", "COMPANYDEV.K8S.LOCAL")
SHARED_COMPANY, SHARED_ACCOUNT = "COMPANY INFRASTRUCTURE", "Hosting"


def quoted(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def first_days(month: int) -> tuple[dt.date, dt.date]:
    y, m = divmod(month, 100)
    return dt.date(y, m, 1), dt.date(y + m // 12, m % 12 + 1, 1)


def within(ts: str, month: int) -> str:
    a, b = first_days(month)
    return f"{ts} >= TIMESTAMP '{a} 00:00:00' AND {ts} < TIMESTAMP '{b} 00:00:00'"


class Steps:
    """Named query steps that end as one WITH statement."""

    def __init__(self) -> None:
        self.parts = [f"{n} AS ({FX.view_sql(p, 'duckdb')})" for n, p in FX.DERIVED_VIEWS.items()]
        self.parts += [f"{n} AS ({FX.config_values_sql(n)})" for n in FX.CONFIG_TABLES]

    def add(self, **steps: str) -> "Steps":
        self.parts += [f"{n} AS ({q})" for n, q in steps.items()]
        return self

    def final(self, select: str) -> str:
        return "WITH " + ",\n".join(self.parts) + "\n" + select


def comparable(rel: str, numeric: dict[str, int], columns: list[str] | None = None) -> str:
    """Final projection shared with the Spark side: numbers rounded, then DOUBLE."""
    base = f"(SELECT {', '.join(columns)} FROM {rel})" if columns else rel
    rounded = ", ".join(f"CAST(ROUND({c}, {p}) AS DOUBLE) AS {c}" for c, p in numeric.items())
    return f"SELECT *{f' REPLACE ({rounded})' if rounded else ''} FROM {base}"


def split_over(src: str, shares: str, on: str, measures: dict[str, str], labels: dict[str, str], lost: str | None = None) -> str:
    """Rows of ``src`` (as r) that meet rows of ``shares`` (as s, with a ``share``) become one row
    each, measures times share and ``labels`` set; the others stay. ``lost``: rows that go
    if they meet none."""
    new = [f"CASE WHEN s.share IS NULL THEN r.{m} ELSE CAST(r.{m} * s.share AS {t}) END AS {m}" for m, t in measures.items()]
    new += [f"CASE WHEN s.share IS NULL THEN r.{c} ELSE {e} END AS {c}" for c, e in labels.items()]
    keep = f" WHERE s.share IS NOT NULL OR ({lost}) IS NOT TRUE" if lost else ""
    return f"SELECT r.* REPLACE ({', '.join(new)}) FROM {src} r LEFT JOIN {shares} s ON {on}{keep}"


def off_hours(steps: Steps, month: int, scope: str) -> Steps:
    """``slot_shares``: who pays for an instance's hour; a slot's payers share it equally."""
    a, b = first_days(month)
    same = "USING (instance_name, calendar_date, hour)" if scope == "instance" else "USING (account_id, instance_name, calendar_date, hour)"
    return steps.add(
        slots=f"""SELECT p.account_id, p.user_company, g.instance_name, d.calendar_date, t.weekday, t.hour,
                count(*) OVER (PARTITION BY p.account_id, g.instance_name, d.calendar_date, t.hour) AS payers
            FROM (SELECT unnest(range(DATE '{a}', DATE '{b}', INTERVAL 1 DAY))::DATE AS calendar_date) d
            JOIN adhoc_billing p ON p.invoice_month = {month} AND d.calendar_date >= p.start_date AND d.calendar_date <= p.end_date
            JOIN adhoc_billing_schedule_hours t ON t.schedule_id = p.schedule_id AND t.weekday = upper(strftime(d.calendar_date, '%a'))
            JOIN adhoc_billing_instance g ON g.instance_group_id = p.instance_group_id""",
        slot_sizes="SELECT DISTINCT account_id, instance_name, calendar_date, hour, payers AS n FROM slots",
        slot_shares=f"""SELECT slots.account_id, instance_name, calendar_date, hour, user_company, CAST(1.0 / n AS {SHARE}) AS share
            FROM slots JOIN slot_sizes {same} WHERE slots.account_id IS NOT NULL""")


def to_payers(src: str, account: str, name: str, ts: str, kind: str, company: str, measures: dict[str, str], spared, note: str) -> str:
    local = f"(r.{ts} + INTERVAL 7 HOUR)"
    on = (f"s.account_id = r.{account} AND s.instance_name = r.{name} AND s.calendar_date = {local}::DATE AND s.hour = hour{local} "
          f"AND r.{kind} NOT IN {quoted(spared)}")
    return split_over(src, "slot_shares", on, measures, {company: "s.user_company", "note": f"'{note}'"})


def cluster_shares(month: int, note: str) -> str:
    return f"""SELECT upper(u.cluster_name) AS cluster, coalesce(m.company, '{REGION_COMPANY}') AS user_company,
            coalesce(m.company_product, upper(u.cluster_name)) AS user_product,
            if(m.company IS NULL, 'UNALLOCATED K8 COSTS (MISSING MAPPING)', {note}) AS note, CAST(sum(u.usage_portion) AS {SHARE}) AS share
        FROM kube_monthly_namespace_usage u LEFT JOIN kube_namespace_product_mapping m USING (kube_namespace)
        WHERE u.month_id = {month} GROUP BY ALL"""


def daily_slices(src: str, where: str, ts: str, measures: tuple[str, ...], note: str, extra: str = "") -> str:
    """Rows that match ``where`` once for each day to the month's end or the last transaction
    (column ``clock``), with an equal part of the measures."""
    parts = ", ".join(f"CAST({m}::DOUBLE / span AS {MONEY}) AS {m}" for m in measures)
    return f"""SELECT * FROM {src} WHERE ({where}) IS NOT TRUE
        UNION ALL BY NAME
        SELECT * EXCLUDE (span, k) REPLACE ({ts.format('k')}{extra.format('k')}, {parts}, '{note}' AS note)
        FROM (SELECT *, unnest(range(least(span, clock::DATE - day0 + 1))) AS k FROM (
            SELECT r.* EXCLUDE (day0), day0, (last_day(day0) - day0 + 1)::BIGINT AS span FROM {src} r WHERE {where}))"""
