"""Test inputs shared by the Spark fixture catalog and the DuckDB oracle.

The reference ships no data; these definitions build its input tables from the driver's
testdata: the hourly bill (CUR) from ``events``, usage transactions from ``lineitem``,
resource ownership and tags from ``part``. Small configuration tables are fixed rows.
Each view is a list of ``(column, expression)`` pairs whose SQL text runs in both
Spark SQL and DuckDB; the few dialect differences are given as ``{dialect: text}``.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

ACCOUNT_IDS = ("082404710867", "100000000001", "100000000002", "100000000003")
HOSTING, DEV, PROD = ACCOUNT_IDS[1], ACCOUNT_IDS[2], ACCOUNT_IDS[3]

# CUR line-item type by ``key % 20`` (values 9..19 are plain usage).
LINE_ITEM_TYPES = ("RIFee", "SavingsPlanRecurringFee", "SavingsPlanCoveredUsage", "DiscountedUsage",
                   "Credit", "Fee", "SavingsPlanNegation", "Refund", "SavingsPlanUpfrontFee")
USAGE_TYPES = ("APS1-SpotUsage:c5.large", "APS1-SpotUsage:m5.xlarge", "BoxUsage:t3.micro")

DAILY_MONTH = 202401      # the month the CUR view covers
DETAIL_MONTH = 199801     # actual-transaction month used by detail / summary
ESTIMATED_MONTH = 199802  # the one month held by the estimated-transaction view


def money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(12,2)) AS DECIMAL(28,12))"


def _case(key: str, values, default: str) -> dict:
    """The value at place ``key``, ``default`` outside and for NULL. Spark looks it up: its CASE computes the key
    again for each arm, code too long for the JVM to compile."""
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return {"spark": f"coalesce(get(array({', '.join(values)}), CAST({key} AS INT)), {default})", "duckdb": f"CASE {key} {arms} ELSE {default} END"}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------------------------------
# derived views: (column, expression) lists
# ---------------------------------------------------------------------------------------

CUR_VIEW = {
    "source": "events",
    "where": None,
    "columns": [
        ("invoice_month", "CAST(extract(year FROM ts) * 100 + extract(month FROM ts) AS INT)"),
        ("bill_billing_entity", "CASE WHEN event_id % 41 = 0 THEN 'AWS Marketplace' ELSE 'AWS' END"),
        ("bill_bill_type", "CASE WHEN event_id % 29 = 0 THEN 'Purchase' ELSE 'Anniversary' END"),
        ("bill_invoice_id", "CASE WHEN event_id % 97 = 0 THEN '' ELSE 'INV1' END"),
        ("line_item_usage_account_id", _case("user_id % 4", [_q(a) for a in ACCOUNT_IDS], "NULL")),
        ("line_item_usage_start_date", {
            "spark": "make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), 0, 0)",
            "duckdb": "date_trunc('hour', ts)"}),
        ("line_item_line_item_type", _case("event_id % 20", [_q(t) for t in LINE_ITEM_TYPES], "'Usage'")),
        ("line_item_usage_type", _case("event_id % 7", [_q(t) for t in USAGE_TYPES], "'DataTransfer-Out-Bytes'")),
        ("line_item_resource_id", "concat('r-', CAST(user_id AS STRING))"),
        ("line_item_line_item_description",
         "CASE WHEN event_id % 64 = 4 THEN 'Defensive credit for Company' ELSE event_type END"),
        ("line_item_unblended_rate", "CASE WHEN event_id % 2 = 0 THEN '' ELSE '0.0960' END"),
        ("line_item_unblended_cost", f"CASE WHEN event_id % 11 = 0 THEN CAST(0 AS DECIMAL(28,12)) ELSE {money('value')} END"),
        ("line_item_usage_amount", "CAST(1 + event_id % 24 AS DECIMAL(28,12))"),
        ("product_product_name",
         "CASE WHEN event_id % 31 = 0 THEN 'AWS Support (Business)' ELSE 'Amazon Elastic Compute Cloud' END"),
        ("product_instance_type", "CASE WHEN event_id % 7 = 2 THEN 't3.micro' ELSE '' END"),
        ("product_instance_type_family", "CASE WHEN event_id % 7 = 2 THEN 't3' ELSE '' END"),
        ("pricing_public_on_demand_rate", "CASE WHEN event_id % 2 = 1 THEN '' ELSE '0.1200' END"),
        ("pricing_public_on_demand_cost",
         "CASE WHEN event_id % 11 = 0 OR event_id % 7 < 2 OR event_id % 13 = 0 THEN CAST(0 AS DECIMAL(28,12)) "
         f"ELSE CAST({money('value')} * 1.5 AS DECIMAL(28,12)) END"),
        ("pricing_unit", "'Hrs'"),
        ("reservation_reservation_a_r_n", "concat('arn:', CAST(event_id % 5 AS STRING))"),
        ("savings_plan_savings_plan_a_r_n", "concat('sp-arn:', CAST(event_id % 3 AS STRING))"),
        ("resource_tags_user_company",
         _case("(event_id % 23) % 5", ["''", "'Company Regional'", "'Company Infrastructure'", "'Client A'"], "NULL")),
        ("resource_tags_user_product",
         _case("event_id % 9", ["'company.k8s.local'", "'companydev.k8s.local'", "'web'"], "''")),
        ("resource_tags_user_stage", "event_type"),
        ("resource_tags_user_name", "concat('i-', CAST(user_id % 10 AS STRING))"),
    ],
}

TRX_TYPES_20 = LINE_ITEM_TYPES + ("Usage",) * 10 + ("discountedusage",)

_TRX_COLUMNS = [
    ("usage_start_date", {
        "spark": "timestampadd(HOUR, CAST(l_orderkey % 24 AS INT), l_shipdate)",
        "duckdb": "l_shipdate + to_hours(CAST(l_orderkey % 24 AS BIGINT))"}),
    ("invoice_id", "concat('INV', CAST(l_partkey % 2 AS STRING))"),
    ("linked_account_id", _case("l_suppkey % 4", [_q(a) for a in ACCOUNT_IDS], "NULL")),
    ("resource_id", "concat('r-', CAST(l_partkey AS STRING))"),
    ("reservationarn", "concat('arn:', CAST(l_partkey % 5 AS STRING))"),
    ("product_name",
     "CASE WHEN l_orderkey % 31 = 0 THEN 'AWS Support (Business)' ELSE 'Amazon Elastic Compute Cloud' END"),
    ("item_description", "CASE WHEN l_orderkey % 37 = 0 THEN 'AWS Marketplace x' ELSE 'usage' END"),
    ("lineitem_type", _case("(l_orderkey * 7 + l_linenumber * 3 + l_partkey) % 20", [_q(t) for t in TRX_TYPES_20], "'Usage'")),
    ("usage_type", _case("l_orderkey % 7", [_q(t) for t in USAGE_TYPES], "'DataTransfer-Out-Bytes'")),
    ("pricing_unit", "'Hrs'"),
    ("unblended_cost", f"CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE {money('l_extendedprice')} END"),
    ("public_ondemand_cost",
     f"CASE WHEN l_orderkey % 13 = 0 THEN CAST(0 AS DECIMAL(28,12)) ELSE CAST({money('l_extendedprice')} * 1.5 AS DECIMAL(28,12)) END"),
    ("normalizationfactor", "CAST(l_linenumber AS DECIMAL(18,8))"),
    ("usage_quantity", money("l_quantity")),
]

TRX_VIEW = {"source": "lineitem", "where": None, "columns": _TRX_COLUMNS}

# Every line item, its ship date folded into the first 26 days of 1998-02: the estimated table
# holds one running month, so the jobs read all of it.
TRX_ESTIMATED_VIEW = {"source": "lineitem", "where": None, "columns": [
    ("usage_start_date", {
        "spark": "timestampadd(HOUR, CAST(l_orderkey % 24 + 24 * (datediff(l_shipdate, DATE '1992-01-01') % 26) AS INT), "
                 "TIMESTAMP_NTZ '1998-02-01 00:00:00')",
        "duckdb": "TIMESTAMP '1998-02-01 00:00:00' + to_hours(CAST(l_orderkey % 24 "
                  "+ 24 * (date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 26) AS BIGINT))"}),
    *_TRX_COLUMNS[1:]]}


def _reversed(sign: str) -> dict:
    """A charge (or its reversal) that leaves its group at zero cost (CHK8)."""
    own = {"lineitem_type": "'Usage'", "usage_type": "concat('Reversed-', CAST(l_orderkey AS STRING))", "product_name": "'Amazon Reversed'",
           "item_description": "'usage'",
           "unblended_cost": f"CAST({sign}{money('l_extendedprice')} AS DECIMAL(28,12))",
           "public_ondemand_cost": f"CAST({sign}{money('l_extendedprice')} AS DECIMAL(28,12))"}
    return {"source": "lineitem", "where": "l_linenumber = 1 AND l_orderkey % 20 = 0",
            "columns": [(n, own.get(n, e)) for n, e in _TRX_COLUMNS]}


def _ts(text: str) -> dict:
    return {"spark": f"TIMESTAMP_NTZ '{text}'", "duckdb": f"TIMESTAMP '{text}'"}


_RU_COMPANY = _case("p_partkey % 6", ["''", "'Company Regional'", "'company infrastructure'", "'Client A'", "' '"], "NULL")
_RU_PRODUCT = _case("p_partkey % 9", ["'company.k8s.local'", "'companydev.k8s.local'", "' web '"], "''")

# One ownership interval per part, split at 1998-01-15 00:00 for every 19th part
# (adjacent intervals share the boundary), open-ended (NULL end) for every 23rd part,
# plus an overlapping interval for every 17th part.
RESOURCE_USER_VIEWS = [
    {"source": "part", "where": None, "columns": [
        ("resource_id", "concat('r-', CAST(p_partkey AS STRING))"),
        ("resource_start_dt", _ts("1990-01-01 00:00:00")),
        ("resource_end_dt", {d: f"CASE WHEN p_partkey % 23 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN {_ts('1998-01-15 00:00:00')[d]} "
                                f"ELSE {_ts('2030-01-01 00:00:00')[d]} END" for d in ("spark", "duckdb")}),
        ("user_name", "concat('i-', CAST(p_partkey % 10 AS STRING))"),
        ("user_company", _RU_COMPANY),
        ("user_product", _RU_PRODUCT),
    ]},
    {"source": "part", "where": "p_partkey % 19 = 0", "columns": [
        ("resource_id", "concat('r-', CAST(p_partkey AS STRING))"),
        ("resource_start_dt", _ts("1998-01-15 00:00:00")),
        ("resource_end_dt", _ts("2030-01-01 00:00:00")),
        ("user_name", "concat('i-', CAST(p_partkey % 10 AS STRING))"),
        ("user_company", "'Client C'"),
        ("user_product", "'svc'"),
    ]},
    {"source": "part", "where": "p_partkey % 17 = 0", "columns": [
        ("resource_id", "concat('r-', CAST(p_partkey AS STRING))"),
        ("resource_start_dt", _ts("1998-01-10 00:00:00")),
        ("resource_end_dt", _ts("1998-01-20 23:00:00")),
        ("user_name", "concat('i-', CAST(p_partkey % 10 AS STRING))"),
        ("user_company", "'Client B'"),
        ("user_product", "'overlap'"),
    ]},
]

RESOURCE_TAG_VIEWS = [
    {"source": "part", "where": "p_partkey % 7 = 0", "columns": [
        ("resource_id", "concat('r-', CAST(p_partkey AS STRING))"),
        ("user_company", "'Client B'"),
        ("user_product", "'tagged'"),
    ]},
    {"source": "part", "where": "p_partkey % 49 = 0", "columns": [
        ("resource_id", "concat('r-', CAST(p_partkey AS STRING))"),
        ("user_company", "'Client C'"),
        ("user_product", "'tagged2'"),
    ]},
]

DERIVED_VIEWS = {
    "cost_usage_report": [CUR_VIEW],
    "usage_transaction": [TRX_VIEW, _reversed(""), _reversed("-")],
    "usage_transaction_estimated": [TRX_ESTIMATED_VIEW],
    "resource_user": RESOURCE_USER_VIEWS,
    "resource_user_estimated": RESOURCE_USER_VIEWS,
    "resource_tag": RESOURCE_TAG_VIEWS,
}


def expr_for(e, dialect: str) -> str:
    return e[dialect] if isinstance(e, dict) else e


def view_sql(parts, dialect: str) -> str:
    """SQL text of a derived view (UNION ALL of its parts) in one dialect."""
    selects = []
    for p in parts:
        cols = ", ".join(f"{expr_for(e, dialect)} AS {n}" for n, e in p["columns"])
        s = f"SELECT {cols} FROM {p['source']}"
        if p["where"]:
            s += f" WHERE {expr_for(p['where'], dialect)}"
        selects.append(s)
    return " UNION ALL ".join(selects)


# ---------------------------------------------------------------------------------------
# fixed configuration rows
# ---------------------------------------------------------------------------------------

def _days(month: int):
    y, m = divmod(month, 100)
    d = dt.date(y, m, 1)
    while d.month == m:
        yield d
        d += dt.timedelta(days=1)


def _D(x) -> Decimal:
    return Decimal(str(x))


def _adhoc_rows():
    rows = []
    bid = 1
    for month in (DAILY_MONTH, DETAIL_MONTH, ESTIMATED_MONTH):
        days = list(_days(month))
        first, last, mid = days[0], days[-1], days[19]
        for acct, company, group, sched, start, end in (
                (HOSTING, "Client A", 1, 1, first, last),
                (HOSTING, "Client B", 1, 2, days[9], last),
                (HOSTING, "Client C", 2, 1, first, mid),
                (PROD, "Client D", 1, 1, first, last)):
            rows.append((bid, month, acct, company, group, sched, start, end))
            bid += 1
    return rows


def _schedule_rows():
    rows = []
    for day in ("SUN", "MON", "TUE", "WED", "THU", "FRI", "SAT"):
        for h in (20, 21, 22, 23):
            rows.append((1, day, h))
        if day in ("SAT", "SUN"):
            for h in range(8, 20):
                rows.append((1, day, h))
        for h in (21, 22, 23, 0, 1):
            rows.append((2, day, h))
    return rows


def _kube_usage_rows():
    rows = []
    for month, portions in ((DAILY_MONTH, ("0.5", "0.3", "0.2")),
                            (DETAIL_MONTH, ("0.4", "0.3", "0.2")),
                            (ESTIMATED_MONTH, ("0.5", "0.3", "0.2"))):
        for ns, p in zip(("ns-a", "ns-b", "ns-c"), portions):
            rows.append((month, "company.k8s.local", ns, _D(p)))
    return rows


def _upfront_rows():
    rows = []
    for d in _days(DAILY_MONTH):
        rows.append((DAILY_MONTH, HOSTING, "INV1", d, "Compute Savings Plan", "sp-arn:9", _D("10.25"), _D("24")))
        rows.append((DAILY_MONTH, DEV, "INV1", d, "Amazon EC2 Reserved Instance", "arn:7", _D("3.5"), _D("24")))
    return rows


def _rifee_amort_rows():
    rows = []
    for month in (DETAIL_MONTH, ESTIMATED_MONTH):
        for d in _days(month):
            rows.append((month, DEV, d, _D("5.00")))
            rows.append((month, HOSTING, d, _D("2.50")))
    return rows


CONFIG_TABLES = {
    "account_config": (
        [("account_id", "STRING"), ("account_display_name", "STRING"), ("default_cost_center", "STRING")],
        [(ACCOUNT_IDS[0], "Regional", "Company Regional"),
         (HOSTING, "Hosting", "company infrastructure"),
         (DEV, "Dev", "Client A"),
         (PROD, "Prod", "client b")]),
    "price_list": (
        [("product_instance_type", "STRING"), ("pricing_public_on_demand_rate", "DECIMAL(18,8)")],
        [("c5.large", _D("0.123456")), ("t3.micro", _D("0.0104"))]),
    "rifee": (
        [("ri_reservationarn", "STRING"), ("invoice_id", "STRING"), ("ri_normalizationfactor", "DECIMAL(18,8)")],
        [(f"arn:{i}", inv, _D(f)) for inv, fs in (("INV0", (0, 4, 8, 2, 16)), ("INV1", (1, 0, 4, 8, 2)))
         for i, f in enumerate(fs)]),
    "rifee_estimated": (
        [("ri_reservationarn", "STRING"), ("invoice_id", "STRING"), ("ri_normalizationfactor", "DECIMAL(18,8)")],
        [("arn:1", "INV0", _D(4)), ("arn:2", "INV0", _D(8)), ("arn:3", "INV0", _D(2)),
         ("arn:4", "INV0", _D(16)), ("arn:4", "INV1", _D(16))]),
    "adhoc_billing": (
        [("adhoc_billing_id", "INT"), ("invoice_month", "INT"), ("account_id", "STRING"), ("user_company", "STRING"),
         ("instance_group_id", "INT"), ("schedule_id", "INT"), ("start_date", "DATE"), ("end_date", "DATE")],
        _adhoc_rows()),
    "adhoc_billing_instance": (
        [("instance_group_id", "INT"), ("instance_name", "STRING")],
        [(1, "i-1"), (2, "i-3")]),
    "adhoc_billing_schedule_hours": (
        [("schedule_id", "INT"), ("weekday", "STRING"), ("hour", "INT")],
        _schedule_rows()),
    "kube_monthly_namespace_usage": (
        [("month_id", "INT"), ("cluster_name", "STRING"), ("kube_namespace", "STRING"), ("usage_portion", "DECIMAL(18,8)")],
        _kube_usage_rows()),
    "kube_namespace_product_mapping": (
        [("kube_namespace", "STRING"), ("company", "STRING"), ("company_product", "STRING")],
        [("ns-a", "Client A", "APP1"), ("ns-b", "Client A", "APP1"), ("ns-d", "Client B", "APP2")]),
    "upfront_purchases_amortization_schedule": (
        [("invoice_month", "INT"), ("usage_account_id", "STRING"), ("invoice_id", "STRING"), ("usage_date", "DATE"),
         ("product_name", "STRING"), ("reservation_arn", "STRING"), ("amount", "DECIMAL(18,8)"),
         ("quantity", "DECIMAL(18,8)")],
        _upfront_rows()),
    "rifee_amortization_schedule": (
        [("invoice_month", "INT"), ("account_id", "STRING"), ("usage_date", "DATE"), ("rifee", "DECIMAL(18,8)")],
        _rifee_amort_rows()),
    "azure_cost_summary": (
        [("billing_period", "INT"), ("tag_company", "STRING"), ("retail_cost", "DECIMAL(18,2)")],
        [(p, co, _D(v)) for p in (DAILY_MONTH, DETAIL_MONTH, ESTIMATED_MONTH)
         for co, v in (("CLIENT A", "1200.50"), ("AZURE ONLY CO", "800.25"), ("COMPANY INFRASTRUCTURE", "300.00"))]),
}


def _literal(v, typ: str) -> str:
    if v is None:
        return f"CAST(NULL AS {typ})"
    if typ == "STRING":
        return _q(v)
    if typ == "INT":
        return str(int(v))
    if typ == "DATE":
        return f"DATE '{v.isoformat()}'"
    if typ.startswith("DECIMAL"):
        return f"CAST('{v}' AS {typ})"
    raise ValueError(typ)


def config_values_sql(name: str, dialect: str = "duckdb") -> str:
    """SELECT over the fixed rows of one configuration table (an inline VALUES table, so
    Spark plans it as a local relation with exact size statistics)."""
    cols, rows = CONFIG_TABLES[name]
    body = ", ".join("(" + ", ".join(_literal(v, t) for v, (_, t) in zip(r, cols)) + ")" for r in rows)
    names = ", ".join(n for n, _ in cols)
    text = "VARCHAR" if dialect == "duckdb" else "STRING"
    casts = ", ".join(f"CAST({n} AS {text if t == 'STRING' else t}) AS {n}" for n, t in cols)
    return f"SELECT {casts} FROM (VALUES {body}) AS v({names})"
