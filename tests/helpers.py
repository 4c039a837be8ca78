"""Hand-made bill / transaction rows for edge-case tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from costloom.sources import fixture_defs as FX

CUR_COLUMNS = [
    ("invoice_month", "INT", 202401), ("bill_billing_entity", "STRING", "AWS"),
    ("bill_bill_type", "STRING", "Anniversary"), ("bill_invoice_id", "STRING", "INV1"),
    ("line_item_usage_account_id", "STRING", FX.DEV),
    ("line_item_usage_start_date", "TIMESTAMP_NTZ", dt.datetime(2024, 1, 10, 10)),
    ("line_item_line_item_type", "STRING", "Usage"), ("line_item_usage_type", "STRING", "BoxUsage:t3.micro"),
    ("line_item_resource_id", "STRING", "r-1"), ("line_item_line_item_description", "STRING", "x"),
    ("line_item_unblended_rate", "STRING", ""), ("line_item_unblended_cost", "DECIMAL(28,12)", Decimal("10")),
    ("line_item_usage_amount", "DECIMAL(28,12)", Decimal("1")),
    ("product_product_name", "STRING", "Amazon Elastic Compute Cloud"),
    ("product_instance_type", "STRING", ""), ("product_instance_type_family", "STRING", ""),
    ("pricing_public_on_demand_rate", "STRING", ""),
    ("pricing_public_on_demand_cost", "DECIMAL(28,12)", Decimal("15")),
    ("pricing_unit", "STRING", "Hrs"), ("reservation_reservation_a_r_n", "STRING", "arn:1"),
    ("savings_plan_savings_plan_a_r_n", "STRING", ""), ("resource_tags_user_company", "STRING", "Client A"),
    ("resource_tags_user_product", "STRING", "web"), ("resource_tags_user_stage", "STRING", "prod"),
    ("resource_tags_user_name", "STRING", "i-9"),
]
CUR_SCHEMA = ", ".join(f"{n} {t}" for n, t, _ in CUR_COLUMNS)


def cur_rows(spark, *rows: dict):
    data = []
    for r in rows:
        unknown = set(r) - {n for n, _, _ in CUR_COLUMNS}
        assert not unknown, unknown
        data.append(tuple(r.get(n, d) for n, _, d in CUR_COLUMNS))
    return spark.createDataFrame(data, CUR_SCHEMA)


def ts(*a) -> dt.datetime:
    return dt.datetime(*a)


def D(x) -> Decimal:
    return Decimal(str(x))
