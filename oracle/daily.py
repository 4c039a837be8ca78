"""DuckDB SQL of the daily job's stages."""

from __future__ import annotations

from costloom.sources import fixture_defs as FX
from oracle import sqltext as T

MEASURES = ("line_item_unblended_cost", "pricing_public_on_demand_cost", "line_item_usage_amount")
_MONEY = {m: T.MONEY for m in MEASURES}
# FIXED VALUES: the bill's columns that pass as they are.
COPIED = (
    "invoice_month", "bill_billing_entity", "line_item_usage_account_id", "bill_invoice_id", "line_item_usage_start_date",
    "line_item_line_item_type", "line_item_usage_type", "line_item_unblended_rate", "line_item_line_item_description",
    "line_item_resource_id", "reservation_reservation_a_r_n", "savings_plan_savings_plan_a_r_n", "product_product_name",
    "product_instance_type", "product_instance_type_family", "pricing_public_on_demand_rate", "pricing_unit", "resource_tags_user_name",
)
SHARED = (f"r.bill_billing_entity = 'AWS' AND r.usage_account_name = '{T.SHARED_ACCOUNT}' AND r.resource_tags_user_company = '{T.SHARED_COMPANY}'")
SPOT = "r.line_item_line_item_type = 'Usage' AND contains(r.line_item_usage_type, 'Spot')"


def steps(month: int = FX.DAILY_MONTH, scope: str = "instance") -> T.Steps:
    s = T.Steps()
    sums = ", ".join(f"CAST(sum({m}) AS {T.MONEY}) AS {m}" for m in MEASURES)
    upper = ", ".join(f"upper(b.resource_tags_user_{x}) AS resource_tags_user_{y}" for x, y in (
        ("product", "product"), ("company", "company_original"), ("product", "product_original"), ("stage", "stage")))
    # how a line's two costs follow from the bill's; types without a rule take (bill, list)
    s.add(cost_rules="SELECT * FROM (VALUES ('SavingsPlanCoveredUsage', 'nothing', 'list'), ('Credit', 'bill', 'bill')) t(kind, cost, list)",
          bill_lines=f"""SELECT {', '.join('b.' + x for x in COPIED)}, a.account_display_name AS usage_account_name,
                upper(coalesce(nullif(b.resource_tags_user_company, ''), a.default_cost_center)) AS resource_tags_user_company, {upper},
                if(c.cost = 'nothing', 0, b.line_item_unblended_cost) AS line_item_unblended_cost,
                if(starts_with(b.product_product_name, 'AWS Support') OR c.list = 'bill', b.line_item_unblended_cost,
                   b.pricing_public_on_demand_cost) AS pricing_public_on_demand_cost, b.line_item_usage_amount, '' AS note
            FROM account_config a JOIN cost_usage_report b ON b.line_item_usage_account_id = a.account_id AND b.invoice_month = {month}
            LEFT JOIN cost_rules c ON c.kind = b.line_item_line_item_type
            WHERE NOT list_contains({list(T.NO_DAILY)}, b.line_item_line_item_type)
              AND (b.line_item_line_item_type <> 'Fee' OR b.bill_bill_type <> 'Purchase')
              AND (b.line_item_line_item_type <> 'Credit' OR b.line_item_line_item_description <> 'Defensive credit for Company')""",
          hours=f"SELECT * EXCLUDE ({', '.join(MEASURES)}), {sums} FROM bill_lines GROUP BY ALL",
          clocked=f"""SELECT *, max(line_item_usage_start_date) FILTER (WHERE line_item_line_item_type <> '{T.RUNNING_FEE}') OVER () AS clock FROM hours""",
          clock_row="SELECT max(clock) AS clock FROM clocked",
          invoiced="SELECT if(bool_or(coalesce(bill_invoice_id, '') = ''), 'ESTIMATED', 'ACTUAL') AS trx_source FROM hours",
          running=f"""SELECT * EXCLUDE (clock) FROM clocked
            WHERE (line_item_line_item_type = '{T.RUNNING_FEE}' AND line_item_usage_start_date > clock) IS NOT TRUE""",
          sized=f"""SELECT r.* REPLACE (if({SPOT}, split_part(r.line_item_usage_type, ':', 2), r.product_instance_type) AS product_instance_type,
                if({SPOT}, split_part(split_part(r.line_item_usage_type, ':', 2), '.', 1), r.product_instance_type_family)
                  AS product_instance_type_family) FROM running r""",
          priced=f"""SELECT r.* REPLACE (coalesce(p.rate::VARCHAR, r.pricing_public_on_demand_rate) AS pricing_public_on_demand_rate,
                if(p.size IS NULL, r.pricing_public_on_demand_cost, CAST(p.rate * r.line_item_usage_amount AS {T.MONEY})) AS pricing_public_on_demand_cost)
            FROM sized r LEFT JOIN (SELECT product_instance_type AS size, pricing_public_on_demand_rate AS rate FROM price_list) p
              ON p.size = r.product_instance_type AND {SPOT}""",
          unpriced="""SELECT product_instance_type AS instance_size FROM sized
            WHERE contains(line_item_usage_type, 'SpotUsage') AND line_item_line_item_type = 'Usage'
              AND product_instance_type IS NOT NULL
            EXCEPT SELECT product_instance_type FROM price_list""",
          costing="SELECT * FROM priced WHERE (line_item_unblended_cost = 0 AND pricing_public_on_demand_cost = 0) IS NOT TRUE",
          fee_days="SELECT r.*, r.line_item_usage_start_date::DATE AS day0, c.clock FROM costing r CROSS JOIN clock_row c",
          sliced="SELECT * EXCLUDE (day0, clock) FROM (" + T.daily_slices(
              "fee_days", "line_item_line_item_type = 'RIFee'", "line_item_usage_start_date + to_days({}::INTEGER) AS line_item_usage_start_date",
              ("line_item_unblended_cost", "line_item_usage_amount"), "AMORTIZED NON-UPFRONT RI FEE") + ")")
    T.off_hours(s, month, scope)
    s.add(paid=T.to_payers("sliced", "line_item_usage_account_id", "resource_tags_user_name", "line_item_usage_start_date", "line_item_line_item_type",
                           "resource_tags_user_company", _MONEY, T.FEES, "REALLOCATED AD HOC USAGE"),
          days=f"""SELECT * EXCLUDE (line_item_usage_start_date, {', '.join(MEASURES)}), line_item_usage_start_date::DATE AS line_item_usage_date, {sums}
            FROM paid GROUP BY ALL""",
          filled=f"""SELECT * REPLACE (if(pricing_public_on_demand_cost = 0 AND line_item_line_item_type NOT IN {T.quoted(T.FEES)},
                line_item_unblended_cost, pricing_public_on_demand_cost) AS pricing_public_on_demand_cost) FROM days""",
          cluster_shares=T.cluster_shares(month, "concat('REALLOCATED K8 COSTS (', upper(u.cluster_name), ')')"),
          clusters_billed=f"""SELECT count(*) > 0 AS yes FROM filled WHERE line_item_usage_account_id = '{T.REGION_ACCOUNT}'
            AND resource_tags_user_company = '{T.REGION_COMPANY}' AND resource_tags_user_product IN {T.quoted(T.CLUSTERS)}""",
          clustered=T.split_over("filled", "(SELECT * FROM cluster_shares WHERE (SELECT yes FROM clusters_billed))",
                                 f"s.cluster = r.resource_tags_user_product AND r.line_item_usage_account_id = '{T.REGION_ACCOUNT}' "
                                 f"AND r.resource_tags_user_company = '{T.REGION_COMPANY}'", _MONEY,
                                 {"resource_tags_user_company": "s.user_company", "resource_tags_user_product": "s.user_product", "note": "s.note"}),
          purchases=f"""SELECT p.invoice_month, 'AWS' AS bill_billing_entity, p.usage_account_id AS line_item_usage_account_id,
                a.account_display_name AS usage_account_name, p.invoice_id AS bill_invoice_id, p.usage_date AS line_item_usage_date,
                k.kind AS line_item_line_item_type, p.reservation_arn AS reservation_reservation_a_r_n, p.product_name AS product_product_name,
                '' AS pricing_unit, '{T.REGION_COMPANY}' AS resource_tags_user_company, '' AS resource_tags_user_product,
                '{T.REGION_COMPANY}' AS resource_tags_user_company_original, '' AS resource_tags_user_product_original,
                CAST(p.amount AS {T.MONEY}) AS line_item_unblended_cost, CAST(0 AS {T.MONEY}) AS pricing_public_on_demand_cost,
                CAST(p.quantity AS {T.MONEY}) AS line_item_usage_amount, k.note
            FROM account_config a JOIN upfront_purchases_amortization_schedule p ON p.usage_account_id = a.account_id
            JOIN (VALUES (TRUE, 'SavingsPlanUpfrontFee', 'AMORTIZED UPFRONT SP FEE'),
                         (FALSE, 'ReservedInstanceUpfrontFee', 'AMORTIZED UPFRONT RI FEE')) k(plan, kind, note)
              ON k.plan = coalesce(contains(p.product_name, 'Savings Plan'), FALSE)
            JOIN clock_row c ON p.usage_date <= c.clock::DATE
            WHERE p.invoice_month = {month}""",
          with_fees="SELECT * FROM clustered UNION ALL BY NAME SELECT * FROM purchases",
          cloud_costs=f"""SELECT cost_source, resource_tags_user_company, CAST(sum(cost) AS {T.MONEY}) AS pricing_public_on_demand_cost FROM (
                SELECT bill_billing_entity AS cost_source, resource_tags_user_company, pricing_public_on_demand_cost AS cost FROM with_fees
                WHERE bill_billing_entity = 'AWS' AND usage_account_name = '{T.SHARED_ACCOUNT}' AND resource_tags_user_company <> '{T.SHARED_COMPANY}'
                UNION ALL SELECT 'AZURE', tag_company, retail_cost FROM azure_cost_summary WHERE billing_period = {month}) GROUP BY ALL""",
          cloud_shares=f"""SELECT *, CAST(pricing_public_on_demand_cost::DOUBLE / (sum(pricing_public_on_demand_cost) OVER ())::DOUBLE AS {T.SHARE}) AS retail_weight
            FROM cloud_costs""",
          spread=T.split_over("with_fees", "(SELECT *, retail_weight AS share FROM cloud_shares)", SHARED, _MONEY,
                              {"resource_tags_user_company": "s.resource_tags_user_company",
                               "note": "concat('REALLOCATED INFRA COSTS (', s.cost_source, ')')"}, lost=SHARED),
          daily_rows="""SELECT * REPLACE (CAST(nullif(line_item_unblended_rate, '') AS DECIMAL(19,10)) AS line_item_unblended_rate,
                CAST(nullif(pricing_public_on_demand_rate, '') AS DECIMAL(19,10)) AS pricing_public_on_demand_rate) FROM spread""")
    return s
