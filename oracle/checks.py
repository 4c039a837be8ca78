"""DuckDB SQL for the reconciliation checks, over the steps of the jobs' oracle."""

from __future__ import annotations

from oracle import daily, monthly
from oracle.sqltext import FEES, comparable, quoted

M3 = daily.MEASURES


def chk1() -> str:
    local = "(line_item_usage_start_date + INTERVAL 7 HOUR)"
    rows = f"""SELECT line_item_usage_account_id AS account_id, resource_tags_user_name AS instance_name, {local}::DATE AS usage_date_bkk,
        hour{local} AS hour_bkk, line_item_unblended_cost AS cost, note, line_item_line_item_type AS kind"""
    s = daily.steps().add(
        before=f"{rows} FROM sliced", after=f"{rows} FROM paid WHERE note = 'REALLOCATED AD HOC USAGE'",
        moved=f"""SELECT account_id, instance_name, usage_date_bkk, hour_bkk, cost FROM before SEMI JOIN slot_shares s
              ON s.account_id = before.account_id AND s.instance_name = before.instance_name AND s.calendar_date = usage_date_bkk AND s.hour = hour_bkk
              WHERE kind NOT IN {quoted(FEES)}
            UNION ALL SELECT account_id, instance_name, usage_date_bkk, hour_bkk, -cost FROM after""",
        chk="""SELECT account_id, instance_name, usage_date_bkk, hour_bkk, round(sum(cost), 4) AS difference FROM moved GROUP BY ALL""")
    return s.final(comparable("chk", {"difference": 4}))


def chk3() -> str:
    return daily.steps().final(comparable("(SELECT sum(retail_weight) AS total_weight FROM cloud_shares)", {"total_weight": 8}))


def chk4() -> str:
    sums = ", ".join(f"round(sum({m}), 4) AS {m}" for m in M3)
    s = daily.steps().add(chk=f"""SELECT 'ORIGINAL' AS src, {sums} FROM with_fees r WHERE {daily.SHARED} HAVING count(*) > 0
        UNION ALL SELECT 'ALLOCATED', {sums} FROM spread WHERE starts_with(note, 'REALLOCATED INFRA COSTS (') HAVING count(*) > 0""")
    return s.final(comparable("chk", {m: 4 for m in M3}))


def chk5() -> str:
    s = monthly.summary_steps("ACTUAL").add(chk="""SELECT *, retail_cost - actual_cost AS savings, round(actual_cost - weighted_actual_cost, 6) AS actual_diff
        FROM (SELECT account_id, account_name, invoice_id, sum(actual_cost) AS actual_cost, sum(weighted_actual_cost) AS weighted_actual_cost,
                     sum(retail_cost) AS retail_cost, sum(retail_cost_percent) AS total_weight FROM weighted GROUP BY ALL)""")
    return s.final(comparable("chk", {"actual_cost": 4, "weighted_actual_cost": 4, "retail_cost": 4, "savings": 4, "actual_diff": 4, "total_weight": 8}))


def chk7() -> str:
    s = daily.steps().add(
        spots="""SELECT line_item_usage_type, product_instance_type, pricing_public_on_demand_rate, sum(line_item_usage_amount)::DOUBLE AS quantity,
            sum(line_item_unblended_cost)::DOUBLE AS unblended_cost, sum(pricing_public_on_demand_cost)::DOUBLE AS ondemand_cost, count(*) AS trx_cnt
          FROM priced WHERE line_item_line_item_type = 'Usage' AND contains(line_item_usage_type, 'SpotUsage') GROUP BY ALL""",
        chk="""SELECT *, unblended_cost / quantity AS unblended_rate_calc, ondemand_cost / quantity AS ondemand_rate_calc,
            1 - unblended_cost / nullif(ondemand_cost, 0) AS savings_percent FROM spots""")
    return s.final(comparable("chk", {x: 4 for x in ("quantity", "unblended_cost", "ondemand_cost", "unblended_rate_calc", "ondemand_rate_calc",
                                                      "savings_percent")}))


def chk8() -> str:
    s = monthly.detail_steps().add(chk="SELECT account_id, sum(quantity) AS quantity, count(*) AS n FROM grouped WHERE retail_cost = 0 GROUP BY ALL")
    return s.final(comparable("chk", {"quantity": 4}))


def chk9() -> str:
    s = daily.steps().add(chk="""SELECT line_item_usage_start_date::DATE AS usage_date, sum(line_item_unblended_cost) AS amort_unblended_cost
        FROM sliced WHERE note = 'AMORTIZED NON-UPFRONT RI FEE' GROUP BY ALL""")
    return s.final(comparable("chk", {"amort_unblended_cost": 4}))


def chk10() -> str:
    parts = [monthly.summary_steps(x).final("SELECT invoice_month, trx_source, count(*) AS n FROM summary_rows GROUP BY ALL") for x in ("ACTUAL", "ESTIMATED")]
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def stt1() -> str:
    return daily.steps().final("""SELECT if(bool_and(trim(coalesce(bill_invoice_id, '')) <> ''), 1, 0) AS is_invoiced, count(*) AS row_count
        FROM daily_rows HAVING count(*) > 0""")


def joi4() -> str:
    return monthly.detail_steps().final("SELECT user_name, user_company, usage_date, count(*) AS n FROM lines GROUP BY ALL")
