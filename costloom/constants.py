"""Types and fixed business values shared by every job.

FIXED VALUES: the literals below must equal the reference's for right results
(account, company and product placeholders, line-item type names, note texts,
the off-hours offset and weekday codes). They are kept together, as text, in
natural order.
"""

from pyspark.sql.types import DecimalType

# --- working decimal types -------------------------------------------------------
MONEY = DecimalType(28, 12)          # cost / quantity inside the jobs
WEIGHT = DecimalType(24, 16)         # allocation weight (credits can make a share exceed 1)
DEC38_8 = DecimalType(38, 8)         # detail / summary cost columns
DIVIDEND = DecimalType(24, 8)        # dividend of weights (detail, summary)
DEC38_15 = DecimalType(38, 15)       # daily output measures
RATE = DecimalType(19, 10)           # daily output rates
PERCENT = DecimalType(16, 10)        # summary retail percent (credits can make it exceed 10)
LISTED = DecimalType(14, 8)          # listed hourly rate, narrow enough for exact products
SPOT_RATE = DecimalType(8, 4)        # summary spot rate (rounds to 4 places)

# --- FIXED VALUES (must equal the reference) -------------------------------------
SUPPORT_PRODUCT_PREFIX = "AWS Support"
WEEKDAY_CODES = ("SUN", "MON", "TUE", "WED", "THU", "FRI", "SAT")

USAGE = "Usage"
RIFEE = "RIFee"
FEE = "Fee"
CREDIT = "Credit"
SP_RECURRING_FEE = "SavingsPlanRecurringFee"
SP_COVERED_USAGE = "SavingsPlanCoveredUsage"
DISCOUNTED_USAGE = "DiscountedUsage"
PURCHASE_BILL_TYPE = "Purchase"

DAILY_EXCLUDED_TYPES = ("SavingsPlanNegation", "SavingsPlanUpfrontFee", "Refund")
MONTHLY_EXCLUDED_TYPES = ("SavingsPlanNegation", "Fee", "SavingsPlanUpfrontFee", "Refund")
FEE_TYPES = ("RIFee", "Fee", "SavingsPlanRecurringFee")
DETAIL_ADHOC_SKIPPED_TYPES = ("RIFee", "SavingsPlanRecurringFee")

NOTE_AMORTIZED_RI = "AMORTIZED NON-UPFRONT RI FEE"
NOTE_AMORTIZED_SUMMARY = "AMORTIZED"
NOTE_ADHOC_DAILY = "REALLOCATED AD HOC USAGE"
NOTE_ADHOC_SUMMARY = "AD-HOC-ALLOC"
NOTE_ADHOC_DETAIL = "Off Hour Server Costs"
NOTE_K8_UNMAPPED = "UNALLOCATED K8 COSTS (MISSING MAPPING)"
NOTE_K8_DAILY_PREFIX = "REALLOCATED K8 COSTS ("
NOTE_K8_SUMMARY = "REALLOCATED K8 COSTS"
NOTE_UPFRONT_SP = "AMORTIZED UPFRONT SP FEE"
NOTE_UPFRONT_RI = "AMORTIZED UPFRONT RI FEE"
NOTE_INFRA_DAILY_PREFIX = "REALLOCATED INFRA COSTS ("
NOTE_INFRA_MONTHLY = "INFRA COSTS"
NOTE_INFRA_DETAIL = "Hosted Monitoring Systems"
UPFRONT_SP_TYPE = "SavingsPlanUpfrontFee"
UPFRONT_RI_TYPE = "ReservedInstanceUpfrontFee"
SAVINGS_PLAN_PRODUCT_PATTERN = "%Savings Plan%"
AWS_ENTITY = "AWS"
AZURE_SOURCE = "AZURE"
