"""Column-level rules (all JVM-side built-ins; nothing here leaves whole-stage codegen)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from costloom import constants as K
from costloom.settings import DEFAULTS, Settings


def c(name: str) -> Column:
    return F.col(name)


def is_blank(col: Column) -> Column:
    """``NVL(x, '') = ''``."""
    return F.coalesce(col, F.lit("")) == ""


def is_trim_blank(col: Column) -> Column:
    """``TRIM(NVL(x, '')) = ''``."""
    return F.trim(F.coalesce(col, F.lit(""))) == ""


def keep_unless(pred: Column) -> Column:
    """Row filter equal to ``DELETE ... WHERE pred``: a NULL predicate keeps the row."""
    return ~F.coalesce(pred, F.lit(False))


def not_in(col: Column, values) -> Column:
    """SQL ``col NOT IN (...)``; NULL stays NULL (three-valued)."""
    return ~col.isin(*values)


def company_with_default(tag: Column, default_cost_center: Column) -> Column:
    """Blank or NULL tag falls back to the account default; both upper-cased (no trim)."""
    return F.when(is_blank(tag), F.upper(default_cost_center)).otherwise(F.upper(tag))


def company_precedence(tag_company: Column, user_company: Column,
                       default_cost_center: Column) -> Column:
    """Resource tag (raw) > account default when the user company trims blank > user company. The latter two
    come in upper case from their lookups."""
    return (F.when(tag_company.isNotNull(), tag_company)
            .when(is_trim_blank(user_company), default_cost_center)
            .otherwise(user_company))


def product_precedence(description: Column, tag_product: Column, user_product: Column, cfg: Settings = DEFAULTS) -> Column:
    """Marketplace description > resource tag (raw) > user product, which its lookup has trimmed and put in upper case."""
    return (F.when(description.like(cfg.marketplace_description_prefix + "%"), F.lit(cfg.marketplace_product))
            .when(tag_product.isNotNull(), tag_product)
            .otherwise(F.coalesce(user_product, F.lit(""))))


def is_support(product_name: Column) -> Column:
    return product_name.like(K.SUPPORT_PRODUCT_PREFIX + "%")


def rate_text_to_decimal(col: Column) -> Column:
    """Text rate to DECIMAL(19,10) with ``''`` as NULL (a bare cast of ``''`` raises)."""
    return F.when(col == "", F.lit(None)).otherwise(col).cast(K.RATE)


def shifted(ts: Column, hours: int = DEFAULTS.off_hours_offset_hours) -> Column:
    return F.timestamp_add("HOUR", F.lit(hours), ts)


def weekday_code(date_col: Column) -> Column:
    """SUN..SAT code, independent of locale (``dayofweek`` is 1 = Sunday)."""
    codes = F.array(*[F.lit(x) for x in K.WEEKDAY_CODES])
    return F.element_at(codes, F.dayofweek(date_col))


def first_of_next_month(date_col: Column) -> Column:
    return F.add_months(F.trunc(date_col, "MM"), 1)


def scaled(measure: Column, weight: Column, dtype=K.MONEY) -> Column:
    """Allocated measure, cast back to the column type it is stored in. The measure is
    narrowed to 28 digits first: Spark trims a (38,8) x (18,16) product to scale 6."""
    narrow = DecimalType(min(dtype.precision, 28), dtype.scale)
    return (measure.cast(narrow) * weight).cast(dtype)


def second_part(text: Column, separator: str) -> Column:
    """``split_part(text, separator, 2)`` without a regular expression for each row."""
    at = F.locate(separator, text)
    return F.when(at == 0, F.lit("")).otherwise(F.substring_index(text.substr(at + len(separator), F.length(text)), separator, 1))


def times_over(part: Column, factor: Column, total: Column) -> Column:
    """``part * factor / total`` of whole numbers in DECIMAL(38,0), half up to a whole number. The product
    needs more than 38 digits once totals are large, so it is divided digit by digit in base 10**8: exact
    for a part and a total of up to 28 digits and a factor of up to 28."""
    whole, base = DecimalType(38, 0), 10 ** 8
    zero, base_of = F.lit(Decimal(0)).cast(whole), F.lit(Decimal(base))
    p, f, t = F.abs(part), F.abs(factor), F.abs(total)
    below = [p % F.lit(Decimal(base ** k)) for k in range(1, 5)]
    digits = F.array(*[((below[k] - below[k - 1]) / F.lit(Decimal(base ** k))).cast(whole) for k in (3, 2, 1)], below[0].cast(whole))

    def step(acc: Column, digit: Column) -> Column:
        due = (acc["rest"] * base_of + digit * f).cast(whole)
        rest = (due % t).cast(whole)
        return F.struct((acc["found"] * base_of + (due - rest) / t).cast(whole).alias("found"), rest.alias("rest"))

    size = F.aggregate(digits, F.struct(zero.alias("found"), zero.alias("rest")), step,
                       lambda acc: acc["found"] + F.when(acc["rest"] * 2 >= t, 1).otherwise(0)).cast(whole)
    return F.when(((part < 0) != (factor < 0)) != (total < 0), -size).otherwise(size)


def units(amount: Column, places: int) -> Column:
    """An amount as a whole number of its last place, for ``times_over``; at most 28 digits."""
    return (amount.cast(DecimalType(28, places)) * F.lit(Decimal(10 ** places))).cast(DecimalType(38, 0))


def from_units(number: Column, places: int, dtype: DecimalType) -> Column:
    return (number.cast(DecimalType(37 - places, 0)) * F.lit(Decimal(1).scaleb(-places)).cast(DecimalType(places, places))).cast(dtype)


def dec(value: str) -> Column:
    return F.lit(Decimal(value))


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal parsed from text, independent of the session time zone
    (``F.lit(datetime)`` goes through a zoned timestamp first). A scalar of the plan stays as it is."""
    if isinstance(value, Column):
        return value
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def month_of(value) -> Column:
    """An invoice month given as a number or as a scalar of the plan."""
    return value if isinstance(value, Column) else F.lit(int(value))


def month_bounds(month: int):
    """First day of the month and of the next month, as Python dates."""
    import datetime as dt
    y, m = divmod(int(month), 100)
    first = dt.date(y, m, 1)
    nxt = dt.date(y + (m // 12), m % 12 + 1, 1)
    return first, nxt
