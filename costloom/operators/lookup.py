"""Left joins of the transaction grain to lookup tables (JOI2-JOI5, JOI10, JOI11, JOI13).

A lookup that Spark's own size estimate (file sizes, for tables and stages) puts under the
broadcast threshold is broadcast: the big side is not shuffled and a hot key costs nothing.
A larger one is a sort-merge join with one exchange a side, which AQE splits where a key is
hot (``spark.sql.adaptive.forceOptimizeSkewedJoin`` also where two joins follow each other on
one key; ``session.build_session`` sets it).

NULL and blank keys are the hot keys of every bill. On the shuffle path they are spread inside
the exchange: a further join column holds a hash of the row for a NULL key (which matches nothing
anyway) and one of ``BLANK_COPIES`` numbers for a blank one, whose lookup rows are copied as often.
Other keys have 0 there. The hash is of the row's own values, so a task that runs again sends every
row where it went before, and the big side is read once. No action runs here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import session
from costloom.functions.columns import c

BLANK_COPIES = 64


def lookup_join(big: DataFrame, lookup: DataFrame, keys: list[tuple[str, str]], how: str = "left",
                residual: Column | None = None, spread_by: tuple[str, ...] = (), small: bool | None = None) -> DataFrame:
    """``big`` joined to ``lookup`` on ``keys`` (pairs of big / lookup column names, names
    distinct between the sides) and an optional ``residual`` condition.

    ``spread_by`` names columns of ``big`` that tell its rows apart; with it, rows whose first
    key is NULL or blank are spread on the shuffle path. Joins in a row on one first key share
    the further column ``_spread_<key>``, hence the exchange; callers drop it with their
    final ``select``. ``small`` says whether the lookup may be broadcast where the caller knows better
    than the estimate of a frame that copies rows."""
    cond = reduce(lambda a, b: a & b, [c(l) == c(r) for l, r in keys])
    if session.under_broadcast_threshold(lookup) if small is None else small:
        return big.join(F.broadcast(lookup), cond if residual is None else cond & residual, how)
    if spread_by and how == "left":
        big, lookup, place = spread(big, lookup, keys[0], spread_by)
        cond = cond & (c(place) == c(f"{place}_of_lookup"))
        return big.join(lookup, cond if residual is None else cond & residual, how).drop(f"{place}_of_lookup")
    return big.join(lookup, cond if residual is None else cond & residual, how)


def spread(big: DataFrame, lookup: DataFrame, key: tuple[str, str], by: tuple[str, ...]) -> tuple[DataFrame, DataFrame, str]:
    """Both sides with the further join column, and its name."""
    left, right = key
    place = f"_spread_{left}"
    if place not in big.columns:
        mixed = F.xxhash64(*by)
        big = big.withColumn(place, F.when(c(left).isNull(), mixed)
                             .when(F.trim(c(left)) == "", F.pmod(mixed, F.lit(BLANK_COPIES))).otherwise(F.lit(0).cast("long")))
    copies = F.when(F.trim(c(right)) == "", F.sequence(F.lit(0).cast("long"), F.lit(BLANK_COPIES - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return big, lookup.withColumn(f"{place}_of_lookup", F.explode(copies)), place
