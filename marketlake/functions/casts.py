"""Casts that turn bad text into NULL instead of raising, and reject what Spark's own casts are too kind to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# '1d' and 'Infinity' are doubles to Spark's cast; '09:30' is a timestamp (of today). Both are bad data here.
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DATE_LED_TEXT = r"^\s*\d{4}-\d{2}-\d{2}"

PRICE = T.DecimalType(20, 6)
QUANTITY = T.DecimalType(18, 6)
TOTAL = T.DecimalType(32, 6)


def col_or(df: DataFrame, name: str, default=None) -> Column:
    """The column, or a literal when this frame never had it."""
    return F.col(name) if name in df.columns else F.lit(default)


def to_number(df: DataFrame, name: str) -> Column:
    """Double value of a text or numeric column; unreadable text, NaN and absent columns are NULL."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(col.rlike(NUMBER_TEXT), col.try_cast("double"))
    value = col.cast("double")
    return F.when(~F.isnan(value), value)


def to_utc(df: DataFrame, name: str = "timestamp") -> Column:
    """Instant of an ISO-8601 text column. Text without an offset is UTC (the session time zone)."""
    if name not in df.columns:
        return F.lit(None).cast("timestamp")
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(col.rlike(DATE_LED_TEXT), col.try_cast("timestamp"))
    return col.cast("timestamp")


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that filters and later expressions read instead of computing again.

    A plain projection is merged into what follows it: a filter on a parsed column would be pushed below
    and parse the text a second time. Generated columns stay where they are; filters on the other columns
    still pass through to the scan.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def exact_parts(value: Column, kind: T.DecimalType) -> tuple[Column, Column]:
    """Split a double into a decimal on the kind's grid and what is left over as a double.

    Sums of decimals do not depend on the order of the rows. The rest is exactly 0 for values that have
    no more digits than the grid, and keeps every digit of those that do; values beyond the decimal's
    range are all rest.
    """
    scale, limit = 10.0**kind.scale, 10.0 ** (kind.precision - kind.scale - 1)
    value = value.cast("double")
    on_grid = F.when(F.abs(value) < limit, F.rint(value * scale) / scale).otherwise(0.0)
    on_grid = F.when(value.isNotNull(), on_grid)
    return on_grid.cast(kind), value - on_grid


def total(exact: Column, rest: Column) -> Column:
    """Sum of split values as a double."""
    return F.sum(exact).cast("double") + F.coalesce(F.sum(rest), F.lit(0.0))


_MASK24, _MASK32 = (1 << 24) - 1, (1 << 32) - 1


def _on_grid(value: Column, limit: float) -> tuple[Column, Column]:
    """A double as a whole number of millionths, and what is left over; beyond the limit all is left over."""
    value = value.cast("double")
    whole = F.when(F.abs(value) < limit, F.rint(value * 1e6)).otherwise(0.0)
    whole = F.when(value.isNotNull(), whole)
    return whole.cast("bigint"), value - whole / 1e6


def _scaled(whole: Column, places: int) -> Column:
    """A decimal of that many places out of a decimal without any; for aggregated rows."""
    return F.concat(whole.cast("string"), F.lit(f"e-{places}")).cast(T.DecimalType(38, places))


def _weighted(value: Column, bits: int) -> Column:
    return value.cast(T.DecimalType(38, 0)) * F.lit(str(1 << bits)).cast(T.DecimalType(len(str(1 << bits)), 0))


def amount_limbs(value: Column) -> dict[str, Column]:
    """A double as two numbers of 32 bits and a rest, which hash aggregates sum up as longs: the same bits for any order, at no cost in objects.

    Sums hold for two thousand million rows a group; more are an error, not a wrong number.
    """
    whole, rest = _on_grid(value, 9e12)
    return {"high": F.shiftright(whole, 32), "low": whole.bitwiseAND(F.lit(_MASK32)), "rest": rest}


def amount_sum(sums: dict[str, Column]) -> Column:
    """The decimal that sums of `amount_limbs` stand for, without the rest."""
    return _scaled(_weighted(sums["high"], 32) + sums["low"].cast(T.DecimalType(19, 0)), 6)


def notional_limbs(price: Column, quantity: Column) -> dict[str, Column]:
    """price x quantity as three numbers and a rest, in the same way: the product of two whole numbers of 47 bits, taken in halves of 24."""
    (p, p_rest), (q, q_rest) = _on_grid(price, 1e8), _on_grid(quantity, 1e8)
    mask = lambda c, bits: c.bitwiseAND(F.lit(bits))
    p_low, p_high, q_low, q_high = mask(p, _MASK24), F.shiftright(p, 24), mask(q, _MASK24), F.shiftright(q, 24)
    middle = p_high * q_low + p_low * q_high
    low = p_low * q_low + F.shiftleft(mask(middle, _MASK24), 24)
    high = p_high * q_high + F.shiftright(middle, 24)
    return {
        "low": mask(low, _MASK32), "mid": F.shiftright(low, 32) + F.shiftleft(mask(high, 0xFFFF), 16), "high": F.shiftright(high, 16),
        "rest": price * q_rest + p_rest * (quantity - q_rest),
    }


def notional_sum(sums: dict[str, Column]) -> Column:
    """The decimal that sums of `notional_limbs` stand for, without the rest."""
    return _scaled(_weighted(sums["high"], 64) + _weighted(sums["mid"], 32) + sums["low"].cast(T.DecimalType(19, 0)), 12)


def summed(limbs: dict[str, Column]) -> dict[str, Column]:
    return {name: F.sum(c) for name, c in limbs.items()}


def _as_double(sums: dict[str, Column], exact: Column) -> Column:
    return exact.cast("double") + F.coalesce(sums["rest"], F.lit(0.0))


def exact_sum(value: Column, kind: T.DecimalType) -> Column:
    """Sum as a double with the same bits for any order of the rows (see `exact_parts`)."""
    if kind == TOTAL:  # sums of sums may be too large for longs; there are few of them
        return total(*exact_parts(value, kind))
    sums = summed(amount_limbs(value))
    return _as_double(sums, amount_sum(sums))


def exact_notional(price: Column, quantity: Column) -> Column:
    """Order-independent sum of price x quantity, as a double."""
    sums = summed(notional_limbs(price, quantity))
    return _as_double(sums, notional_sum(sums))


def exact_mean(value: Column) -> Column:
    """Mean of the values rounded to 1e-9 each: the same bits for any order of the rows."""
    grid = F.rint(value * 1e9).cast(T.DecimalType(28, 0))
    return F.sum(grid).cast("double") / 1e9 / F.nullif(F.count(value), F.lit(0))


def round_half_away(value: Column, places: int) -> Column:
    """SQL ROUND(double, places) done in binary: scale, round to the nearest integer, scale back."""
    scale = F.lit(float(10**places))
    return F.round(value * scale, 0) / scale
